"""Global row numbers without sorting everything in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusloom.session import cut


def global_rank(df: DataFrame, keys: list[str], name: str = "rank") -> DataFrame:
    """``df`` with a consecutive number from 1 in the order of ``keys``.

    Rows are range-partitioned by the keys, numbered inside each range, and the
    ranges' sizes are summed; only one row per range meets in one place. The
    ranges are written once, so every reader sees the same ones.
    """
    ranged = cut(df.repartitionByRange(*keys).withColumn("_range", F.spark_partition_id()), "ranges")
    sizes = ranged.groupBy("_range").agg(F.count("*").alias("_n"))
    before = sizes.select("_range", F.coalesce(F.sum("_n").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    inside = F.row_number().over(Window.partitionBy("_range").orderBy(*keys))
    return ranged.join(F.broadcast(before), "_range").withColumn(name, F.col("_before") + inside).drop("_range", "_before")


def fixed_batches(df: DataFrame, keys: list[str], size: int = 50) -> DataFrame:
    """``df`` with batch_no and batch_pos, both from 0: consecutive slices of ``size`` rows, the last one short."""
    at = F.col("_rank") - 1
    return global_rank(df, keys, "_rank").withColumn("batch_no", F.floor(at / size).cast("long")).withColumn("batch_pos", (at % size).cast("int")).drop("_rank")
