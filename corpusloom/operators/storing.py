"""Storing documents and skipping what is stored already."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.titles import output_name, safe_name


def last_per_source(docs: DataFrame, entity: str, source: str, order: list[str]) -> DataFrame:
    """One row per (entity_key, source_key), both as safe names: the last by ``order`` wins.

    A partial aggregate, so a busy key is reduced before it is shuffled.
    """
    keyed = docs.withColumn("entity_key", safe_name(F.col(entity))).withColumn("source_key", safe_name(F.col(source)))
    rest = [c for c in docs.columns if c not in ("entity_key", "source_key")]
    return keyed.groupBy("entity_key", "source_key").agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("r")).select("entity_key", "source_key", "r.*")


def not_stored(entities: DataFrame, stored: DataFrame, title: str = "title", stored_title: str = "entity_title") -> DataFrame:
    """Entities without any stored document under their safe name: the work that is left."""
    have = stored.select(safe_name(F.col(stored_title)).alias("_key")).where("_key is not null").distinct()
    return entities.withColumn("_key", safe_name(F.col(title))).join(have, "_key", "left_anti").drop("_key")


def write_partitioned(df: DataFrame, path: str, by: list[str]) -> None:
    """Overwrite only the partitions that ``df`` holds."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def write_discovered(entities: DataFrame, path: str) -> None:
    """Entities (title, depth, ...) stored under one name a (title, depth); a later run replaces what it found again."""
    write_partitioned(entities.withColumn("stored_as", output_name(F.col("title"), F.col("depth"))), path, ["stored_as"])


def append_quarantine(bad: DataFrame, path: str) -> None:
    """Bad replies are kept, not overwritten."""
    bad.withColumn("seen_at", F.current_timestamp()).write.mode("append").parquet(path)
