"""Session helpers: table access, shipping the package, cutting lineage."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_SHIPPED: set[str] = set()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The parquet table ``name`` under ``sf_dir``."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """``df``, read by at least as many tasks as there are cores.

    Only an input of fewer splits than cores is shuffled, whose size is bounded
    by the split size times the cores; larger inputs are left as they are.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents table for stages that work hard on every row."""
    return spread(table(spark, sf_dir, "documents"))


def ship(spark: SparkSession) -> None:
    """Send the package to the executors once per application.

    Python workers unpickle functions by module name; a cluster whose nodes do
    not carry the repository gets it from the driver this way.
    """
    app = spark.sparkContext.applicationId
    if app in _SHIPPED or spark.sparkContext.master.startswith("local["):
        return
    root = Path(__file__).resolve().parent
    out = os.path.join(tempfile.mkdtemp(prefix="corpusloom-"), "corpusloom_pkg.zip")
    with zipfile.ZipFile(out, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, str(p.relative_to(root.parent)))
    spark.sparkContext.addPyFile(out)
    _SHIPPED.add(app)


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir`` if it is set.

    Only where it is unset and everything runs in one process (tests, local
    mode) a temporary folder is used; a cluster without the setting is an error.
    """
    conf = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not conf:
        current = spark.sparkContext.getCheckpointDir()
        if current:
            return current
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        conf = tempfile.mkdtemp(prefix="corpusloom-ckpt-")
        spark.sparkContext.setCheckpointDir(conf)
    return conf


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as parquet into the shared folder and read it again.

    Cuts the lineage and prevents a costly Python stage from running once per
    consumer. Unlike a local checkpoint it survives the loss of executors. The
    folder is removed when the application ends.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/corpusloom-{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _remove_at_exit(spark, path)
    return spark.read.parquet(path)


def small(df: DataFrame, most: int) -> DataFrame:
    """``df`` to be broadcast if it is counted to have at most ``most`` rows, else to be joined as it comes."""
    return F.broadcast(df) if df.count() <= most else df


def _remove_at_exit(spark: SparkSession, path: str) -> None:
    def gone() -> None:
        try:
            jvm = spark.sparkContext._jvm
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
        except Exception:
            pass

    atexit.register(gone)


def bounded_rows(df: DataFrame, most: int, what: str) -> list:
    """Collect a table whose size is bounded; fail rather than grow silently."""
    rows = df.limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"{what}: more than {most} rows; this table must stay small")
    return rows
