"""Documents as a stream: an extension beyond the batch pipeline.

New raw documents are watched in a folder; every micro-batch is routed and
upserted per (entity, source). The store is a set of buckets by entity key and
a list of versions: version n names, for every bucket, the folder that holds
its rows. A micro-batch writes the buckets it touches into folders of its own
and then puts its version in place by a rename, so readers see all of a batch
or nothing of it. A batch that is run again after a failure starts from the
version before it and replaces its own folders; nothing that a committed
version names is ever overwritten or deleted while it is current.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from corpusloom.functions.hosts import url_source
from corpusloom.functions.titles import safe_name
from corpusloom.operators.routing import route
from corpusloom.operators.storing import last_per_source

SCHEMA = "doc_id long, entity_title string, url string, title string, text string, fetched_at timestamp"


def raw_documents(spark: SparkSession, path: str, schema: str = SCHEMA) -> DataFrame:
    return spark.readStream.schema(schema).parquet(path)


class Store:
    """Versions of the buckets below ``root``."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root
        self._path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def versions(self) -> list[int]:
        at = self._path(f"{self.root}/_versions")
        names = [f.getPath().getName() for f in self._fs.listStatus(at)] if self._fs.exists(at) else []
        return sorted(int(x[:-5]) for x in names if x.endswith(".json") and x[:-5].isdigit())

    def folders(self, version: int) -> dict[str, str]:
        """The folder of each bucket in that version."""
        text = self.spark.read.text(f"{self.root}/_versions/{version}.json", wholetext=True).first()[0]
        return json.loads(text)

    def commit(self, version: int, folders: dict[str, str]) -> None:
        fresh, final = self._path(f"{self.root}/_versions/{version}.tmp"), self._path(f"{self.root}/_versions/{version}.json")
        out = self._fs.create(fresh, True)
        out.write(bytearray(json.dumps(folders).encode()))
        out.close()
        if not self._fs.rename(fresh, final):
            raise RuntimeError(f"version {version} of {self.root} is there already")

    def read(self, folders: list[str]) -> DataFrame | None:
        return self.spark.read.parquet(*(f"{self.root}/{x}" for x in sorted(folders))) if folders else None

    def forget(self, keep: int) -> None:
        """Delete what none of the last ``keep`` versions names."""
        known = self.versions()
        if len(known) <= keep:
            return
        named = {x for v in known[-keep:] for x in self.folders(v).values()}
        for v in known[:-keep]:
            for x in set(self.folders(v).values()) - named:
                self._fs.delete(self._path(f"{self.root}/{x}"), True)
            self._fs.delete(self._path(f"{self.root}/_versions/{v}.json"), True)


def stored(spark: SparkSession, root: str) -> DataFrame | None:
    """The rows of the store's current version; None before the first."""
    store = Store(spark, root)
    known = store.versions()
    return store.read(list(store.folders(known[-1]).values())) if known else None


_ORDER = ["fetched_at", "doc_id"]


def upsert_batch(batch: DataFrame, batch_id: int, root: str, buckets: int = 1024, keep: int = 3) -> None:
    """Put one micro-batch into the store as version ``batch_id``; running it again changes nothing."""
    spark = batch.sparkSession
    store = Store(spark, root)
    known = store.versions()
    if known and known[-1] >= batch_id:
        return
    folders = store.folders(known[-1]) if known else {}
    new = batch.withColumn("source", url_source(F.col("url"))).withColumn("route", route(F.col("url"), F.col("text"))).where("route <> 'drop'")
    # by the key under which rows replace each other, so that equal keys meet in one bucket
    new = new.withColumn("bucket", F.pmod(F.xxhash64(safe_name(F.col("entity_title"))), F.lit(buckets)).cast("int"))
    last = last_per_source(new, "entity_title", "source", _ORDER)
    touched = [r.bucket for r in last.select("bucket").distinct().collect()]  # at most ``buckets``
    old = store.read([folders[str(k)] for k in touched if str(k) in folders])
    if old is not None:
        both = last.drop("entity_key", "source_key").unionByName(old.select(*[c for c in last.columns if c not in ("entity_key", "source_key", "bucket")], F.pmod(F.xxhash64("entity_key"), F.lit(buckets)).cast("int").alias("bucket")))
        last = last_per_source(both, "entity_title", "source", _ORDER)
    last.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{root}/batch-{batch_id}")
    store.commit(batch_id, folders | {str(k): f"batch-{batch_id}/bucket={k}" for k in touched})
    store.forget(keep)


def upsert_stream(docs: DataFrame, out: str, checkpoint: str, buckets: int = 1024) -> StreamingQuery:
    """Routed documents, the last one of an (entity, source) winning within and across batches; read them with ``stored``."""

    def upsert(batch: DataFrame, batch_id: int) -> None:
        upsert_batch(batch, batch_id, out, buckets)

    return docs.writeStream.foreachBatch(upsert).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def arrivals(docs: DataFrame, late: str = "1 day", window: str = "1 hour") -> DataFrame:
    """Documents and characters per source and window of event time; rows later than ``late`` are left out."""
    return (
        docs.withColumn("source", url_source(F.col("url")))
        .withWatermark("fetched_at", late)
        .groupBy(F.window("fetched_at", window), "source")
        .agg(F.count("*").alias("n_documents"), F.sum(F.length("text")).alias("n_chars"))
    )
