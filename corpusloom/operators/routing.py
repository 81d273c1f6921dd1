"""How an extracted page becomes a document: drop, pass, clean at once, or clean in batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import chunks
from corpusloom.functions.hosts import is_trusted, url_domain
from corpusloom.functions.signals import has_navigation, has_personal_talk
from corpusloom.functions.text import let, strip


def best_extraction(pages: DataFrame, key: str, order: str, text: str = "text") -> DataFrame:
    """One row per key: its longest text, null counting as empty, the first by ``order`` of equal ones."""
    rank = F.struct(F.coalesce(F.length(text), F.lit(0)).alias("n"), (-F.col(order)).alias("o"))
    return pages.groupBy(key).agg(F.max_by(F.struct(*[F.col(c) for c in pages.columns if c != key]), rank).alias("r")).select(key, "r.*")


def route(url: Column, text: Column, **trust) -> Column:
    """'drop', 'pass', 'single' or 'batch' of a stripped text."""

    def way(t: Column) -> Column:
        clean = is_trusted(url_domain(url), **trust) & ~has_navigation(t) & ~has_personal_talk(t)
        return (
            F.when(F.coalesce(t, F.lit("")) == "", F.lit("drop"))
            .when(F.coalesce(clean, F.lit(False)), F.lit("pass"))
            .when(F.length(t) <= chunks.SAFE_SINGLE, F.lit("single"))
            .otherwise(F.lit("batch"))
        )

    return let(strip(text), way)


def chunked(docs: DataFrame, id_: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, chunk_no, start, length, chunk) of section-packed chunks."""
    spans = docs.select(id_, F.col(text).alias("_t"), F.posexplode(chunks.section_chunks(F.col(text))).alias("chunk_no", "s"))
    return spans.select(id_, "chunk_no", "s.start", F.col("s.len").alias("length"), F.substring(F.col("_t"), F.col("s.start") + 1, F.col("s.len")).alias("chunk"))


def batched(docs: DataFrame, id_: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, batch_no, parts): a document's chunks in batches that fit a prompt; no shuffle, a row's own arrays only."""
    t = docs.select(id_, F.col(text).alias("_t"), chunks.section_chunks(F.col(text)).alias("_s"))
    t = t.withColumn("_b", chunks.batch_numbers(F.transform("_s", lambda s: s["len"])))
    # the text is sliced before the batches are exploded, so that no row carries the whole of it
    mine = lambda no: F.filter("_s", lambda s, i: F.element_at("_b", i + 1) == no)
    each = F.transform(F.array_distinct("_b"), lambda no: F.struct(no.alias("batch_no"), chunks.slices(F.col("_t"), mine(no)).alias("parts")))
    return t.select(id_, F.inline(each))


def merged(cleaned: DataFrame, id_: str = "doc_id", order: str = "batch_no", parts: str = "parts") -> DataFrame:
    """(id, n_parts, text): cleaned parts of every batch joined in their order, empty ones included."""
    rows = cleaned.groupBy(id_).agg(F.array_sort(F.collect_list(F.struct(order, parts))).alias("b"))
    flat = F.flatten(F.transform("b", lambda x: x[parts]))
    return rows.select(id_, F.size(flat).alias("n_parts"), F.array_join(flat, "\n\n").alias("text"))
