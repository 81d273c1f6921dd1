"""Near-duplicate texts under small edits.

Method: deletion-variant signatures. Every text becomes the set of its
word-sequence shingles and a fingerprint of ``segments * width`` min-hash
symbols; two texts of similarity J agree on a symbol with probability J. The
fingerprint is cut into few segments, so that in some segment two similar
texts differ by at most one symbol. Each segment is indexed once per position
with that position deleted (a wildcard); segments that differ by at most one
symbol share such a variant, so an equality join finds them. Candidates are
verified exactly on their shingle sets.

With 14 segments of 6 symbols a pair at the threshold 0.7 is missed with
probability (1 - 0.42)^14 = 0.0005, at 0.77 with 0.000005, at 0.8 with 0.0000004.

Scale: texts with equal shingle sets are collapsed to one representative
first, so a group of copies of any size is one row from then on. A signature
shared by many representatives is split into blocks whose pairs are separate
join keys, so no task sees an unbounded group.

Defined results: null and empty texts and texts under ``min_words`` words take
part in no pair, nor do rows without a doc_id; texts whose shingle sets are equal have similarity 1.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusloom.session import cut

_WORD = re.compile(r"[^\W_]+")
_BLOCK = 500


class _Hashes(dict):
    """Words to 64-bit hashes, forgetting everything when it has grown large."""

    def __missing__(self, word: str) -> int:
        if len(self) > 500_000:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


_MULT = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0xD6E8FEB86659FD93)]


def words(text: str) -> list[str]:
    """Longest runs of letters and digits, lower-cased."""
    w = _WORD.findall(text)
    return " ".join(w).lower().split(" ") if w else []


def shingles(ws: list[str], n: int, hashes: dict) -> np.ndarray:
    """Sorted distinct 32-bit hashes of the sequences of ``n`` words."""
    h = np.fromiter(map(hashes.__getitem__, ws), np.uint64, len(ws))
    m = len(h) - n + 1
    if m <= 0:
        return np.empty(0, np.uint32)
    acc = np.zeros(m, np.uint64)
    for k in range(n):
        acc = (acc ^ h[k : k + m]) * _MULT[k % 5]
        acc ^= acc >> np.uint64(31)
    return np.unique((acc >> np.uint64(16)).astype(np.uint32))


def _sets(n: int, min_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _Hashes()
        for b in batches:
            ids, keys, sets = [], [], []
            for i, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if not text:
                    continue
                ws = words(text)
                if len(ws) < min_words:
                    continue
                s = shingles(ws, n, hashes)
                if len(s):
                    raw = s.tobytes()
                    ids.append(i)
                    keys.append(xxhash.xxh3_128_digest(raw))
                    sets.append(s.view(np.int32))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(keys, pa.binary()), pa.array(sets, pa.list_(pa.int32()))], names=["doc_id", "set_key", "set"])

    return run


def _signatures(segments: int, width: int):
    rng = np.random.default_rng(20240229)
    k = segments * width
    xors = rng.integers(0, 2**64, k, dtype=np.uint64)
    mults = rng.integers(0, 2**63, k, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    base = np.arange(segments * width, dtype=np.uint64).reshape(segments, width)
    coef = rng.integers(0, 2**63, k, dtype=np.uint64).reshape(segments, width) * np.uint64(2) + np.uint64(1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = b.num_rows
            if not n:
                continue
            col = b.column(1)
            flat = col.flatten().to_numpy(zero_copy_only=False).view(np.uint32).astype(np.uint64)
            at = np.concatenate([[0], np.cumsum(col.value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int64)
            flat *= np.uint64(0x9E3779B97F4A7C15)
            mins = np.empty((k, n), np.uint64)
            for start in range(0, n, 256):  # so that the products stay in the cache
                part, cuts = flat[at[start] : at[min(n, start + 256)]], at[start : min(n, start + 256)] - at[start]
                for p in range(k):
                    h = (part ^ xors[p]) * mults[p]
                    h >>= np.uint64(32)
                    mins[p, start : start + 256] = np.minimum.reduceat(h, cuts)
            terms = (mins.reshape(segments, width, n) + np.uint64(1)) * coef[:, :, None]
            terms ^= terms >> np.uint64(29)
            terms *= _MULT[1]
            total = terms.sum(axis=1, dtype=np.uint64)
            sig = total[:, None, :] - terms  # the symbol at each position deleted
            sig = (sig ^ (sig >> np.uint64(32))) * _MULT[0] + base[:, :, None] * _MULT[4]
            sig ^= sig >> np.uint64(29)
            sigs = sig.reshape(k, n).view(np.int64)
            ids = b.column(0).to_numpy(zero_copy_only=False)
            sizes = np.diff(at).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(sigs.ravel()), pa.array(np.tile(ids, k)), pa.array(np.tile(sizes, k))],
                names=["sig", "rep", "n"],
            )

    return run


def _pairs_within(rows: DataFrame, key: str, id_: str, near=None) -> DataFrame:
    """Pairs (a < b) of ``id_`` that share ``key``; ``rows`` has the size ``c`` of each key's group.

    A group is split into blocks of about ``_BLOCK`` rows whose pairs are keys
    of their own, so no task sees a whole large group.
    """
    ranked = rows.where("c > 1").withColumn("grid", F.ceil(F.col("c") / _BLOCK).cast("int")).withColumn("block", F.pmod(F.xxhash64(id_), F.col("grid")).cast("int"))
    rest = [x for x in rows.columns if x != "c"]
    other = F.explode(F.sequence(F.lit(0), F.col("grid") - 1)).alias("other")
    keyed = ranked.select(*rest, "block", other).select(*rest, F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "block")
    a, b = keyed.alias("a"), keyed.alias("b")
    on = (F.col(f"a.{key}") == F.col(f"b.{key}")) & (F.col("a.lo") == F.col("b.lo")) & (F.col("a.hi") == F.col("b.hi"))
    once = (F.col("a.lo") == F.col("a.hi")) | (F.col("a.block") != F.col("b.block"))
    on = on & (F.col(f"a.{id_}") < F.col(f"b.{id_}")) & once
    return a.join(b, on if near is None else on & near).select(F.col(f"a.{id_}").alias("a"), F.col(f"b.{id_}").alias("b"))


def _candidate_pairs(sigs: DataFrame, threshold: float) -> DataFrame:
    """Distinct pairs (a < b) that share a signature and whose sets are of like size."""
    rows = sigs.withColumn("c", F.count(F.lit(1)).over(Window.partitionBy("sig")))
    near = F.least("a.n", "b.n") >= F.greatest("a.n", "b.n") * F.lit(threshold)
    return _pairs_within(rows, "sig", "rep", near).distinct()


def _small(ids: DataFrame, most: int = 200_000) -> DataFrame:
    """``ids`` to be broadcast if they are counted to be few, else to be joined as they come; the large side is then not shuffled."""
    return F.broadcast(ids) if ids.count() <= most else ids


def near_duplicate_links(docs: DataFrame, shingle: int = 5, threshold: float = 0.8, min_words: int = 1, segments: int = 14, width: int = 6) -> tuple[DataFrame, DataFrame]:
    """Links between representatives and the membership.

    Returns ``links`` (a, b, similarity), a < b, and ``members`` (doc_id, rep):
    every document with shingles and the smallest doc_id with the same set.
    """
    sets = cut(docs.select("doc_id", "text").where("doc_id is not null and text is not null").mapInArrow(_sets(shingle, min_words), "doc_id long, set_key binary, set array<int>"), "shingle-sets")
    keys = sets.select("doc_id", "set_key")
    members = cut(keys.join(keys.groupBy("set_key").agg(F.min("doc_id").alias("rep")), "set_key").select("doc_id", "rep"), "members")
    copies = members.where("doc_id <> rep").select("doc_id")
    reps = sets.join(_small(copies), "doc_id", "left_anti").select(F.col("doc_id").alias("rep"), "set")
    sigs = reps.mapInArrow(_signatures(segments, width), "sig long, rep long, n int")
    pairs = cut(_candidate_pairs(sigs, threshold), "candidate-pairs")
    named = pairs.select(F.col("a").alias("doc_id")).union(pairs.select(F.col("b").alias("doc_id"))).distinct()
    plain = sets.join(_small(cut(named, "candidates")), "doc_id", "left_semi").select(F.col("doc_id").alias("rep"), "set")
    both = pairs.join(plain.select(F.col("rep").alias("a"), F.col("set").alias("sa")), "a").join(plain.select(F.col("rep").alias("b"), F.col("set").alias("sb")), "b")
    common = F.size(F.array_intersect("sa", "sb"))
    links = (
        both.withColumn("common", common)
        .withColumn("similarity", F.col("common") / (F.size("sa") + F.size("sb") - F.col("common")))
        .where(F.col("similarity") >= threshold)
        .select("a", "b", "similarity")
    )
    return links, members


def document_pairs(links: DataFrame, members: DataFrame) -> DataFrame:
    """All pairs of documents (doc_id_a < doc_id_b): links expanded by membership, and copies.

    The number of rows grows with the square of a group; ``near_duplicate_classes``
    gives the same groups with one row a document.
    """
    links = cut(links, "links")
    linked = links.select(F.col("a").alias("rep")).union(links.select(F.col("b").alias("rep"))).distinct()
    lone = members.join(linked, "rep", "left_semi")
    ma, mb = lone.select(F.col("rep").alias("a"), F.col("doc_id").alias("x")), lone.select(F.col("rep").alias("b"), F.col("doc_id").alias("y"))
    across = links.join(ma, "a").join(mb, "b").select("x", "y")
    several = members.groupBy("rep").agg(F.count("*").alias("c")).where("c > 1")
    same = _pairs_within(members.join(several, "rep"), "rep", "doc_id").select(F.col("a").alias("x"), F.col("b").alias("y"))
    return across.union(same).select(F.least("x", "y").alias("doc_id_a"), F.greatest("x", "y").alias("doc_id_b"))


def components(links: DataFrame, most_rounds: int = 200) -> DataFrame:
    """(node, class_id): connected components of links (a, b) by alternating large-star and small-star rounds."""
    edges = cut(links.select(F.col("a").cast("long").alias("u"), F.col("b").cast("long").alias("v")).where("u <> v"), "edges")
    before = None
    for _ in range(most_rounds):
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        low = down.groupBy("u").agg(F.min("v").alias("m"))
        small = down.join(low, "u")
        edges = cut(
            small.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").union(low.select("u", F.col("m").alias("v"))).distinct(),
            "edges",
        )
        state = edges.agg(F.count("*"), F.sum("u"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    nodes = edges.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("class_id"))
    return nodes.union(nodes.select(F.col("class_id").alias("node"), "class_id").distinct())


def near_duplicate_classes(docs: DataFrame, **options) -> DataFrame:
    """One row per document that has shingles: doc_id, class_id (smallest doc_id of its class), n_links of its text."""
    links, members = near_duplicate_links(docs, **options)
    links = cut(links, "links")
    nodes = components(links)
    degree = links.select("a").union(links.select("b")).groupBy(F.col("a").alias("rep")).agg(F.count("*").alias("n_links"))
    return (
        members.join(nodes.withColumnRenamed("node", "rep"), "rep", "left")
        .join(degree, "rep", "left")
        .select("doc_id", F.coalesce("class_id", "rep").alias("class_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"))
    )
