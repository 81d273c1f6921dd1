"""Filling containers of fixed capacity with whole texts.

Method: vector best fit. A container has residual capacities of tokens, of
documents and of attention cost (the sum of squared lengths, at most
``attention`` times the squared capacity); items are taken by decreasing size,
and among all open containers that can take an item under every constraint the
one with the best fit is chosen, by the weighted dot-product of the item's
demand and the container's residual ("dot") or the smallest weighted norm of
the residual that would be left ("norm").

Open containers are sorted by the largest item that they can still take under
every constraint. Everything from an item's size on can take it, and as no
score there is below that of a container with just this room, the search ends
with the best container of all after a few steps, without a bound on their
number.

Items go to independent shares of about ``share_rows`` rows by a hash of their
id, so the work is spread over tasks whatever the distribution of languages or
sources; each share leaves at most a few containers part-filled.

Defined results: a null or empty text has no tokens and is not packed; a text
above the capacity is divided into parts of the capacity and a rest, the rest
is packed like any item; an item whose own attention cost is above the limit
(it can't be divided) has a container to itself, and ``fill_report`` counts
these; equal sizes are taken in the order of their ids. A pack whose lang is
null takes every language.
"""

from __future__ import annotations

import bisect
import itertools
import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.tokens import DEFAULT_VOCABULARY, token_counts
from corpusloom.session import bounded_rows, cut

DOCUMENTS, ATTENTION = 128, 0.75

_OUT = pa.schema(
    [("pack_id", pa.int32()), ("container", pa.string()), ("doc_id", pa.int64()), ("part", pa.int32()), ("token_start", pa.int32()), ("n_tokens", pa.int32())]
)


def language(lang: Column) -> Column:
    """Primary language code: lower case, without region; null where undetermined."""
    code = F.lower(F.regexp_extract(F.trim(lang), r"^([A-Za-z]{2,3})(?:[-_].*)?$", 1))
    return F.when(~code.isin("", "und"), code)


class BestFit:
    """Containers with residual (tokens, documents, attention cost), sorted by the largest item they can take."""

    def __init__(self, tokens: int, documents: int, cost: float, rule: str, weights: tuple[float, float, float]) -> None:
        self.full = (tokens, documents, cost)
        self.rule, self.weights = rule, weights
        self.open: list[tuple[int, int]] = []
        self.left: list[list[float]] = []

    def score(self, n: float, documents: float, tokens: float, cost: float) -> float:
        """How badly an item of ``n`` tokens fits a container with these residuals; grows with each of them."""
        f, w = self.full, self.weights
        if self.rule == "norm":
            return w[0] * ((tokens - n) / f[0]) ** 2 + w[1] * ((documents - 1) / f[1]) ** 2 + w[2] * ((cost - n * n) / f[2]) ** 2
        # demand and residual in proportion to the capacity; a tight fit has a small product
        return w[0] * (n / f[0]) * (tokens / f[0]) + w[1] / f[1] * (documents / f[1]) + w[2] * (n * n / f[2]) * (cost / f[2])

    def put(self, n: int) -> int:
        """The container for an item of ``n`` tokens."""
        best, at = math.inf, -1
        for j in range(bisect.bisect_left(self.open, (n, -1)), len(self.open)):
            room, c = self.open[j]
            # no container from here on has less room
            if self.score(n, 1, room, room * room) >= best:
                break
            tokens, documents, cost = self.left[c]
            if (score := self.score(n, documents, tokens, cost)) < best:
                best, at = score, j
        if at < 0:
            self.left.append(list(self.full))
            c = len(self.left) - 1
        else:
            c = self.open.pop(at)[1]
        r = self.left[c]
        r[0] -= n
        r[1] -= 1
        r[2] -= float(n) * n
        room = min(int(r[0]), math.isqrt(int(r[2]))) if r[1] >= 1 and r[2] >= 1 else 0
        if room > 0:
            bisect.insort(self.open, (room, c))
        return c


def lower_bound(sizes: dict[int, int], tokens: int, documents: int, cost: float) -> int:
    """Containers that no packing can do without, from the number of items of each size.

    Items alone above the cost limit have a container each; of the others the
    largest of the bounds by documents, by cost, and by tokens counts, the last
    for every size up to which items could fill the room that larger ones leave.
    """
    alone = sum(k for n, k in sizes.items() if float(n) * n > cost)
    rest = {n: k for n, k in sizes.items() if float(n) * n <= cost}
    bounds = [-(-sum(rest.values()) // documents), math.ceil(sum(float(n) * n * k for n, k in rest.items()) / cost - 1e-9)]
    ordered = sorted(rest)
    upto = list(itertools.accumulate((n * rest[n] for n in ordered), initial=0))
    count = list(itertools.accumulate((rest[n] for n in ordered), initial=0))
    half = bisect.bisect_right(ordered, tokens // 2)
    for j in range(half + 1):
        least = ordered[j] if j < half else tokens // 2 + 1
        large = bisect.bisect_right(ordered, tokens - least)
        large = max(large, half)
        mid_n, mid_sum = count[large] - count[half], upto[large] - upto[half]
        small_sum = upto[half] - upto[j]
        bounds.append(count[-1] - count[large] + mid_n + max(0, -(-(small_sum - (mid_n * tokens - mid_sum)) // tokens)))
    return alone + max(bounds)


def _pack(specs: dict[int, tuple[int, int, float]], rule: str, weights: tuple[float, float, float]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = itertools.chain.from_iterable(zip(*(c.to_pylist() for c in b.columns)) for b in batches)
        out: list[tuple] = []
        for (pack, share), items in itertools.groupby(rows, key=lambda r: (r[0], r[1])):
            fit = BestFit(*specs[pack], rule, weights)
            for _, _, n, doc, part, start in items:
                out.append((pack, f"{pack}-{share}-{fit.put(n)}", doc, part, start, n))
                if len(out) >= 20_000:
                    yield _batch(out)
                    out = []
        yield _batch(out)

    return run


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows)) if rows else [[] for _ in _OUT]
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(cols, _OUT)], schema=_OUT)


def pack_documents(
    docs: DataFrame,
    specs: DataFrame,
    vocabulary: str = DEFAULT_VOCABULARY,
    most_documents: int = DOCUMENTS,
    attention: float = ATTENTION,
    share_rows: int = 20_000,
    rule: str = "norm",
    weights: tuple[float, float, float] = (1.0, 0.1, 0.5),
) -> DataFrame:
    """(pack_id, container, doc_id, part, token_start, n_tokens): every text of a pack's language in containers.

    ``docs`` needs doc_id, text, lang; ``specs`` pack_id, capacity_tokens, lang
    (at most 1,000 rows). A container takes ``most_documents`` texts and an
    attention cost of ``attention`` times the squared capacity.
    """
    packs = bounded_rows(specs.select("pack_id", "capacity_tokens", "lang"), 1000, "pack_specs")
    for p in packs:
        if p.capacity_tokens is None or p.capacity_tokens < 1:
            raise ValueError(f"pack {p.pack_id}: capacity {p.capacity_tokens}")
    schema = "pack_id int, container string, doc_id long, part int, token_start int, n_tokens int"
    if not packs:
        return docs.sparkSession.createDataFrame([], schema)
    sized = cut(token_counts(docs.select("doc_id", language(F.col("lang")).alias("lang"), "text"), vocabulary).where("n_tokens > 0"), "token-counts")
    shares = max(1, -(-sized.count() // share_rows))
    spec = F.array(
        *[
            F.struct(F.lit(p.pack_id).cast("int").alias("pack_id"), F.lit(p.capacity_tokens).cast("int").alias("capacity"), F.lit(p.lang.lower() if p.lang else None).cast("string").alias("pack_lang"))
            for p in packs
        ]
    )
    fits = F.filter(spec, lambda s: s["pack_lang"].isNull() | (s["pack_lang"] == F.col("lang")))
    parts = (
        sized.select("doc_id", "n_tokens", F.explode(fits).alias("s"))
        .select("doc_id", F.col("n_tokens").alias("n"), "s.pack_id", "s.capacity")
        .select("pack_id", "doc_id", "n", "capacity", F.explode(F.sequence(F.lit(0), ((F.col("n") - 1) / F.col("capacity")).cast("int"))).alias("part"))
        .select(
            "pack_id",
            F.pmod(F.xxhash64("doc_id"), F.lit(shares)).cast("int").alias("share"),
            F.least("capacity", F.col("n") - F.col("part") * F.col("capacity")).alias("n_tokens"),
            "doc_id",
            "part",
            (F.col("part") * F.col("capacity")).alias("token_start"),
        )
    )
    groups = max(1, len(packs) * shares)
    capacities = {p.pack_id: (p.capacity_tokens, most_documents, attention * float(p.capacity_tokens) ** 2) for p in packs}
    return (
        parts.repartition(min(groups, 4 * docs.sparkSession.sparkContext.defaultParallelism), "pack_id", "share")
        .sortWithinPartitions("pack_id", "share", F.desc("n_tokens"), "doc_id", "part")
        .mapInArrow(_pack(capacities, rule, weights), schema)
    )


def fill_report(packed: DataFrame, specs: DataFrame, most_documents: int = DOCUMENTS, attention: float = ATTENTION) -> DataFrame:
    """Per pack: containers, items, tokens, fill, and the containers that no packing could do without.

    ``n_alone`` counts items above the attention limit on their own, ``n_over``
    containers above a limit for any other reason (always 0).
    """
    cost = F.sum(F.col("n_tokens").cast("double") * F.col("n_tokens"))
    per = packed.groupBy("pack_id", "container").agg(F.sum("n_tokens").alias("t"), F.count("*").alias("k"), cost.alias("c"))
    capacity = specs.select("pack_id", F.col("capacity_tokens").alias("cap"))
    limit = F.col("cap").cast("double") * F.col("cap") * F.lit(attention)
    report = (
        per.join(capacity, "pack_id")
        .groupBy("pack_id")
        .agg(
            F.first("cap").alias("capacity_tokens"), F.count("*").alias("n_containers"), F.sum("k").alias("n_items"), F.sum("t").alias("n_tokens"),
            F.sum(F.when((F.col("c") > limit) & (F.col("k") == 1), 1).otherwise(0)).alias("n_alone"),
            F.sum(F.when((F.col("t") > F.col("cap")) | (F.col("k") > most_documents) | ((F.col("c") > limit) & (F.col("k") > 1)), 1).otherwise(0)).alias("n_over"),
        )
        .withColumn("fill", F.col("n_tokens") / (F.col("n_containers") * F.col("capacity_tokens")))
    )
    # no more sizes a pack than its capacity has tokens
    sizes = packed.groupBy("pack_id", "n_tokens").agg(F.count("*").alias("k")).join(capacity, "pack_id")
    bounds = sizes.groupBy("pack_id", "cap").applyInPandas(_bounds(most_documents, attention), "pack_id int, least_containers long")
    return report.join(bounds, "pack_id")


def _bounds(most_documents: int, attention: float):
    def run(key: tuple, sizes):
        import pandas as pd

        cap = int(key[1])
        return pd.DataFrame({"pack_id": [key[0]], "least_containers": [lower_bound(dict(zip(sizes.n_tokens.tolist(), sizes.k.tolist())), cap, most_documents, attention * float(cap) ** 2)]})

    return run
