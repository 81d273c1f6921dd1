"""Mixing sources to target weights.

Method: Efraimidis-Spirakis sampling. Every document gets the key -ln(u)/w
with u a hash of its id, the mix and the epoch, and w its quality weight; within
a source the keys are sorted and the token counts summed up to the source's
budget. Complete epochs precede the fractional selection: a source whose
budget is e whole times its size and a rest gives every document e times and
the first documents by key once more.

The total is the largest that every source can serve within its cap on
repeats, so that all targets are met; a given total keeps the caps and gives
what is there. Prefix sums never sort a source in one task: keys fall into
``buckets`` ranges of their distribution, the totals of the ranges are summed
first, and only inside a range are rows sorted. The ranges follow the keys'
expected distribution under the group's own weights, so they are of like size.

Defined results: source types are compared trimmed and in lower case; targets
without documents, with a null or non-positive share or cap get nothing, and
the other targets are scaled to add to 1; null and empty texts have no tokens
and are never chosen; no budget is exceeded. A document that would cross what is
left of a budget is passed over, and ``rounds`` more prefix sums over the
remaining documents that still fit use up what it left, in the order of keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusloom.llm.tokens import DEFAULT_VOCABULARY, token_counts
from corpusloom.session import bounded_rows, cut


def quality_weight(text: Column) -> Column:
    """From 0.1 to 1: share of letters and length up to 2,000 code points."""
    n = F.length(text)
    letters = F.length(F.regexp_replace(text, r"[^\p{L}]+", ""))
    return F.round(F.lit(0.1) + F.lit(0.9) * (letters / F.greatest(n, F.lit(1))) * F.least(n / F.lit(2000.0), F.lit(1.0)), 6)


def _key(*parts: Column) -> Column:
    """Uniform in (0, 1) from a hash."""
    return (F.pmod(F.xxhash64(*parts), F.lit(1 << 52)) + F.lit(0.5)) / F.lit(float(1 << 52))


def plan_mixes(sizes: list[tuple[str, int]], targets: list[tuple[int, str, float, int]], total: dict[int, int] | None = None) -> list[tuple[int, str, str, float, int, int, int, int]]:
    """(mix_id, named type, type, share, size, budget, whole epochs, rest) of each target."""
    by_type = dict(sizes)
    out = []
    for mix in sorted({t[0] for t in targets}):
        own = [(n, (n or "").strip().lower(), s or 0.0, r or 0) for m, n, s, r in targets if m == mix]
        usable = [(k, s, r) for _, k, s, r in own if s > 0 and r > 0 and by_type.get(k, 0) > 0]
        weight = sum(s for _, s, _ in usable)
        feasible = min((by_type[k] * r / (s / weight) for k, s, r in usable), default=0)
        want = feasible if total is None or mix not in total else total[mix]
        for named, k, s, r in own:
            size, share = by_type.get(k, 0), (s / weight if weight and (k, s, r) in usable else 0.0)
            budget = min(int(want * share + 1e-6), size * r) if share else 0
            out.append((mix, named, k, share, size, budget, budget // size if size else 0, budget % size if size else 0))
    return out


_GROUP = ["mix_id", "source_type"]
_CLASSES = 20


def weight_classes(sized: DataFrame) -> dict[str, list[float]]:
    """Per kind the share of its documents in each of ``_CLASSES`` classes of weight."""
    at = F.least(F.floor(F.col("weight") * _CLASSES), F.lit(_CLASSES - 1)).cast("int")
    out: dict[str, list[float]] = {}
    for r in bounded_rows(sized.groupBy("kind", at.alias("c")).agg(F.count("*").alias("n")), 10_000 * _CLASSES, "weight classes"):
        out.setdefault(r.kind, [0.0] * _CLASSES)[r.c] += r.n
    return {k: [x / sum(v) for x in v] for k, v in out.items()}


def range_of(key: Column, shares: Column, buckets: int) -> Column:
    """The range of a key: its place in the distribution of the keys of documents with these weights; grows with the key."""
    term = F.zip_with(shares, F.sequence(F.lit(0), F.lit(_CLASSES - 1)), lambda f, c: f * F.exp(-key * (c + 0.5) / _CLASSES))
    below = F.lit(1.0) - F.aggregate(term, F.lit(0.0), lambda a, x: a + x)
    return F.least(F.floor(F.lit(buckets) * F.greatest(below, F.lit(0.0))), F.lit(buckets - 1)).cast("int")


def _within_budget(keyed: DataFrame, left: DataFrame) -> DataFrame:
    """Rows whose running token count, in the order of keys, stays within what is left of their group's budget."""
    fitting = keyed.join(left, _GROUP).where("n_tokens <= left")
    ranges = fitting.groupBy(*_GROUP, "bucket").agg(F.sum("n_tokens").alias("in_range"))
    earlier = F.sum("in_range").over(Window.partitionBy(*_GROUP).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))
    before = ranges.select(*_GROUP, "bucket", F.coalesce(earlier, F.lit(0)).alias("before"))
    inside = Window.partitionBy(*_GROUP, "bucket").orderBy("key", "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    running = fitting.join(before, [*_GROUP, "bucket"]).withColumn("upto", F.col("before") + F.sum("n_tokens").over(inside))
    return running.where("upto <= left").select(*_GROUP, "doc_id", "n_tokens")


def mix_documents(docs: DataFrame, targets: DataFrame, vocabulary: str = DEFAULT_VOCABULARY, total: dict[int, int] | None = None, buckets: int = 1024, rounds: int = 2) -> tuple[DataFrame, DataFrame]:
    """The chosen documents (mix_id, source_type, doc_id, n_tokens, copies) and the report of shares.

    ``docs`` needs doc_id, source_type, text; ``targets`` mix_id, source_type,
    target_share, max_repeats (at most 10,000 rows; the number of source types
    is bounded the same way).
    """
    spark = docs.sparkSession
    kind = F.lower(F.trim("source_type"))
    sized = cut(
        token_counts(docs.select("doc_id", kind.alias("kind"), quality_weight(F.col("text")).alias("weight"), "text"), vocabulary).where("n_tokens > 0 and kind is not null"),
        "mix-sizes",
    )
    rows = [(r.mix_id, r.source_type, r.target_share, r.max_repeats) for r in bounded_rows(targets.select("mix_id", "source_type", "target_share", "max_repeats"), 10_000, "mix_targets")]
    sizes = [(r.kind, int(r.n)) for r in bounded_rows(sized.groupBy("kind").agg(F.sum("n_tokens").alias("n")), 10_000, "source types")]
    plan = plan_mixes(sizes, rows, total)
    plan_schema = "mix_id int, source_type string, kind string, target_share double, available_tokens long, budget long, epochs long, rest long"
    per_target = spark.createDataFrame(plan, plan_schema) if plan else spark.createDataFrame([], plan_schema)
    entries = [p for p in plan if p[5] > 0]
    classes = weight_classes(sized) if entries else {}
    if not entries:
        chosen = spark.createDataFrame([], "mix_id int, source_type string, doc_id long, n_tokens int, copies int")
    else:
        wanted = F.array(
            *[
                F.struct(F.lit(m).cast("int").alias("mix_id"), F.lit(named).alias("source_type"), F.lit(k).alias("k"), F.lit(e).cast("long").alias("epochs"), F.lit(rest).cast("long").alias("rest"), F.array(*map(F.lit, classes[k])).alias("shares"))
                for m, named, k, _, _, _, e, rest in entries
            ]
        )
        keyed = (
            sized.select("doc_id", "kind", "weight", "n_tokens", F.explode(F.filter(wanted, lambda s: s["k"] == F.col("kind"))).alias("s"))
            .select("doc_id", "weight", "n_tokens", "s.mix_id", "s.source_type", "s.epochs", "s.shares")
            .withColumn("key", -F.log(_key(F.col("doc_id"), F.col("mix_id"), F.col("epochs"))) / F.col("weight"))
            .withColumn("bucket", range_of(F.col("key"), F.col("shares"), buckets))
            .drop("shares")
        )
        keyed = cut(keyed, "mix-keys")
        left = spark.createDataFrame([(m, named, rest) for m, named, _, _, _, _, _, rest in entries], "mix_id int, source_type string, left long")
        extra = cut(_within_budget(keyed, left), "mix-first")
        for k in range(rounds):
            used = extra.groupBy(*_GROUP).agg(F.sum("n_tokens").alias("used"))
            open_ = left.join(used, _GROUP, "left").select(*_GROUP, (F.col("left") - F.coalesce("used", F.lit(0))).alias("left")).where("left > 0")
            more = _within_budget(keyed.join(extra.select(*_GROUP, "doc_id"), [*_GROUP, "doc_id"], "left_anti"), open_)
            extra = cut(extra.union(more), f"mix-more-{k}")
        chosen = (
            keyed.join(extra.select(*_GROUP, "doc_id", F.lit(1).alias("once")), [*_GROUP, "doc_id"], "left")
            .withColumn("copies", (F.col("epochs") + F.coalesce("once", F.lit(0))).cast("int"))
            .where("copies > 0")
            .select("mix_id", "source_type", "doc_id", "n_tokens", "copies")
        )
    got = chosen.groupBy("mix_id", "source_type").agg(F.sum(F.col("n_tokens") * F.col("copies")).alias("tokens"), F.count("*").alias("n_documents"), F.max("copies").alias("most_copies"))
    by_mix = Window.partitionBy("mix_id")
    report = (
        per_target.join(got, ["mix_id", "source_type"], "left")
        .na.fill(0, ["tokens", "n_documents", "most_copies"])
        .withColumn("actual_share", F.coalesce(F.col("tokens") / F.nullif(F.sum("tokens").over(by_mix), F.lit(0)), F.lit(0.0)))
        .select("mix_id", "source_type", "target_share", "actual_share", "available_tokens", "budget", "tokens", "n_documents", "most_copies")
    )
    return chosen, report
