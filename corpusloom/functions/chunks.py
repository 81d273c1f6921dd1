"""Cutting texts into chunks, chunks into batches, and reading batched replies.

Everything is an expression over one row; the greedy folds carry positions and
lengths only and slice the text once at the end.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusloom.functions.text import strip

# Sizes in code points, the part separator and the empty marker.
MAX_CHUNK, WINDOW, OVERLAP = 4000, 3500, 200
SAFE_SINGLE, SAFE_BATCH = 12000, 12000
SEPARATOR = "=" * 20
PART_COST = len(SEPARATOR) + len("PART 0000") + 4
EMPTY_MARKER = "<!-- EMPTY_WEBPAGE_FRAGMENT -->"

_SPAN = "array<struct<start:int,len:int>>"


def _windows(start: Column, length: Column) -> Column:
    """Overlapping windows over ``length`` code points from ``start``: array of (start, len)."""
    stride = WINDOW - OVERLAP
    last = F.when(length <= WINDOW, F.lit(0)).otherwise(F.ceil((length - WINDOW) / F.lit(stride)).cast("int"))
    spans = F.transform(
        F.sequence(F.lit(0), last),
        lambda i: F.struct((start + i * stride).cast("int").alias("start"), F.least(F.lit(WINDOW), length - i * stride).cast("int").alias("len")),
    )
    return F.when(length > 0, spans).otherwise(F.array().cast(_SPAN))


def overlap_windows(text: Column) -> Column:
    """Spans of the overlapping windows of a whole text; none for an empty or null text."""
    return F.coalesce(_windows(F.lit(0), F.length(text)), F.array().cast(_SPAN))


def section_chunks(text: Column) -> Column:
    """Spans of chunks packed from sections that begin at heading marks.

    Sections are joined while they fit; one that is longer than a chunk is cut
    into overlapping windows. A text without headings is cut into windows.
    """
    sizes = F.transform(F.split(text, r"(?md)(?=^#+)"), lambda s: F.length(s))
    zero = F.struct(
        F.array().cast("array<struct<start:int,len:int,big:boolean>>").alias("out"), F.lit(0).alias("start"), F.lit(0).alias("len")
    )

    def flushed(a: Column) -> Column:
        one = F.array(F.struct(a["start"].alias("start"), a["len"].alias("len"), F.lit(False).alias("big")))
        return F.when(a["len"] > 0, F.concat(a["out"], one)).otherwise(a["out"])

    def step(a: Column, n: Column) -> Column:
        end = a["start"] + a["len"]
        big = F.struct(F.concat(flushed(a), F.array(F.struct(end.alias("start"), n.alias("len"), F.lit(True).alias("big")))).alias("out"), (end + n).alias("start"), F.lit(0).alias("len"))
        new = F.struct(flushed(a).alias("out"), end.alias("start"), n.alias("len"))
        more = F.struct(a["out"].alias("out"), a["start"].alias("start"), (a["len"] + n).alias("len"))
        return F.when(n > MAX_CHUNK, big).when((a["len"] > 0) & (a["len"] + n > MAX_CHUNK), new).otherwise(more)

    packed = F.aggregate(sizes, zero, step, flushed)
    spans = F.flatten(
        F.transform(packed, lambda c: F.when(c["big"], _windows(c["start"], c["len"])).otherwise(F.array(F.struct(c["start"].alias("start"), c["len"].alias("len")))))
    )
    return F.when(F.coalesce(text, F.lit("")) == "", F.array().cast(_SPAN)).when(F.rlike(text, F.lit("(?md)^#")), spans).otherwise(overlap_windows(text))


def slices(text: Column, spans: Column) -> Column:
    """The texts of spans."""
    return F.transform(spans, lambda s: F.substring(text, s["start"] + 1, s["len"]))


def batch_numbers(sizes: Column) -> Column:
    """Batch number, from 0, of each chunk: consecutive chunks while their costs fit a prompt."""
    zero = F.struct(F.array().cast("array<int>").alias("out"), F.lit(0).alias("no"), F.lit(0).alias("used"))

    def step(a: Column, n: Column) -> Column:
        cost = n + PART_COST
        new = (a["used"] > 0) & (a["used"] + cost > SAFE_BATCH)
        no = F.when(new, a["no"] + 1).otherwise(a["no"])
        return F.struct(F.concat(a["out"], F.array(no)).alias("out"), no.alias("no"), F.when(new, cost).otherwise(a["used"] + cost).alias("used"))

    return F.aggregate(sizes, zero, step, lambda a: a["out"])


def format_batch(chunks: Column) -> Column:
    """One prompt text of numbered parts."""
    return F.array_join(F.transform(chunks, lambda c, i: F.concat(F.lit(SEPARATOR + "\nPART "), (i + 1).cast("string"), F.lit("\n\n"), c)), "\n\n")


_HEADER = r"(?md)^={20}\s*\nPART\s+(\d+)\s*$"


def parse_batch(reply: Column, n: Column) -> Column:
    """The parts of a batched reply in their order, or null unless each of 1..n comes exactly once.

    Text before the first header is dropped, the empty marker becomes ''.
    """
    numbers = F.transform(F.regexp_extract_all(reply, F.lit(_HEADER), F.lit(1)), lambda x: x.try_cast("int"))
    bodies = F.transform(F.slice(F.split(reply, _HEADER), 2, 2_000_000), lambda b: F.when(strip(b) == EMPTY_MARKER, F.lit("")).otherwise(strip(b)))
    whole = (F.size(numbers) == n) & (F.size(F.array_distinct(numbers)) == n) & F.forall(numbers, lambda k: F.coalesce((k >= 1) & (k <= n), F.lit(False)))
    ordered = F.transform(F.array_sort(F.arrays_zip(numbers.alias("k"), bodies.alias("b"))), lambda z: z["b"])
    return F.when(whole, ordered)


def clean_one(text: Column, reply: Column) -> Column:
    """A single cleaning reply applied: none keeps the text, the marker empties it."""
    return F.when(F.coalesce(reply, F.lit("")) == "", text).when(strip(reply) == EMPTY_MARKER, F.lit("")).otherwise(reply)


def clean_batch(chunks: Column, reply: Column) -> Column:
    """A batched cleaning reply applied: chunks stay as they are if it is missing or can't be parsed."""
    return F.coalesce(parse_batch(reply, F.size(chunks)), chunks)
