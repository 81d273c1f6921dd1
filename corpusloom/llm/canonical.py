"""Mapping freely typed values to the entries of a reference list.

Method: a BK-tree over the normal forms of the reference entries under the
Levenshtein distance, a true metric, so that the triangle inequality prunes
the search yet every entry within the threshold is returned. A small radius is
searched first; what it finds bounds how far an entry can be and still matter.
Distinct values are mapped once, however often they occur, and joined back to
their occurrences.

A list of up to ``most_entries`` is held whole by every task. A larger one is
cut into shards of that size by a hash of the id: every shard's tree is
searched for a bounded portion of the values at a time, the two best entries
of each shard are kept, and the winners of the shards are merged.

A value is brought to candidate forms first (wrappers and list marks removed,
word order, abbreviated words), each is searched within a threshold that grows
with its length, and the entry with the smallest relative distance wins. Ties
between different entries mean that the value is not understood.

Defined results: null, empty and white-space values are no cases; a value
that is letter for letter a name of its list is no case; -1 if none is meant.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.session import bounded_rows, small


def pattern(a: str) -> tuple[dict[str, int], int]:
    """Bit masks of a word's letters and its length, for ``distance``."""
    peq: dict[str, int] = {}
    for k, c in enumerate(a):
        peq[c] = peq.get(c, 0) | 1 << k
    return peq, len(a)


def distance(p: tuple[dict[str, int], int], b: str) -> int:
    """Levenshtein distance of the pattern's word and ``b``, by bit-parallel rows."""
    peq, m = p
    if not m or not b:
        return m or len(b)
    full, top = (1 << m) - 1, 1 << m - 1
    pv, mv, score = full, 0, m
    for c in b:
        eq = peq.get(c, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | ~(xh | pv) & full
        mh = pv & xh
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
        ph = (ph << 1 | 1) & full
        pv = (mh << 1 & full) | ~(xv | ph) & full
        mv = ph & xv
    return score


def levenshtein(a: str, b: str) -> int:
    return distance(pattern(a), b)


class BKTree:
    """Words with the ids they stand for; children by their distance to the parent."""

    def __init__(self) -> None:
        self.root: list | None = None

    def add(self, word: str, ref: int) -> None:
        if self.root is None:
            self.root = [word, {ref}, {}]
            return
        node = self.root
        while True:
            d = levenshtein(word, node[0])
            if d == 0:
                node[1].add(ref)
                return
            if d not in node[2]:
                node[2][d] = [word, {ref}, {}]
                return
            node = node[2][d]

    def within(self, word: str, most: int) -> list[tuple[int, str, set[int]]]:
        """(distance, entry, ids) of every entry at most ``most`` edits away."""
        found, todo = [], [self.root] if self.root else []
        p = pattern(word)
        while todo:
            w, refs, children = todo.pop()
            d = distance(p, w)
            if d <= most:
                found.append((d, w, refs))
            for k, child in children.items():
                if d - most <= k <= d + most:
                    todo.append(child)
        return found


_ASCII = str.maketrans({"ı": "i", "İ": "i", "I": "i", "ß": "ss", "æ": "ae", "ø": "o", "ł": "l"})
_PREFIX = re.compile(r"^(?:the|a kind of|kind of|a type of|type|tur|typ|a|an|some sort of|sort of|eine art|art von|bir tur|subtype|alt tur|category|kategori|kategorie)\b[\s:_/-]+", re.I)
_NUMBER = re.compile(r"^\s*[(\[]?\d{1,3}[.):\]]\s*")
_SUFFIX = re.compile(r"(?:[\s,;/*_\-]+|\b)(?:etc\.?|misc\.?|general|vb\.?|vs\.?|usw\.?|other|others|diger|genel|\(\?\)|\?+)$", re.I)
_AND = re.compile(r"\s*[&+]\s*")
_EDGE = " \t\r\n\"'“”„«»`()[]{}<>.,;:!?*/\\|-_–—+#~=•"


def fold(value: str) -> str:
    """Lower case, without diacritics, compatibility forms resolved."""
    value = value.translate(_ASCII).lower()
    return "".join(c for c in unicodedata.normalize("NFKD", value) if not unicodedata.combining(c))


def _strip(value: str) -> str:
    """Without wrappers, numbering and words that say nothing."""
    for _ in range(6):
        before = value
        value = value.strip(_EDGE)
        value = _NUMBER.sub("", value)
        value = _PREFIX.sub("", value)
        value = _SUFFIX.sub("", value).rstrip(" ,;/*-_")
        m = re.fullmatch(r"(.*?)\s*\((?:general|misc|etc|\?|genel|other)\)\W*", value)
        if m:
            value = m[1]
        if value == before:
            break
    return value


def forms(value: str) -> list[str]:
    """Candidate normal forms of a typed value; the first is the plainest."""
    value = re.sub("[​-‍﻿­]", "", value)
    # words run together in camel case
    if re.search(r"[a-zçğıöşü][A-ZÇĞİÖŞÜ]", value) and not re.search(r"\s\w+\s", value):
        value = re.sub(r"(?<=[a-zçğıöşü])(?=[A-ZÇĞİÖŞÜ])", " ", value)
    low = _strip(fold(value.replace("_", " ")))
    out = []

    def add(x: str) -> None:
        key = "".join(c for c in x if c.isalnum())
        if key and key not in out:
            out.append(key)

    joined = _AND.sub(" and ", low)
    add(joined)
    if "&" in low or "+" in low:
        add(_AND.sub(" ve ", low))
    if "," in low:
        head, _, tail = low.partition(",")
        tail = _strip(tail)
        add(f"{tail} {head}")
        add(f"{head} and {tail}")
        add(f"{head} ve {tail}")
    if out and low.endswith("s") and len(low) > 4:
        add(joined.rstrip("s"))
    # wrappers that are misspelt themselves
    if ":" in value[:9]:
        add(_strip(fold(value.partition(":")[2].replace("_", " "))))
    for mark in "(/;*":
        head, _, tail = low.partition(mark)
        if len(head) > 5 and 0 < len(tail) <= 9:
            add(_strip(head))
    key = "".join(c for c in fold(value) if c.isalnum())
    for n in (6, 7, 8):
        if len(key) > n + 3 and levenshtein(key[:n], "akindof") <= 2:
            add(_strip(key[n:]))
    return out


def _abbreviations(entry: str) -> Iterator[str]:
    """Forms of an entry with one long word cut after four to six letters."""
    ws = [w for w in re.split(r"[^\w]+", fold(entry)) if w]
    for k, w in enumerate(ws):
        for n in (3, 4, 5, 6):
            if len(w) > n + 1:
                short = ws[:k] + [w[:n]] + ws[k + 1 :]
                yield "".join(short)
                if len(ws) > 1:
                    yield "".join([short[-1], *short[:-1]])


_FAR = 0.28
_CLEARLY = 0.06  # how much farther every other entry must be for a far one to count


class Matcher:
    """Trees over one reference list: (id, name, other names)."""

    def __init__(self, entries: list[tuple[int, str, list[str]]]) -> None:
        self.names = {name for _, name, _ in entries}
        self.tree, self.short = BKTree(), BKTree()
        for ref, name, others in sorted(entries):
            for x in [name, *others]:
                ws = [w for w in re.split(r"[^\w]+", fold(x)) if w]
                self.tree.add("".join(ws), ref)
                if len(ws) > 1:
                    self.tree.add("".join([ws[-1], *ws[:-1]]), ref)
                    self.tree.add("".join(sorted(ws)), ref)
                for a in _abbreviations(x):
                    self.short.add(a, ref)

    @staticmethod
    def limit(n: int) -> int:
        """Most edits that a form of ``n`` letters may differ by."""
        return 0 if n < 3 else 1 if n < 5 else 2 if n < 8 else 3 if n < 10 else round(n * 0.4)

    def best(self, value: str) -> list[tuple[float, int]]:
        """(cost, id) of the two best entries within the threshold, best first."""
        best: dict[int, float] = {}
        dotted = re.search(r"\w\.\W*\w", value) is not None
        searches = []
        for k, key in enumerate(forms(value)):
            most = self.limit(len(key))
            searches.append((key, self.tree, most, 0.01 * (k > 0)))
            if dotted:
                searches.append((key, self.short, min(3, most), 0.01 * (k > 0) + 0.02))
        # a small radius first; what it finds bounds how far an entry can be and still matter
        for share in (0.34, 1.0):
            for key, tree, most, extra in searches:
                radius = most if share == 1.0 else int(most * share)
                if best:
                    c = min(best.values()) + _CLEARLY - extra
                    radius = min(most, int(c * len(key) / (1 - c) + 1e-9)) if 0 <= c < 1 else most if c >= 1 else -1
                for d, w, refs in tree.within(key, radius) if radius >= 0 else ():
                    cost = d / max(len(key), len(w)) + extra
                    for r in refs:
                        if cost < best.get(r, 9):
                            best[r] = cost
        return sorted((c, r) for r, c in best.items())[:2]

    def find(self, value: str) -> int:
        """The id meant, or -1."""
        return decide(self.best(value))


def decide(best: list[tuple[float, int]]) -> int:
    """The id meant by the best entries, or -1.

    Beyond a relative distance of 0.28 the best entry counts only if every
    other entry is clearly farther away.
    """
    if not best:
        return -1
    (least, ref), *others = best
    second = others[0][0] if others else 1.0
    return -1 if second - least < 1e-9 or (least > _FAR and second - least < _CLEARLY) else ref


def _map(lists: dict[str, list[tuple[int, str, list[str]]]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matchers = {k: Matcher(v) for k, v in lists.items()}
        for b in batches:
            kinds, values = b.column(0).to_pylist(), b.column(1).to_pylist()
            refs = [matchers[k].find(v) for k, v in zip(kinds, values)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(refs, pa.int32())], names=["field_kind", "value", "ref_id"])

    return run


_PORTION = 20_000  # values that a shard searches at a time


def _search_shard(key: tuple, values, entries):
    """The two best entries of one shard for each of a portion of the values."""
    import pandas as pd

    m = Matcher([(int(r), n, list(o) if o is not None else []) for r, n, o in zip(entries.ref, entries.name, entries.others)])
    rows = [(v, c, r) for v in values.value for c, r in m.best(v)]
    return pd.DataFrame(rows, columns=["value", "cost", "ref"]).astype({"value": "object", "cost": "float64", "ref": "int32"})


def _map_sharded(values: DataFrame, kind: str, entries: DataFrame, most_entries: int) -> DataFrame:
    """(field_kind, value, ref_id) of distinct ``values`` over a list (ref, name, others) of any size."""
    shards = -(-entries.count() // most_entries)
    portions = max(1, -(-values.count() // _PORTION))
    shard = F.pmod(F.xxhash64("ref"), F.lit(shards)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = values.select("value", F.pmod(F.xxhash64("value"), F.lit(portions)).cast("int").alias("portion"), every(shards).alias("shard"))
    right = entries.select("ref", "name", "others", shard.alias("shard"), every(portions).alias("portion"))
    found = left.groupBy("shard", "portion").cogroup(right.groupBy("shard", "portion")).applyInPandas(_search_shard, "value string, cost double, ref int")
    best = found.groupBy("value").agg(F.slice(F.array_sort(F.collect_list(F.struct("cost", "ref"))), 1, 2).alias("b"))
    gap = F.coalesce(F.get("b", F.lit(1))["cost"], F.lit(1.0)) - F.col("b")[0]["cost"]
    ref = F.when((gap < 1e-9) | ((F.col("b")[0]["cost"] > _FAR) & (gap < _CLEARLY)), F.lit(-1)).otherwise(F.col("b")[0]["ref"])
    return values.join(best, "value", "left").select(F.lit(kind).alias("field_kind"), "value", F.coalesce(ref, F.lit(-1)).cast("int").alias("ref_id"))


def map_values(occurrences: DataFrame, lists: dict[str, DataFrame], most_entries: int = 20_000) -> DataFrame:
    """``occurrences`` (field_kind, value, ...) with ref_id for every value to be mapped.

    ``lists`` gives for each field_kind a DataFrame (id, name, alt_names), held
    by every task up to ``most_entries`` rows and searched in shards beyond.
    Occurrences whose value is null, blank or exactly a name of the list are
    left out.
    """
    entries: dict[str, list] = {}
    large: dict[str, DataFrame] = {}
    names = None
    for kind, df in lists.items():
        known = df.select(*[F.col(c).alias(n) for c, n in zip(df.columns, ("ref", "name", "others"))]).where("name <> ''")
        if known.count() > most_entries:
            large[kind] = known.select("ref", "name", F.filter(F.coalesce("others", F.array().cast("array<string>")), lambda x: x.isNotNull() & (x != "")).alias("others"))
        else:
            entries[kind] = [(r.ref, r.name, [x for x in r.others or [] if x]) for r in bounded_rows(known, most_entries, kind)]
        own = known.select(F.lit(kind).alias("field_kind"), F.col("name").alias("value")).distinct()
        names = own if names is None else names.union(own)
    open_values = occurrences.where(F.col("value").isNotNull() & F.col("value").rlike(r"(?U)\S") & F.col("field_kind").isin(list(lists)))
    open_values = open_values.join(small(names, most_entries * len(lists)), ["field_kind", "value"], "left_anti")
    sc = occurrences.sparkSession.sparkContext
    distinct = open_values.select("field_kind", "value").distinct()
    # few bytes but much work a row: spread by rows, or they would be merged into one task
    spread = distinct.where(F.col("field_kind").isin(list(entries))).repartition(max(8, 3 * sc.defaultParallelism))
    mapped = spread.mapInArrow(_map(entries), "field_kind string, value string, ref_id int")
    for kind, df in large.items():
        mapped = mapped.union(_map_sharded(distinct.where(F.col("field_kind") == kind).select("value"), kind, df, most_entries))
    return open_values.join(mapped, ["field_kind", "value"])


def decision_values(decisions: DataFrame) -> DataFrame:
    """(decision_id, field_kind, item_pos, value) of the freely typed names of every decision, once each."""

    def named(kind: str, pos: Column, value: Column) -> Column:
        return F.struct(F.lit(kind).alias("field_kind"), pos.cast("int").alias("item_pos"), value.alias("value"))

    own = F.array(named("type", F.lit(0), F.col("entity_type.name")), named("subtype", F.lit(0), F.col("entity_type.subtype")))
    items = F.transform(F.coalesce("information_to_collect", F.array().cast("array<struct<name:string,priority:int>>")), lambda x, i: named("information", i, x["name"]))
    return decisions.select("decision_id", F.inline(F.concat(own, items))).where("value is not null").distinct()
