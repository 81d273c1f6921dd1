"""Lines repeated across the documents of one source.

Method: lines are parsed into templates by fixed-depth token trees with
wildcard slots. The path of a line through the tree is (token count, first
three tokens, digits as wildcards); the leaf holds templates whose differing
tokens have become slots.

1. Every partition counts, per source, the documents that reach each leaf.
   Counts add up across partitions. A line's document count never exceeds its
   leaf's, so leaves below the thresholds are pruned without losing a line.
2. Lines of surviving leaves are parsed into templates, salted by line, with as
   many salts as a leaf has portions of ``_PORTION`` lines, so that one busy leaf
   is spread over tasks; the salted trees of a leaf are merged.
3. Each template's distinct documents are counted. Templates that cover too few
   are dropped. ``repeated_lines`` then checks the lines of the others exactly,
   by their own document count; ``template_lines`` keeps every line of a
   template that covers enough documents and has few slots.

Per source the number of surviving leaves is at most ``1 / min_share`` times
the mean number of lines of a document, so the list that is joined to the
documents stays small however large the source is; it is counted before it is
broadcast. Documents are never shuffled, the lines of surviving leaves are.

Defined results: null or empty text has no lines; a null source is a source of
its own; a line repeated within a document counts once for the document, yet
every occurrence is returned.
"""

from __future__ import annotations

import itertools
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.session import cut, small

_DIGITS = re.compile("[0-9]+")
_PORTION = 2_000
_SIMILAR = 0.6
_FLUSH = 300_000


def normal_lines(text: str) -> list[str]:
    """Lines of ``text`` trimmed, white space collapsed, lower-cased, digit runs as 0."""
    return [" ".join(x.split()) for x in _DIGITS.sub("0", text.lower()).split("\n")]


def leaf(line: str) -> int:
    """Signed 64-bit id of the tree leaf that ``line`` reaches."""
    n = line.count(" ") + 1
    head = line.split(" ", 3)[:3]
    path = " ".join("*" if "0" in x else x for x in head)
    return xxhash.xxh3_64_intdigest(f"{n} {path}") - (1 << 63)


def _count_leaves(min_len: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count: Counter = Counter()

        def out() -> pa.RecordBatch:
            keys = list(count)
            return pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.int64()), pa.array(list(count.values()), pa.int64())],
                names=["source", "leaf", "n_docs"],
            )

        for b in batches:
            for source, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if text:
                    count.update({(source, leaf(x)) for x in normal_lines(text) if len(x) >= min_len})
                    if len(count) > _FLUSH:
                        yield out()
                        count.clear()
        if count:
            yield out()

    return run


def _occurrences(min_len: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets: dict = {}
        for b in batches:
            rows: list[list] = [[], [], [], [], [], []]
            ids, sources, texts, leaves = (b.column(i) for i in range(4))
            for k, (i, source, text) in enumerate(zip(ids.to_pylist(), sources.to_pylist(), texts.to_pylist())):
                if not text:
                    continue
                keep = sets.get(source)
                if keep is None:
                    if len(sets) > 2000:
                        sets.clear()
                    keep = sets[source] = set(leaves[k].as_py())
                seen = set()
                for no, x in enumerate(normal_lines(text)):
                    if len(x) >= min_len and (f := leaf(x)) in keep:
                        first = x not in seen
                        seen.add(x)
                        for c, v in zip(rows, (i, no, source, f, x, int(first))):
                            c.append(v)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(rows, (pa.int64(), pa.int32(), pa.string(), pa.int64(), pa.string(), pa.int32()))],
                names=["doc_id", "line_no", "source", "leaf", "line", "first"],
            )

    return run


class LeafTemplates:
    """The templates of one leaf; tokens that differ between members become slots (None)."""

    def __init__(self) -> None:
        self.templates: list[list] = []
        self._of: dict[tuple, int] = {}
        self._at: dict[tuple, list[int]] = {}
        self._short: dict[int, list[int]] = {}

    def _candidates(self, tokens: list) -> Iterator[int]:
        """Templates that share a token behind the path, where one must be shared to be similar enough."""
        n = len(tokens)
        # the path's tokens alone, with slots in all other places, are not enough from six tokens on
        if n < 6:
            return iter(self._short.get(n, ()))
        count: Counter = Counter()
        for place in range(3, n):
            for key in ((place, tokens[place]), (place, None)):
                count.update(k for k in self._at.get((n, *key), ()))
        least = _SIMILAR * n - 3
        return (k for k, c in sorted(count.items()) if c >= least)

    def add(self, tokens: list) -> int:
        known = self._of.get(tuple(tokens))
        if known is not None:
            return known
        best, at = 0.0, -1
        for k in self._candidates(tokens):
            t = self.templates[k]
            same = sum(a is None or b is None or a == b for a, b in zip(t, tokens)) / len(t)
            if same > best:
                best, at = same, k
        if best >= _SIMILAR:
            old = self.templates[at]
            self.templates[at] = [a if a == b else None for a, b in zip(old, tokens)]
            for place, (a, b) in enumerate(zip(old, self.templates[at])):
                if a is not b and a is not None and place >= 3:
                    self._at.setdefault((len(old), place, None), []).append(at)
        else:
            at = len(self.templates)
            self.templates.append(tokens)
            self._short.setdefault(len(tokens), []).append(at)
            for place in range(3, len(tokens)):
                self._at.setdefault((len(tokens), place, tokens[place]), []).append(at)
        self._of[tuple(tokens)] = at
        return at


def _stream(batches: Iterator[pa.RecordBatch], key: int) -> Iterator[tuple]:
    rows = itertools.chain.from_iterable(zip(*(c.to_pylist() for c in b.columns)) for b in batches)
    yield from itertools.groupby(rows, key=lambda r: r[:key])


def _emit(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    cols = list(zip(*rows)) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(cols, schema)], schema=schema)


_TREE = pa.schema([("source", pa.string()), ("leaf", pa.int64()), ("salt", pa.int32()), ("tmpl", pa.int32()), ("line", pa.string()), ("n_docs", pa.int64()), ("template", pa.string())])
_MERGED = pa.schema([("source", pa.string()), ("leaf", pa.int64()), ("salt", pa.int32()), ("tmpl", pa.int32()), ("template", pa.string())])


def _build_trees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows (source, leaf, salt, line, n_docs) to line rows and, after each group, template rows."""
    out: list[tuple] = []
    for (source, lf, salt), rows in _stream(batches, 3):
        tree = LeafTemplates()
        for r in rows:
            out.append((source, lf, salt, tree.add(r[3].split(" ")), r[3], r[4], None))
            if len(out) >= 5000:
                yield _emit(out, _TREE)
                out = []
        for k, t in enumerate(tree.templates):
            out.append((source, lf, salt, k, None, None, " ".join("\x00" if x is None else x for x in t)))
    yield _emit(out, _TREE)


def _merge_trees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted template rows of all salts of a leaf to the merged template of each."""
    for (source, lf), rows in _stream(batches, 2):
        tree, at = LeafTemplates(), []
        for r in rows:
            tokens = [None if x == "\x00" else x for x in r[4].split(" ")]
            at.append((r[2], r[3], tree.add(tokens)))
        out = [(source, lf, salt, k, " ".join("<*>" if x is None else x for x in tree.templates[m])) for salt, k, m in at]
        yield _emit(out, _MERGED)


def _templates(docs: DataFrame, min_docs: int, min_share: float, min_len: int) -> tuple[DataFrame, DataFrame]:
    """(occurrences, lines): every line of a surviving leaf, and the lines of templates that cover enough documents, with counts."""
    docs = docs.select("doc_id", F.coalesce("source", F.lit("\x00")).alias("source"), "text")
    sizes = docs.groupBy("source").agg(F.count("*").alias("n_source"))
    often = lambda n: (F.col(n) >= min_docs) & (F.col(n) >= F.col("n_source") * F.lit(min_share))
    leaves = (
        docs.select("source", "text")
        .mapInArrow(_count_leaves(min_len), "source string, leaf long, n_docs long")
        .groupBy("source", "leaf")
        .agg(F.sum("n_docs").alias("n_docs"))
        .where(F.col("n_docs") >= min_docs)
        .join(sizes, "source")
        .where(often("n_docs"))
        .groupBy("source")
        .agg(F.collect_list("leaf").alias("leaves"))
    )
    leaves = small(cut(leaves, "repeated-leaves"), 100_000)
    occ = cut(
        docs.join(leaves, "source")
        .select("doc_id", "source", "text", "leaves")
        .mapInArrow(_occurrences(min_len), "doc_id long, line_no int, source string, leaf long, line string, first int"),
        "line-occurrences",
    )
    counted = cut(occ.groupBy("source", "leaf", "line").agg(F.sum("first").alias("n_docs")), "line-counts")
    portions = counted.groupBy("source", "leaf").agg(F.ceil(F.count("*") / _PORTION).cast("int").alias("portions"))
    lines = (
        counted.join(portions, ["source", "leaf"])
        .select("source", "leaf", F.pmod(F.xxhash64("line"), F.col("portions")).cast("int").alias("salt"), "line", "n_docs")
        .repartition("source", "leaf", "salt")
        .sortWithinPartitions("source", "leaf", "salt", F.desc("n_docs"), "line")
    )
    trees = cut(lines.mapInArrow(_build_trees, "source string, leaf long, salt int, tmpl int, line string, n_docs long, template string"), "line-trees")
    merged = (
        trees.where("template is not null")
        .select("source", "leaf", "salt", "tmpl", "template")
        .repartition("source", "leaf")
        .sortWithinPartitions("source", "leaf", "template", "salt", "tmpl")
        .mapInArrow(_merge_trees, "source string, leaf long, salt int, tmpl int, template string")
    )
    named = trees.where("line is not null").select("source", "leaf", "salt", "tmpl", "line", "n_docs").join(merged, ["source", "leaf", "salt", "tmpl"]).select("source", "leaf", "line", "template", "n_docs")
    named = cut(named, "line-templates")
    # a template of one line covers what the line does; only others need their documents counted
    several = named.groupBy("source", "leaf", "template").agg(F.count("*").alias("n_lines"), F.max("n_docs").alias("most"))
    joint = named.join(several.where("n_lines > 1").select("source", "leaf", "template"), ["source", "leaf", "template"], "left_semi")
    documents = occ.where("first = 1").join(joint.select("source", "leaf", "line", "template"), ["source", "leaf", "line"]).groupBy("source", "leaf", "template").agg(F.count_distinct("doc_id").alias("n_joint"))
    covers = several.join(documents, ["source", "leaf", "template"], "left").select("source", "leaf", "template", F.coalesce("n_joint", "most").alias("n_template")).join(sizes, "source").where(often("n_template"))
    return occ, named.join(covers, ["source", "leaf", "template"]).withColumn("often", often("n_docs"))


def _found(occ: DataFrame, lines: DataFrame) -> DataFrame:
    return occ.join(lines.select("source", "leaf", "line", "template", "n_docs", "n_template"), ["source", "leaf", "line"]).select(
        "doc_id", "line_no", F.when(F.col("source") != "\x00", F.col("source")).alias("source"), "template", "n_docs", "n_template"
    )


def repeated_lines(docs: DataFrame, min_docs: int = 4, min_share: float = 0.1, min_len: int = 25) -> DataFrame:
    """Occurrences (doc_id, line_no, source, template, n_docs, n_template) of lines repeated within a source.

    ``docs`` needs doc_id, source, text; other columns are ignored. A line is
    repeated if it occurs in at least ``min_docs`` documents and in at least
    ``min_share`` of the documents of its source; ``n_template`` counts the
    documents of its template.
    """
    occ, lines = _templates(docs, min_docs, min_share, min_len)
    return _found(occ, lines.where("often"))


def template_lines(docs: DataFrame, min_docs: int = 4, min_share: float = 0.1, min_len: int = 25, most_slots: float = 0.2) -> DataFrame:
    """As ``repeated_lines``, with the lines of templates that cover enough documents only together.

    Such a template has slots in at most ``most_slots`` of its tokens: sentences
    of one pattern about different things are no repetition.
    """
    occ, lines = _templates(docs, min_docs, min_share, min_len)
    tokens = F.split("template", " ")
    few = F.size(F.filter(tokens, lambda t: t == "<*>")) <= F.size(tokens) * F.lit(most_slots)
    return _found(occ, lines.where(F.col("often") | few))


def without_repeated_lines(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with a column clean_text that lacks the lines of repeated templates, and n_removed.

    A null text stays null. All other columns are kept as they are; columns
    named clean_text or n_removed are replaced.
    """
    gone = template_lines(docs, **options).groupBy(F.col("doc_id").alias("__rl_doc")).agg(F.collect_set("line_no").alias("__rl_gone"))
    lines = F.split(F.col("text"), "\n", -1)
    kept = F.array_join(F.filter(lines, lambda x, i: ~F.array_contains(F.col("__rl_gone"), i)), "\n")
    return (
        docs.join(gone, F.col("doc_id") == F.col("__rl_doc"), "left")
        .withColumn("clean_text", F.when(F.col("__rl_gone").isNull(), F.col("text")).otherwise(kept))
        .withColumn("n_removed", F.when(F.col("__rl_gone").isNull(), F.lit(0)).otherwise(F.size("__rl_gone")))
        .drop("__rl_gone", "__rl_doc")
    )
