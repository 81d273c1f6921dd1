"""Template residue: unfilled slots, filler, error pages and demands for scripts.

Method: records of the same template are aligned.

Whole pages. A line's skeleton is the line with the page's own names, address
and numbers as slots. A page is a message, not content, if every one of its
lines has a skeleton that stands, on pages of nothing but such lines, on at
least ``min_pages`` pages and a small share of all, under different addresses,
and not more often in ordinary pages. No wording decides. Copies of an article keep its address, so
their lines do not count as different. Whether a message is an error or a
demand for scripts is voted: lines that name the web's own terms for scripts
or carry a status code vote first, and the lines that share pages follow.

Slots. A line with a slot that shows its variable ({{name}} and the like) is
split there into a template and a value. The slot is induced if the same
template has different values in other records, if the value's wrapping comes
with different names, or if the slot is the whole field. Lines whose slot shows
nothing but a name in capitals, snake or camel case, an unset value or a blank
are aligned with all lines of the same label or skeleton: where at least
``min_pages`` records fill the slot with different values, and no fewer than
leave it so, the record is a placeholder.

Filler is dummy copy by its structure: one phrase over and over, keyboard runs,
or words of dummy text without the function words of prose.

Only hashes leave the first stage. A page's longest line decides first whether
the page can be a message, so one row a document is shuffled; the few that are
left are compared line by line.

Defined results: null and empty texts are no residue by their text (a title
with an unfilled slot still counts); a document gets one kind, in the order
script or error (whole page), placeholder, filler; rows without a doc_id are
left out.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusloom.llm.slots import find_slots, without_code
from corpusloom.session import cut, small

# The web's own terms for what a page may demand, and its status codes.
_SCRIPT = ("javascript", "script", "cookie", "captcha")
_STATUS = re.compile(r"(?<!\d)[45]\d\d(?!\d)")
_TAG = re.compile(r"<[^<>\n]+>|^#{1,6}\s+|^=+\s*|\s*=+$|[*_]{2,}")
_QUOTED = re.compile(r"[\"“„«'][^\"”“„»'\n]+[\"”“»']")
_NAME = re.compile(r"\b[A-ZÇĞİÖŞÜÄ]\w*(?:[ /][A-ZÇĞİÖŞÜÄ]\w*)*")

# Words of dummy copy and keyboard runs.
_DUMMY = frozenset("lorem ipsum dolor amet consectetur adipiscing elit sed tempor incididunt asdf asdfg asdfgh qwer qwert qwerty zxcv zxcvb hjkl jkl blah bla foo bar baz test dummy".split())
_DUMMY_START = re.compile(r"\s*(?:lorem ipsum\b|x{6,}|asdf|qwer|zxcv)", re.I)
_REPEAT = re.compile(r"\W*(\S.{4,}?)(?:[\s.,;]+\1)+(?!\w)")
_FUNCTION = frozenset("the a an of and to in is was for with by on at that this ve bir ile için bu da de ki der die das und von im ist mit den ein eine wird".split())
_WORDS = re.compile(r"[^\W\d_]+")


def is_filler(line: str) -> bool:
    """Whether a line is dummy copy: keyboard runs, pseudo-Latin or one phrase over and over."""
    if len(line) < 10:
        return False
    # a phrase said over and over has few different words
    ws = line.split()
    m = _REPEAT.match(line) if len(set(ws)) <= 0.7 * len(ws) else None
    if m and m.end() - m.start() >= 0.6 * len(line.strip()) and " " in m[1].strip():
        return True
    start = _DUMMY_START.match(line)
    low = line.lower()
    if not start and "ipsum" not in low and "asdf" not in low and "zxcv" not in low and "blah" not in low and "qwer" not in low and " test " not in low:
        return False
    ws = _WORDS.findall(low)
    hits = sum(w in _DUMMY or (len(w) > 5 and len(set(w)) == 1) for w in ws)
    prose = sum(w in _FUNCTION for w in ws)
    return hits >= 2 and prose <= 0.08 * len(ws) and (bool(start) or hits >= 0.25 * len(ws) or (len(ws) >= 12 and len(set(ws)) < 0.7 * len(ws)))


def skeleton(line: str, own: list[str]) -> str:
    """The line's template: its own title and names, quoted parts and numbers as slots."""
    for x in own:
        if x and x in line:
            line = line.replace(x, "<*>")
    line = _QUOTED.sub("<*>", line)
    head, rest = line[:1], line[1:]
    line = head + _NAME.sub("<*>", rest)
    return re.sub(r"<\*>(?: <\*>)+", "<*>", re.sub(r"\d+", "<*>", " ".join(line.split())).lower())


_UNSET = re.compile(r"(?<!\w)(?:undefined|null|NaN|None|nil|\[object Object\])(?!\w)")
_NAMED = re.compile(r"[a-z]+(?:_[a-z0-9]+)+|[a-z]+(?:[A-Z][a-z]+)+")
# A variable's name in running text: capitals, snake or camel case.
_NAME_IN = re.compile(r"(?<![\w@./#-])(?:[A-ZÇĞİÖŞÜÄ]{4,}(?:_[A-Z0-9]+)*|[a-z]+(?:_[a-z0-9]+)+|[a-z]{2,}(?:[A-Z][a-z]+)+)(?![\w@/-])")
_LABEL = re.compile(r"\W*([^\W\d_][^:]{0,60}?)\W*:(?!//)\W{0,3}?(?: |$)(.*)")
_UNSET_WORDS = ("undefined", "null", "NaN", "None", "nil", "[object Object]")
_LIST = re.compile(r"\s*(?:[-*+•»›·|]|\d{1,2}[.)])\s")


def template(line: str, own: list[str]) -> tuple[str, str, str | None]:
    """(template, value, what the slot keeps if it was not filled: "unset", "name" or "blank")."""
    plain = " ".join(_TAG.sub(" ", line).split())
    m = _LABEL.match(plain)
    if m and len(m[1].split()) <= 5:
        label, value = m[1].lower(), m[2].strip("*_' ")
        kept = "blank" if not value else "unset" if _UNSET.fullmatch(value) else "name" if _NAMED.fullmatch(value) or value == label else None
        return label + ":", value, kept
    kept = "unset" if _UNSET.search(plain) else "name" if _names(plain) else None
    return skeleton(_NAME_IN.sub("0", _UNSET.sub("0", plain)) if kept else plain, own), plain, kept


_MAYBE_NAME = re.compile(r"[A-ZÇĞİÖŞÜÄ]{4}|[a-z]{2}[A-Z]")


def _names(plain: str) -> bool:
    """Whether a line of prose, most of it in small letters, holds a variable's name."""
    return _NAME_IN.search(plain) is not None and 2 * sum(x[:1].islower() for x in plain.split()) > plain.count(" ")


def _short_value(line: str) -> bool:
    """Whether a line can be a label with a name or nothing for its value."""
    return ":" in line and len(line.partition(":")[2].split()) <= 6


def unfilled(text: str, own: list[str]) -> dict[str, int]:
    """Templates of which ``text`` leaves a slot unfilled, if other records fill it, and the hash of the line in small letters."""
    out: dict[str, int] = {}
    words = [w for w in _UNSET_WORDS if w in text]
    names = ("_" in text or _MAYBE_NAME.search(text) is not None) and _NAME_IN.search(text) is not None
    if not words and not names and not (":" in text and any(map(_short_value, text.split("\n")))):
        return out
    lines = without_code(text).split("\n")
    for k, x in enumerate(lines):
        if not _short_value(x) and not any(w in x for w in words) and not (names and ("_" in x or _MAYBE_NAME.search(x)) and _NAME_IN.search(x)):
            continue
        key, value, kept = template(x, own)
        after = lines[k + 1] if k + 1 < len(lines) else ""
        # what follows a label without a value may be its value: a list or text in the next line
        if kept and anchor(key) and (kept != "blank" or not after.strip() or not _LIST.match(after) and _LABEL.match(after)):
            out[key] = _hash(_low(value))
    return out


def _own(*names: str | None) -> list[str]:
    return sorted({x.strip() for x in names if x and len(x.strip()) > 2}, key=len, reverse=True)


def _slug(url: str | None) -> str:
    return re.sub(r"[?#].*", "", url or "").rstrip("/").rsplit("/", 1)[-1].removesuffix(".html")


_VALUES = pa.schema([("line", pa.int64()), ("value", pa.int64())])


def _hash(s: str) -> int:
    return xxhash.xxh3_64_intdigest(s) - (1 << 63)


_PLAIN = str.maketrans("ışçğüöâîûäéèáàê", "iscguoaiuaeeaae")


def _low(x: str) -> str:
    return " ".join(x.lower().replace("i̇", "i").split())


def page_names(title: str | None, entity: str | None, url: str | None) -> list[str]:
    """The page's own names as its lines may show them: spelled out or as in an address."""
    out: set[str] = set()
    for x in (title, entity, _slug(url)):
        if x and len(x.strip()) > 2:
            low = _low(x)
            out |= {low, low.translate(_PLAIN), *(re.sub(r"\s", c, low.translate(_PLAIN)) for c in "-_")}
    return sorted(out, key=lambda x: (-len(x), x))


def address(title: str | None, url: str | None) -> str:
    """By what a page is known, whatever its host: the last part of its address without a counter, or its title."""
    return re.sub(r"[-_]?\d+$", "", _low(_slug(url)).translate(_PLAIN)) or _low((title or "").replace("&nbsp;", " ").partition(" | ")[0])


def page_lines(low: str, names: list[str]) -> list[str]:
    """Skeletons of the lines, of a page in small letters, that are more than its own name."""
    for x in names:
        if x in low:
            low = low.replace(x, "\x01")
    low = re.sub(r"\d+", "0", low)
    out = []
    for line in low.split("\n"):
        if "<" in line or "=" in line or "#" in line or "*" in line or "_" in line:
            line = _TAG.sub(" ", line.strip())
        line = " ".join(line.split())
        if line and line != "\x01":
            out.append(line)
    return out


_NAME_OF = re.compile(r"[^\W\d]\w*")


def slots_of(text: str, names: list[str]) -> list[tuple[int, int, int, int, bool]]:
    """Slots of ``text`` that show their variable: hashes of template, value, wrapping and name, and whether the slot is the whole line."""
    out = []
    if not find_slots(text):
        return out
    for line in without_code(text).split("\n"):
        for value in find_slots(line):
            before, _, after = line.partition(value)
            words = _NAME_OF.findall(value)
            name = max(words, key=lambda w: (w.lower() not in _WRAPPING, len(w), w)) if words else value
            key = "\x00".join(_mask(x, names) for x in (before, after))
            out.append((_hash(key), _hash(value), _hash(value.replace(name, "\x00").replace(name.upper(), "\x00")), _hash(name.lower()), not _WORDS.search(before + after)))
    return out


# Words that stand beside a variable's name within a slot.
_WRAPPING = frozenset("page entity model viewbag block insert enter your add here buraya gelecek hier einfügen untitled todo tbd undefined null nan none nil object".split())


def _mask(x: str, names: list[str]) -> str:
    low = _low(_TAG.sub(" ", x))
    for y in names:
        low = low.replace(y, "\x01")
    return re.sub(r"\d+", "0", re.sub(r"\b[^\W\d_]+(?=\.?$)", "\x01", low) if low[-1:] == "." else low)


def _vote(low: str) -> int:
    """Whether a text in small letters names scripts (1), a status code (-1) or neither."""
    return 1 if any(x in low for x in _SCRIPT) else -1 if _STATUS.search(low) else 0


_OUT = pa.schema(
    [
        ("doc_id", pa.int64()), ("address", pa.int64()), ("lines", pa.list_(pa.int64())), ("votes", pa.list_(pa.int32())), ("longest", pa.int64()), ("filler", pa.bool_()),
        ("kept", pa.list_(pa.struct([("key", pa.string()), ("low", pa.int64())]))), ("slots", pa.list_(pa.struct([("template", pa.int64()), ("value", pa.int64()), ("wrapping", pa.int64()), ("name", pa.int64()), ("whole", pa.bool_())]))),
    ]
)
_FIRST = "doc_id long, address long, lines array<long>, votes array<int>, longest long, filler boolean, kept array<struct<key: string, low: long>>, slots array<struct<template: long, value: long, wrapping: long, name: long, whole: boolean>>"
def _pages(whole: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for i, text, title, entity, url in zip(*(c.to_pylist() for c in b.columns)):
                names = page_names(title, entity, url)
                lines, votes, longest, filler, kept, slots = [], [], None, False, {}, []
                if text and not text.isspace():
                    low = text.lower().replace("i̇", "i")
                    found: dict[int, int] = {}
                    best = 0
                    for x in page_lines(low, names):
                        h = _hash(x)
                        found[h] = 0
                        if len(x) > best:
                            best, longest = len(x), h
                    lines, votes = list(found), [_vote(low)]
                    filler = any(map(is_filler, text.split("\n")))
                    if filler or not whole:
                        kept, slots = unfilled(text, _own(title, entity, _slug(url))), slots_of(text, names)
                if title and (filler or not whole):
                    slots = [*slots, *((*x[:4], True) for x in slots_of(title, names))]
                if lines or slots:
                    rows.append((i, _hash(address(title, url)), lines, votes, longest, filler, [{"key": k, "low": v} for k, v in sorted(kept.items())], [dict(zip(("template", "value", "wrapping", "name", "whole"), x)) for x in sorted(set(slots))]))
            cols = list(zip(*rows)) if rows else [[] for _ in _OUT]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(cols, _OUT)], schema=_OUT)

    return run


def anchor(key: str) -> str:
    """The longest fixed word of a template, which every line of it holds; empty if it has none."""
    return max(_WORDS.findall(key), key=lambda w: (len(w), w), default="")


def _filled(anchors: frozenset[str] | None):
    """(template, value) hashes of filled slots in lines that hold one of ``anchors``; None takes every line."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[tuple[int, int]] = []
            for text, title, entity, url in zip(*(c.to_pylist() for c in b.columns)):
                if not text or anchors is not None and anchors.isdisjoint(_WORDS.findall(text.lower())):
                    continue
                own, found = _own(title, entity, _slug(url)), {}
                for x in without_code(text).split("\n"):
                    if anchors is None or not anchors.isdisjoint(_WORDS.findall(x.lower())):
                        key, value, kept = template(x, own)
                        if not kept and value:
                            found[_hash(key)] = _hash(_low(value))
                out.extend(found.items())
            cols = list(zip(*out)) if out else [[] for _ in _VALUES]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in cols], schema=_VALUES)

    return run


def _unfilled_slots(docs: DataFrame, kept: DataFrame, min_pages: int) -> DataFrame:
    """doc_id of ``kept`` (doc_id, key, low, n_kept) records that leave a slot unfilled which other records of the template fill."""
    spark = docs.sparkSession
    keys = cut(kept.groupBy("key").agg(F.max("n_kept").alias("n_kept")).mapInArrow(_key_hashes, "line long, key string, n_kept long, anchor string"), "residue-keys")
    if keys.isEmpty():
        return spark.createDataFrame([], "doc_id long")
    words = [r.anchor for r in keys.select("anchor").distinct().limit(_MOST_WORDS + 1).collect()]
    values = docs.select("text", "title", "entity_title", "url").mapInArrow(_filled(frozenset(words) if len(words) <= _MOST_WORDS else None), "line long, value long")
    filled = values.join(small(keys, 1_000_000), "line").groupBy("line", "key", "n_kept", "value").agg(F.count("*").alias("n"))
    filled = cut(filled, "residue-filled")
    counted = filled.groupBy("line", "key", "n_kept").agg(F.sum("n").alias("n"), F.min("value").alias("a"), F.max("value").alias("b"))
    slots = counted.where((F.col("n") >= min_pages) & (F.col("n") >= F.col("n_kept")) & (F.col("a") < F.col("b"))).select("key")
    # capitals that others write small are emphasis, no name
    same = filled.select("key", F.col("value").alias("low"))
    return kept.join(slots, "key", "left_semi").join(same, ["key", "low"], "left_anti").select("doc_id").distinct()


_MOST_WORDS = 200_000  # beyond it every line is looked at, with the same result


def _key_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        keys = b.column(0)
        yield pa.RecordBatch.from_arrays([pa.array([_hash(x) for x in keys.to_pylist()], pa.int64()), keys, b.column(1), pa.array([anchor(x) for x in keys.to_pylist()], pa.string())], names=["line", "key", "n_kept", "anchor"])


def message_pages(first: DataFrame, min_pages: int = 2, min_share: float = 3e-5) -> DataFrame:
    """(doc_id, kind) of pages all of whose lines are templates of messages; ``first`` is the first stage's table.

    A template of messages makes up ``min_share`` of all pages: sentences of
    articles coincide by chance, the more often the more there are.
    """
    varied = (F.col("n") >= max(min_pages, min_share * first.count())) & (F.col("a") < F.col("b"))
    counts = (F.count("*").alias("n"), F.min("address").alias("a"), F.max("address").alias("b"))
    # a page whose longest line is its own alone is no message
    again = first.where("longest is not null").groupBy("longest").agg(*counts).where(varied).select("longest")
    pages = cut(first.join(small(cut(again, "residue-longest"), 1_000_000), "longest", "left_semi").select("doc_id", "address", "lines", F.coalesce(F.get("votes", F.lit(0)), F.lit(0)).alias("vote")), "residue-pages")
    lines = pages.select("doc_id", "address", "vote", F.size("lines").alias("n_lines"), F.explode("lines").alias("line"))
    by_line = cut(lines.groupBy("line").agg(*counts).where(varied).select("line", "n"), "residue-lines")
    # what stands more often in ordinary pages is no message
    elsewhere = first.select(F.explode("lines").alias("line")).join(small(by_line.select("line"), 1_000_000), "line", "left_semi").groupBy("line").agg(F.count("*").alias("n_all"))
    known = small(cut(by_line.join(elsewhere, "line").where("2 * n >= n_all").select("line"), "residue-known"), 1_000_000)
    met = cut(lines.join(known, "line").withColumn("n_met", F.count("*").over(Window.partitionBy("doc_id"))).where("n_met = n_lines").select("doc_id", "line", "vote"), "residue-met")
    votes = met.select("doc_id", "vote").distinct()
    for _ in range(2):
        by_line = met.select("doc_id", "line").join(votes, "doc_id").groupBy("line").agg(F.sum("vote").alias("v"))
        votes = met.select("doc_id", "line", F.col("vote").alias("own")).join(by_line, "line").groupBy("doc_id").agg(F.signum(F.sum("v") + F.max("own")).alias("vote"))
    return votes.select("doc_id", F.when(F.col("vote") > 0, F.lit("script")).otherwise(F.lit("error")).alias("kind"))


def shown_slots(first: DataFrame) -> DataFrame:
    """doc_id of records with a slot that shows its variable and is induced by other records or is a field of its own."""
    slots = first.select("doc_id", "address", F.inline("slots"))
    differ = lambda key, of: slots.groupBy(key).agg(F.min(of).alias("a"), F.max(of).alias("b")).where("a < b").select(key)
    aligned = slots.join(differ("template", "value"), "template", "left_semi").select("doc_id")
    wrapped = slots.join(differ("wrapping", "name"), "wrapping", "left_semi").select("doc_id")
    return slots.where("whole").select("doc_id").union(aligned).union(wrapped).distinct()


def template_residue(docs: DataFrame, min_pages: int = 2, whole: bool = False) -> DataFrame:
    """(doc_id, residue_kind), at most one row a document.

    ``docs`` needs doc_id, text, title, entity_title, url. ``whole`` leaves out
    the placeholders, and aligns slots only among pages that would be filler otherwise.
    """
    first = cut(docs.where("doc_id is not null").select("doc_id", "text", "title", "entity_title", "url").mapInArrow(_pages(whole), _FIRST), "residue")
    messages = cut(message_pages(first, min_pages), "residue-messages")
    kept = first.select("doc_id", F.inline("kept"))
    kept = kept.join(kept.groupBy("key").agg(F.countDistinct("doc_id").alias("n_kept")), "key")
    shown = shown_slots(first)
    unfilled_ids = _unfilled_slots(docs, kept.select("doc_id", "key", "low", "n_kept"), min_pages)
    placeholders = shown.union(unfilled_ids).distinct().withColumn("open", F.lit(True))
    rows = (
        first.where(F.col("filler") | (F.size("slots") > 0) | (F.size("kept") > 0))
        .select("doc_id", "filler")
        .join(small(cut(placeholders, "residue-open"), 1_000_000), "doc_id", "left")
        .select("doc_id", F.when(F.col("open"), F.lit("placeholder")).when(F.col("filler"), F.lit("filler")).alias("residue_kind"))
        .where("residue_kind is not null")
        .groupBy("doc_id")  # rows that come again: a placeholder before filler
        .agg(F.max("residue_kind").alias("residue_kind"))
    )
    found = messages.select("doc_id", F.col("kind").alias("residue_kind")).union(rows.join(small(messages.select("doc_id"), 1_000_000), "doc_id", "left_anti"))
    return found.where("residue_kind <> 'placeholder'") if whole else found


def without_residue(docs: DataFrame, **options) -> DataFrame:
    """``docs`` without the documents that are residue."""
    return docs.join(template_residue(docs, **options).select("doc_id"), "doc_id", "left_anti")
