"""Main content of pages whose text mixes the article with the site's furniture.

Method: composite text density. A page is a tree: the body, its blocks and
their lines. Every node has characters C, tags T, link characters LC and link
tags LT, and the density

    C/T * log( C/LC * T/LT , base ln(C*LC/notLC + LCb*C/Cb + e) )

where LCb and Cb are those of the body. Densities are summed along the page,
each less the threshold of the body's path, and the run of nodes with the
largest sum is the article's subtree.

Fetched text has lost most anchors, so link characters are learnt from the
corpus, in rounds, and from no list of words:

1. Link characters are those of anchors into the site, of navigation elements
   and of lines that return in at least ``min_docs`` documents and
   ``min_share`` of those of the source. The densities that follow give each
   page's subtree; lines outside it, and thin lines that break the text inside
   it, are link text for now.
2. Pairs of neighbouring tokens (line ends, the site's own name, the page's own
   title and numbers being tokens of their own) are counted in link text and
   in other text over all documents. A line's link share is what its pairs
   say, the subtree deciding where they say nothing.
3. The counts are taken again with these link shares, and the final densities
   follow: a line is furniture if its density stays below that of a node of
   its size whose link share is ``rho``.

Counts are kept in a fixed number of hashed cells, so the model has the same
size (1 MB) for any corpus and collisions weigh the same at every size.

Defined results: null and empty texts have no lines; blank lines are never
reported; every other line is either main content or furniture; lines without
letters (rules, brackets, closing tags) go with the article unless they belong
to a navigation element; a null source is a site of its own.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.residue import template_residue
from corpusloom.session import cut, small

CELLS = 1 << 18
_DIGITS = re.compile(r"\d+")


def fold(text: str) -> str:
    """Lower case, the dotted capital I as a plain i, numbers as 0."""
    return _DIGITS.sub("0", text.lower().replace("i̇", "i"))


_MD_LINK = re.compile(r"\[([^\]\[]*)\]\(([^)\n]*)\)")
_TAG = re.compile(r"<(/?)([A-Za-z][A-Za-z0-9]*)[^<>\n]*>|<!--.*?-->")
_ANCHOR = re.compile(r"<a\b[^>]*>(.*?)</a>", re.I)
# Elements that HTML defines for what stands around the content.
_CHROME_ELEMENT = re.compile(r"</?(?:nav|footer|aside|header|button|form)\b", re.I)
_LEAD = re.compile(r"^(?:[-*+•»›·|>]+|\d{1,2}[.)]|#{1,6}|=+|\\(?:sub)*section\*?\{|\\title\{)\s*")
_MARKED = re.compile(r"\s*(?:[-*+•»›·|!>{#=\\<]|\d{1,2}[.)])")
_TOKEN = re.compile(r"[^\W\d_]+|0|[^\w\s]|\x01")
_LETTER = re.compile(r"[^\W\d_]|\x01")
_HOST_PART = re.compile(r"[-.]")
_TITLE_PART = re.compile(r"\s[|–-]\s")
_OWN = "\x01"

# What is known of a line.
LINK, OWN, MARKED, FULL, STOP, BARE = 1, 2, 4, 8, 16, 32
_DENSE = 60  # characters from which a line is prose
_START = xxhash.xxh3_64_intdigest("^")


class _Cells(dict):
    """Tokens to 64-bit hashes, forgetting everything when it has grown large."""

    def __missing__(self, token: str) -> int:
        if len(self) > 500_000:
            self.clear()
        h = self[token] = xxhash.xxh3_64_intdigest(token) & 0x7FFFFFFFFFFFFFFF
        return h


def own_names(*titles: str | None) -> list[str]:
    """The folded titles of a page and their parts, longest first."""
    out: set[str] = set()
    for t in titles:
        if t:
            f = fold(t)
            out.update(x for x in (" ".join(y.split()) for y in (f, *_TITLE_PART.split(f))) if len(x) > 2)
    return sorted(out, key=len, reverse=True)


def site_parts(source: str | None) -> frozenset[str]:
    """The words of a host by which its pages name it."""
    return frozenset(x for x in _HOST_PART.split(fold(source or "")) if len(x) > 3)


def _key(*parts: str) -> int:
    return xxhash.xxh3_64_intdigest("\x00".join(parts)) - (1 << 63)


class Lines:
    """The non-blank lines of a batch of pages with what is needed of each, as columns."""

    __slots__ = ("n", "no", "chars", "tags", "flags", "keys", "leaves", "n_pairs", "_hashes", "_cells")

    def __init__(self, cells: _Cells) -> None:
        self.n, self.no, self.chars, self.tags, self.flags, self.keys, self.leaves, self.n_pairs = [], [], [], [], [], [], [], []
        self._hashes, self._cells = [_START], cells

    def add(self, text: str, source: str | None, titles: tuple[str | None, ...]) -> None:
        low, before = fold(text), len(self.no)
        site, own = [x for x in site_parts(source) if x in low], [x for x in own_names(*titles) if x in low]
        for no, line in enumerate(low.split("\n")):
            line = line.strip()
            if line:
                self._line(no, line, site, own)
        self.n.append(len(self.no) - before)

    def _line(self, no: int, raw: str, site: list[str], own: list[str]) -> None:
        plain, links, tags, link_chars, flags = raw, 0, 1, 0, 0
        if "](" in plain:
            for m in _MD_LINK.finditer(plain):
                tags += 1
                if not m[0].startswith("!") and m[2][:1] in ("/", "#"):
                    links += 1
                    link_chars += len(m[1])
            plain = _MD_LINK.sub(r"\1", plain)
        if "<" in plain:
            for m in _ANCHOR.finditer(plain):
                links += 1
                link_chars += len(_TAG.sub("", m[1]))
            if _CHROME_ELEMENT.search(plain):
                flags |= LINK
            tags += sum(1 for _ in _TAG.finditer(plain))
            plain = _TAG.sub("", plain)
        if not raw[0].isalpha() and _MARKED.match(raw):
            flags |= MARKED
            plain = _LEAD.sub("", plain.strip())
        plain = " ".join(plain.strip("*_' ={}").split())
        f = plain
        for x in own:
            if x in f:
                f = f.replace(x, _OWN)
        tokens = _TOKEN.findall(f)
        named = False
        for x in site:
            if x in f:
                tokens = ["\x02" if w == x else w for w in tokens]
                named = named or "\x02" in tokens
        if links and link_chars >= 0.9 * len(plain):
            flags |= LINK
        if tokens == [_OWN]:
            flags |= OWN
        if not _LETTER.search(f):
            flags |= BARE
        last = raw[-1]
        if last in ".!?…\"'”»)*_`":
            flags |= FULL
        if last in ".!?:;,":
            flags |= STOP
        self._hashes += map(self._cells.__getitem__, tokens)
        self._hashes.append(_START)
        self.no.append(no)
        self.chars.append(len(plain))
        self.tags.append(tags)
        self.flags.append(flags)
        self.keys.append(_key(*tokens))
        self.leaves.append(_key(str(len(tokens)), *tokens[:3]) if named else 0)
        self.n_pairs.append(len(tokens) + 1)

    def pairs(self) -> np.ndarray:
        """The cells of neighbouring tokens, line by line."""
        h = np.array(self._hashes, np.uint64)
        mixed = (h[:-1] * np.uint64(0x9E3779B97F4A7C15) ^ h[1:]) * np.uint64(0xC2B2AE3D27D4EB4F)
        return (mixed >> np.uint64(64 - 18)).astype(np.int32)


class Batch:
    """Lines of several pages as flat arrays; ``of`` is the page of each line."""

    def __init__(self, n: np.ndarray, no: np.ndarray, chars: np.ndarray, tags: np.ndarray, flags: np.ndarray, again: np.ndarray, n_pairs: np.ndarray, pairs: np.ndarray) -> None:
        self.n, self.no, self.chars, self.tags, self.flags, self.again, self.n_pairs, self.pairs = n, no, chars, tags, flags, again, n_pairs, pairs
        self.of = np.repeat(np.arange(len(n)), n)

    def body(self, values: np.ndarray, of: np.ndarray | None = None) -> np.ndarray:
        """Sums over each page."""
        return np.bincount(self.of if of is None else of, weights=values, minlength=len(self.n))


def density(c: np.ndarray, t: np.ndarray, lc: np.ndarray, lt: np.ndarray, body_c: np.ndarray, body_lc: np.ndarray) -> np.ndarray:
    """Composite text density of nodes; 0 where all characters are link characters."""
    base = np.log(c * lc / np.maximum(1.0, c - lc) + body_lc * c / np.maximum(1.0, body_c) + math.e)
    d = c / np.maximum(1.0, t) * np.log(np.maximum(1.0, c) / np.maximum(1.0, lc) * np.maximum(1.0, t) / np.maximum(1.0, lt)) / np.log(base + 1)
    return np.where((c > 0) & (lc < c), np.maximum(d, 0.0), 0.0)


def max_sum(scores: list[float]) -> tuple[int, int]:
    """First and last place of the run with the largest sum."""
    best, at, total, start = -math.inf, (0, len(scores) - 1), 0.0, 0
    for j, x in enumerate(scores):
        if total <= 0:
            total, start = 0.0, j
        total += x
        if total > best:
            best, at = total, (start, j)
    return at


def _interrupters(chars: list[int], flags: list[int], bare_next: list[bool]) -> list[int]:
    """Thin unmarked lines, one or two at a time, that break off running prose."""
    out, j, n = [], 1, len(chars)
    while j < n:
        if chars[j] < _DENSE <= chars[j - 1] and flags[j - 1] & FULL:
            e = j
            while e < n and chars[e] < _DENSE and not flags[e] & (MARKED | STOP) and not bare_next[e]:
                e += 1
            if j < e < n and e - j <= 2 and chars[e] >= _DENSE:
                out.extend(range(j, e))
            j = max(e, j + 1)
        else:
            j += 1
    return out


def density_labels(b: Batch) -> np.ndarray:
    """Whether each line is link text by density alone: outside its page's subtree, or breaking it off.

    The subtree is the run of lines with the largest sum of densities above the
    threshold of the body's path: the mean density of its nodes, at most that
    of a line of 36 characters. Square roots keep one long line from
    outweighing ten others. The page's own title is content wherever it stands.
    """
    at = np.flatnonzero((b.flags & BARE) == 0)
    of, f = b.of[at], b.flags[at]
    own, linked = (f & OWN) > 0, (f & LINK) > 0
    c = np.where(own, np.maximum(b.chars[at], 100), b.chars[at]).astype(float)
    t, share = b.tags[at].astype(float), (linked | (b.again[at] & ~own)).astype(float)
    body_c, body_lc = b.body(c, of), b.body(c * share, of)
    d = np.sqrt(density(c, t, c * share, t * share, body_c[of], body_lc[of]))
    n = np.bincount(of, minlength=len(b.n))
    one = np.ones(len(b.n))
    most = np.sqrt(density(36 * one, one, 0 * one, 0 * one, body_c, body_lc))
    threshold = np.minimum(b.body(d, of) / np.maximum(1, n), most)
    scores, starts = (d - threshold[of]).tolist(), np.concatenate([[0], np.cumsum(n)]).tolist()
    chars, flags = b.chars[at].tolist(), f.tolist()
    following = np.concatenate([at[1:], [-1]])
    bare_next = np.zeros(len(at), bool)
    inner = at + 1 < len(b.no)
    nxt = np.minimum(at + 1, len(b.no) - 1)
    bare_next = (inner & (b.of[nxt] == of) & (b.no[nxt] == b.no[at] + 1) & (following != nxt) & ((b.flags[nxt] & BARE) > 0)).tolist()
    out = np.ones(len(at), bool)
    for k in range(len(b.n)):
        x, y = starts[k], starts[k + 1]
        if x == y:
            continue
        i, j = max_sum(scores[x:y])
        out[x + i : x + j + 1] = False
        for z in _interrupters(chars[x:y], flags[x:y], bare_next[x:y]):
            out[x + z] = True
    labels = np.zeros(len(b.no), bool)
    labels[at] = (out & ~own) | linked
    return labels


class Evidence:
    """Counts of pairs of tokens in link text and in other text."""

    def __init__(self, link: np.ndarray | None = None, other: np.ndarray | None = None) -> None:
        self.link = np.zeros(CELLS, np.float32) if link is None else link.astype(np.float32)
        self.other = np.zeros(CELLS, np.float32) if other is None else other.astype(np.float32)
        # a pair counts as much as its share of all pairs, so that rare names say as little in a large corpus as in a small one
        self.least = max(1.0, _LEAST_SHARE * float(self.link.sum(dtype=np.float64) + self.other.sum(dtype=np.float64)))

    def lines(self, b: Batch, out: np.ndarray) -> np.ndarray:
        """Log odds of each line being link text; what the density says of it is the prior of its pairs."""
        if not len(b.n_pairs):
            return np.zeros(0)
        prior = np.repeat(np.where(out, 0.5 + _PRIOR, 0.5 - _PRIOR), b.n_pairs)
        odds = np.log((self.link[b.pairs] + self.least * prior) / (self.other[b.pairs] + self.least * (1 - prior)))
        starts = np.concatenate([[0], np.cumsum(b.n_pairs)[:-1]])
        return np.add.reduceat(odds, starts) / np.sqrt(b.n_pairs)


_PRIOR = 0.2
_LEAST_SHARE = 1e-5


def link_shares(b: Batch, model: Evidence | None) -> np.ndarray:
    """Link share of each line: learnt, with the density's labels where nothing is known."""
    out = density_labels(b)
    if model is None:
        return out.astype(float)
    p = 1 / (1 + np.exp(-np.clip(model.lines(b, out), -30, 30)))
    p[(b.flags & (OWN | BARE)) > 0] = 0.0
    p[(b.flags & LINK) > 0] = 1.0
    return p


def is_furniture(b: Batch, model: Evidence, rho: float) -> np.ndarray:
    """Whether each line's density is below that of a node of its size with link share ``rho``."""
    shares = link_shares(b, model)
    c, t = np.maximum(1.0, b.chars.astype(float)), b.tags.astype(float)
    body_c, body_lc = b.body(c)[b.of], b.body(c * shares)[b.of]
    least = density(c, t, c * rho, t * rho, body_c, body_lc)
    return (shares >= 1.0) | (density(c, t, c * shares, t * shares, body_c, body_lc) < least)


_LINES = "doc_id long, site long, no array<int>, chars array<int>, tags array<int>, flags array<int>, keys array<long>, leaves array<long>, n_pairs array<int>, pairs array<int>"
_COLUMNS = ("no", "chars", "tags", "flags", "keys", "leaves", "n_pairs", "pairs")


def _pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id, site, source, text, titles to the columns of the page's lines."""
    cells = _Cells()
    for b in batches:
        ids, sites, lines = [], [], Lines(cells)
        for i, site, source, text, *titles in zip(*(c.to_pylist() for c in b.columns)):
            if text and not text.isspace():
                lines.add(text, source, tuple(titles))
                ids.append(i)
                sites.append(site)
        ends = np.concatenate([[0], np.cumsum(lines.n)]).astype(np.int32)
        per_line = np.concatenate([[0], np.cumsum(lines.n_pairs)])
        cols = [(lines.no, pa.int32()), (lines.chars, pa.int32()), (lines.tags, pa.int32()), (lines.flags, pa.int32()), (lines.keys, pa.int64()), (lines.leaves, pa.int64()), (lines.n_pairs, pa.int32())]
        arrays = [pa.ListArray.from_arrays(pa.array(ends), pa.array(v, t)) for v, t in cols]
        arrays.append(pa.ListArray.from_arrays(pa.array(per_line[ends].astype(np.int32)), pa.array(lines.pairs())))
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(sites, pa.int64()), *arrays], names=["doc_id", "site", *_COLUMNS])


def returning_lines(pages: DataFrame, min_docs: int = 4, min_share: float = 0.1) -> DataFrame:
    """(site, returning): per site the keys of its lines, and of templates that name it, that return.

    At most ``1 / min_share`` times the mean number of lines of a page are kept a site.
    """
    total = pages.groupBy("site").agg(F.count("*").alias("n_site"))
    lines = pages.select("site", F.explode(F.array_distinct(F.filter(F.concat("keys", "leaves"), lambda x: x != 0))).alias("key")).groupBy("site", "key").agg(F.count("*").alias("n")).where(F.col("n") >= min_docs)
    often = lines.join(total, "site").where(F.col("n") >= min_share * F.col("n_site"))
    return often.groupBy("site").agg(F.collect_list("key").alias("returning"))


def _again(sites: list[int], n: list[int], keys: list[int], leaves: list[int], returning: pa.Array, known: dict) -> np.ndarray:
    """Whether each line, or its template that names the site, returns in its site."""
    out, x = [], 0
    for k, (site, m) in enumerate(zip(sites, n)):
        if site not in known:
            if len(known) > 5000:
                known.clear()
            known[site] = frozenset(returning[k].as_py() or ())
        mine = known[site]
        out += [a in mine or c in mine for a, c in zip(keys[x : x + m], leaves[x : x + m])] if mine else [False] * m
        x += m
    return np.array(out, bool)


def _batch(b: pa.RecordBatch, known: dict) -> Batch:
    n = b.column("no").value_lengths().to_numpy(zero_copy_only=False)
    flat = {c: b.column(c).flatten().to_numpy(zero_copy_only=False) for c in _COLUMNS}
    again = _again(b.column("site").to_pylist(), n.tolist(), flat["keys"].tolist(), flat["leaves"].tolist(), b.column("returning"), known)
    return Batch(n, flat["no"], flat["chars"], flat["tags"], flat["flags"], again, flat["n_pairs"], flat["pairs"])


def count_pairs(b: Batch, model: Evidence | None, link: np.ndarray, other: np.ndarray) -> None:
    """Add the pairs of link text and of other text of ``b``."""
    p = link_shares(b, model)
    lettered = np.repeat((b.flags & BARE) == 0, b.n_pairs)
    is_link = np.repeat(p >= 0.5, b.n_pairs)
    link += np.bincount(b.pairs[is_link & lettered], minlength=CELLS)
    other += np.bincount(b.pairs[~is_link & lettered], minlength=CELLS)


def _count(model: Evidence | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        link, other, known = np.zeros(CELLS, np.int64), np.zeros(CELLS, np.int64), {}
        for b in batches:
            if b.num_rows:
                count_pairs(_batch(b, known), model, link, other)
        cells = np.flatnonzero(link + other)
        yield pa.RecordBatch.from_arrays([pa.array(cells.astype(np.int32)), pa.array(link[cells]), pa.array(other[cells])], names=["cell", "link", "other"])

    return run


def learn(pages: DataFrame, rounds: int = 1) -> Evidence:
    """The link evidence of all pages, counted ``rounds`` times; ``pages`` has the column returning."""
    model = None
    for _ in range(rounds):
        counts = pages.mapInArrow(_count(model), "cell int, link long, other long").groupBy("cell").agg(F.sum("link").alias("link"), F.sum("other").alias("other"))
        t = counts.toArrow()  # never more than CELLS rows
        link, other = np.zeros(CELLS), np.zeros(CELLS)
        cells = t.column("cell").to_numpy()
        link[cells], other[cells] = t.column("link").to_numpy(), t.column("other").to_numpy()
        model = Evidence(link, other)
    return model


def _found(model: Evidence, rho: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict = {}
        for b in batches:
            if b.num_rows:
                lines = _batch(b, known)
                gone = is_furniture(lines, model, rho)
                yield pa.RecordBatch.from_arrays([b.column("doc_id").take(pa.array(lines.of[gone])), pa.array(lines.no[gone], pa.int32())], names=["doc_id", "line_no"])

    return run


def _prepared(docs: DataFrame) -> DataFrame:
    """The lines of all pages, parsed once, with the returning keys of the page's site."""
    site = F.xxhash64(F.coalesce("source", F.lit("\x00")))
    pages = cut(docs.select("doc_id", site.alias("site"), "source", "text", "title", "entity_title").mapInArrow(_pages, _LINES), "page-lines")
    return pages.join(small(cut(returning_lines(pages), "returning-lines"), 100_000), "site", "left")


def furniture_lines(docs: DataFrame, rho: float = 0.35, rounds: int = 1) -> DataFrame:
    """(doc_id, line_no) of every non-blank line outside the main content.

    ``docs`` needs doc_id, source, text, title, entity_title.
    """
    pages = _prepared(docs)
    return pages.mapInArrow(_found(learn(pages, rounds), rho), "doc_id long, line_no int")


def page_furniture(docs: DataFrame, **options) -> DataFrame:
    """``furniture_lines`` without those of documents that are error, script or filler pages as a whole."""
    whole = template_residue(docs, whole=True).select("doc_id")
    return furniture_lines(docs, **options).join(whole, "doc_id", "left_anti")


_ARTICLE = pa.schema([("doc_id", pa.int64()), ("url", pa.string()), ("article", pa.string()), ("n_lines", pa.int32()), ("n_furniture", pa.int32())])


def _articles(model: Evidence, rho: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells, known = _Cells(), {}
        for b in batches:
            rows, lines, places = [], Lines(cells), []
            cols = [c.to_pylist() for c in b.columns[:-1]]
            for k, (i, url, _, source, text, *titles) in enumerate(zip(*cols)):
                rows.append([i, url, None if text is None else "", 0, 0])
                if text and not text.isspace():
                    lines.add(text, source, tuple(titles))
                    places.append(k)
            if places:
                again = _again([cols[2][k] for k in places], lines.n, lines.keys, lines.leaves, b.column(b.num_columns - 1).take(pa.array(places)), known)
                made = Batch(np.array(lines.n), *(np.array(x, np.int32) for x in (lines.no, lines.chars, lines.tags, lines.flags)), again, np.array(lines.n_pairs), lines.pairs())
                gone = is_furniture(made, model, rho)
                ends = np.concatenate([[0], np.cumsum(lines.n)]).tolist()
                for k, x, y in zip(places, ends, ends[1:]):
                    mine = set(made.no[x:y][gone[x:y]].tolist())
                    article = "\n".join(z for j, z in enumerate(cols[4][k].split("\n")) if j not in mine)
                    rows[k][2:] = re.sub(r"\n{3,}", "\n\n", article).strip("\n"), y - x, len(mine)
            out = list(zip(*rows)) if rows else [[] for _ in _ARTICLE]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(out, _ARTICLE)], schema=_ARTICLE)

    return run


def main_content(docs: DataFrame, rho: float = 0.35, rounds: int = 1) -> DataFrame:
    """(doc_id, url, article, n_lines, n_furniture) for every document; null text gives a null article."""
    pages = _prepared(docs)
    model = learn(pages, rounds)
    site = F.xxhash64(F.coalesce("source", F.lit("\x00")))
    keys = pages.where("returning is not null").select("site", "returning").dropDuplicates(["site"])
    named = docs.select("doc_id", "url", site.alias("site"), "source", "text", "title", "entity_title")
    joined = named.join(small(cut(keys, "site-keys"), 100_000), "site", "left").select("doc_id", "url", "site", "source", "text", "title", "entity_title", "returning")
    return joined.mapInArrow(_articles(model, rho), "doc_id long, url string, article string, n_lines int, n_furniture int")
