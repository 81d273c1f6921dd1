"""Splitting oversized texts at natural boundaries.

Method: agglomerative merging. The text is cut into atomic segments at every
natural boundary; adjacent pairs wait in a heap, weakest boundary first, and
are merged while the combined size plus the overlap fits the limit. What
remains are the pieces; each piece but the first is preceded by exactly
``overlap`` code points of the text before it.

Boundary strengths, from weak to strong: white space, clause end, sentence
end, line end, blank line, heading. A run of non-space characters longer than
``max_chars - overlap`` has no natural boundary that fits and is cut hard.

Defined results: null and empty texts and texts within the limit give no
pieces from ``split_documents`` (they need no splitting); concatenating the
pieces without their overlaps gives the text back exactly.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.session import bounded_rows

# A heading or blank line, a line, a sentence, a clause, a word, in this order of strength.
_BOUNDARY = re.compile(r"(?P<p>\r?\n[ \t\r]*\n[ \t\r\n]*)|(?P<l>[ \t]*\r?\n[ \t]*)|(?P<s>[.!?…][\"'”’»)\]]*[ \t]+)|(?P<c>[,;:][ \t]+)|(?P<w>[ \t\r]+)")
_STRENGTH = {"w": 1, "c": 2, "s": 3, "l": 4, "p": 5}
_HEADING = re.compile(r"#{1,6} |=+ |\\(?:sub)*section|<h[1-6]", re.I)
_SPACES = re.compile("[ \t\r\n]+")


def longest_run(text: str) -> int:
    """Most code points in a row without a space, tab, CR or LF."""
    return max(map(len, _SPACES.split(text)))


def atoms(text: str, limit: int, least: int) -> tuple[list[int], list[int]]:
    """Ends of the atomic segments and the strength of the boundary after each.

    Boundaries weaker than ``least`` are not used unless a segment would exceed ``limit``.
    """
    ends, strengths = [], []
    for m in _BOUNDARY.finditer(text):
        s = _STRENGTH[m.lastgroup]
        if s >= least:
            e = m.end()
            if s >= 4 and _HEADING.match(text, e):
                s = 6
            ends.append(e)
            strengths.append(s)
    if not ends or ends[-1] != len(text):
        ends.append(len(text))
        strengths.append(9)
    out_e, out_s, start = [], [], 0
    for e, s in zip(ends, strengths):
        if e - start > limit:
            if least > 1:
                sub_e, sub_s = atoms(text[start:e], limit, least - 1)
                out_e += [start + x for x in sub_e[:-1]]
                out_s += sub_s[:-1]
            else:
                for x in range(start + limit, e, limit):
                    out_e.append(x)
                    out_s.append(0)
        out_e.append(e)
        out_s.append(s)
        start = e
    return out_e, out_s


def cut_points(text: str, max_chars: int, overlap: int) -> list[tuple[int, int]]:
    """(end, strength of the boundary) of each piece's core; the last end is the length of the text."""
    limit = max(1, max_chars - overlap)
    ends, strengths = atoms(text, limit, 3)
    n = len(ends)
    if n == 1:
        return [(ends[0], strengths[0])]
    size = [ends[0]] + [b - a for a, b in zip(ends, ends[1:])]
    left, right = list(range(-1, n - 1)), list(range(1, n + 1))
    alive, version = [True] * n, [0] * n
    heap = [(strengths[k], size[k] + size[k + 1], k, 0, 0) for k in range(n - 1)]
    heapq.heapify(heap)
    while heap:
        s, both, k, vk, vr = heapq.heappop(heap)
        if not alive[k]:
            continue
        r = right[k]
        if r >= n or version[k] != vk or version[r] != vr:
            continue
        # the first piece carries no overlap
        if both + (overlap if left[k] >= 0 else 0) > max_chars:
            continue
        # r joins k: k now ends where r ended
        alive[r] = False
        size[k], strengths[k], ends[k] = both, strengths[r], ends[r]
        version[k] += 1
        right[k] = right[r]
        if right[r] < n:
            left[right[r]] = k
            heapq.heappush(heap, (strengths[k], size[k] + size[right[k]], k, version[k], version[right[k]]))
        if left[k] >= 0:
            j = left[k]
            heapq.heappush(heap, (strengths[j], size[j] + size[k], j, version[j], version[k]))
    return [(ends[k], strengths[k]) for k in range(n) if alive[k]]


_NAMES = {0: "run", 1: "space", 2: "clause", 3: "sentence", 4: "line", 5: "paragraph", 6: "heading", 9: "end"}
_OUT = pa.schema(
    [("doc_id", pa.int64()), ("spec_id", pa.int32()), ("cut_kind", pa.string()), ("piece_no", pa.int32()), ("start", pa.int32()), ("core_start", pa.int32()), ("end", pa.int32()), ("boundary", pa.string()), ("piece", pa.string())]
)


def _split(specs: list[tuple[int, int, int]], with_text: bool):
    least = min(m for _, m, _ in specs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows: list[tuple] = []
            for i, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if text is None or len(text) <= least:
                    continue
                longest = longest_run(text)
                for spec, most, overlap in specs:
                    if len(text) <= most:
                        continue
                    kind, at = "hard" if longest > most else "soft", 0
                    for no, (end, strength) in enumerate(cut_points(text, most, overlap)):
                        start = max(0, at - overlap)
                        rows.append((i, spec, kind, no, start, at, end, _NAMES[strength], text[start:end] if with_text else None))
                        at = end
            cols = list(zip(*rows)) if rows else [[] for _ in _OUT]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(cols, _OUT)], schema=_OUT)

    return run


def split_documents(docs: DataFrame, specs: DataFrame, with_text: bool = True) -> DataFrame:
    """Pieces of every text longer than a spec's max_chars, for each spec.

    ``docs`` needs doc_id and text, ``specs`` spec_id, max_chars, overlap_chars
    (at most 1,000 specs). Specs with a null, a limit below 1 or an overlap not
    below the limit are rejected. The documents are read once for all specs.
    """
    rows = [(r.spec_id, r.max_chars, r.overlap_chars) for r in bounded_rows(specs.select("spec_id", "max_chars", "overlap_chars"), 1000, "split_specs")]
    for spec, most, overlap in rows:
        if spec is None or most is None or overlap is None or most < 1 or not 0 <= overlap < most:
            raise ValueError(f"spec {spec}: limit {most} and overlap {overlap} don't fit")
    kind = "doc_id long, spec_id int, cut_kind string, piece_no int, start int, core_start int, end int, boundary string, piece string"
    if not rows:
        return docs.sparkSession.createDataFrame([], kind)
    long = docs.select("doc_id", "text").where(F.length("text") > min(m for _, m, _ in rows))
    return long.mapInArrow(_split(rows, with_text), kind)
