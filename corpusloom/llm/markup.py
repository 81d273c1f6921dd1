"""Markup residue: which kinds a text holds, and clean text that keeps its structure.

Method: events of the standard library's streaming HTML parser give tags,
comments and character entities; Markdown, wiki and LaTeX marks are read by
their own delimiters, over spans of any length within a paragraph or between
brackets. Every line's text-to-tag ratio, with the extent of HTML by the same
events, is smoothed with a Gaussian kernel over the lines that are not blank;
lines whose smoothed ratio reaches a threshold derived from its spread form the
content regions. Lines of marks outside the content regions (link lists, rows
of tags) are left out of the clean text; lines without marks, headings, list
items, tables, code and formulas never are, nor is HTML over several lines cut
in two. Headings come out as ``# ``, list items as ``- ``, code in fences and
formulas between dollar signs. One pass does all of this and lists the kinds
of the whole text, of the lines left out as well.

Defined results: null text gives null clean text and no kinds; empty text gives
empty text; the content of fenced code is kept as it is and never read as
marks; slots that a template left unfilled are no marks; the text behind a
script or style element that is never closed is kept.
"""

from __future__ import annotations

import html
import math
import re
from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.slots import CODE, FENCE, without_slots

KINDS = ("html", "markdown", "wiki", "latex")

# Element names of HTML, fixed by its standard.
_ELEMENTS = frozenset(
    "a abbr acronym address applet area article aside audio b base basefont bdi bdo big blockquote body br button canvas caption center cite code col "
    "colgroup data datalist dd del details dfn dialog dir div dl dt em embed fieldset figcaption figure font footer form frame frameset h1 h2 h3 h4 h5 h6 "
    "head header hgroup hr html i iframe img input ins kbd label legend li link main map mark marquee menu meta meter nav nobr noframes noscript object ol "
    "optgroup option output p param picture pre progress q rp rt ruby s samp script search section select slot small source span strike strong style sub "
    "summary sup svg table tbody td template textarea tfoot th thead time title tr track tt u ul var video wbr".split()
)
_MAYBE_HTML = re.compile(r"<[A-Za-z/!]|&#?\w+;")
# Signs that begin no reference and at which the parser would stop, and what stands for them: no text holds a lone surrogate.
_LONE = re.compile(r"&(?=#(?!(?:[0-9]+|[xX][0-9a-fA-F]+)[^0-9a-fA-F]))")
_STAND_IN = "\udc26"

# Marks by their delimiters, each with what a text must hold for it.
_MARKDOWN = tuple(
    (triggers, re.compile(pattern))
    for triggers, pattern in (
        (("#",), r"(?m)^ {0,3}#{1,6}[ \t]+\S"),
        (("---", "==="), r"(?m)^[^\s|>\-=][^\n]*\n(?:-{3,}|={3,})[ \t]*\r?$"),
        (("*",), r"(?<![\w*\\])\*{1,3}(?=[^\s*])(?:[^*\n]|\n(?!\s*\n))*?[^\s*]\*{1,3}(?![\w*])"),
        (("_",), r"(?<![\w_\\])_{1,2}(?=[^\s_])[^_\n]*?[^\s_]_{1,2}(?![\w_])"),
        (("~~",), r"~~(?=\S)(?:[^~\n]|\n(?!\s*\n))*?\S~~"),
        (("`",), r"(?m)`[^`\n]+`|^[ \t]*```"),
        (("](",), r"!?\[[^\]\[]*\]\([^)\s][^)\n]*\)"),
        (("][",), r"\[[^\]\[\n]+\]\[\w*\]"),
        (("]:",), r"(?m)^ {0,3}\[[^\]\n]+\]:[ \t]+\S"),
        (("[^",), r"\[\^[^\]\s]+\]"),
        ((">",), r"(?m)^ {0,3}>[ \t]?[^\s>]"),
        (("---",), r"(?m)^[ \t]*\|?[ \t]*:?-{3,}:?[ \t]*\|[ \t|:\-]*\r?$"),
    )
)
_WIKI = tuple(
    (triggers, re.compile(pattern))
    for triggers, pattern in (
        (("[[",), r"\[\[[^\[\]]+\]\]"),
        (("{{",), r"(?m)\{\{\s*[^\W\d_][^{}]*\}\}|\{\{\s*[^\W\d_][^{}\n]*\r?$"),
        (("//",), r"\[(?:https?:|ftp:)?//[^\s\]]+(?:\s[^\]\n]*)?\](?!\()"),
        (("''",), r"(?<!')'{2,5}(?=[^'\s])(?:[^'\n]|\n(?!\s*\n)|(?<=\w)'(?=\w))+'{2,5}"),
        (("==",), r"(?m)^={2,6}[ \t]*[^=\n]+?[ \t]*={2,6}[ \t]*\r?$"),
        (("{|", "|-", "|}"), r"(?m)^\{\||^\|-(?![-\s:]*\|)|^\|\}"),
    )
)
_LATEX = tuple(
    (triggers, re.compile(pattern))
    for triggers, pattern in (
        (("\\",), r"\\(?:begin|end)\{|\\[A-Za-z]{2,}\*?(?=[\s{\[~\\.,;:^_$)]|$)"),
        (("\\(", "\\["), r"\\\((?:[^\n]|\n(?!\s*\n))+?\\\)|\\\[[^\]]+?\\\]"),
        (("$$",), r"\$\$[^$]+\$\$"),
        (("$",), r"(?<![\\$\w])\$(?=[^\s$])[^$\n]*?[\\^_={][^$\n]*(?<=\S)\$(?![\d$])|(?<![\\$\w])\$[A-Za-z]\$(?![\w$])"),
    )
)


class _Events(HTMLParser):
    """Counts tags and entities, by line as well, and says where HTML stands; with ``build`` collects the text with its structure instead."""

    def __init__(self, source: str, build: bool) -> None:
        super().__init__(convert_charrefs=False)
        self.source, self.starts = source, []
        self.n_tags = self.n_entities = 0
        self.spans: list[tuple[int, int]] = []
        self.opened: int | None = None
        self.by_line: dict[int, int] = {}
        self.build, self.out, self.hidden, self.pre = build, [], 0, 0
        self.held: list[str] = []

    def _tag(self, length: int) -> None:
        """Notes a mark of at least ``length`` characters, which ends with the next ``>``."""
        self.n_tags += 1
        line = self.getpos()[0] - 1
        self.by_line[line] = self.by_line.get(line, 0) + 1
        if not self.build:
            at = self._offset()
            self.spans.append((at, (self.source.find(">", at + length - 1) + 1) or len(self.source)))

    def _offset(self) -> int:
        line, column = self.getpos()
        self.starts = self.starts or [0, *(m.end() for m in re.finditer("\n", self.source))]
        return self.starts[line - 1] + column

    def _reference(self, mark: str) -> None:
        if not self.build:
            self.n_entities += self.source.startswith(";", self._offset() + len(mark))

    def _no_mark(self, source: str) -> None:
        """What is no mark of HTML is text, in which entities count."""
        if not self.build and "&" in source:
            self.n_entities += _parse(source.replace("<", " ")).n_entities

    def text(self) -> str:
        return "".join(self.out).replace(_STAND_IN, "&")

    def close(self) -> None:
        super().close()
        if self.hidden:  # its end never came: the rest is text, whose tags go
            rest = "".join(self.held) or self.rawdata
            self.out.append(re.sub(r"<[^<>]*>", "", rest))
            self.hidden, self.held = 0, []

    def handle_starttag(self, tag, attrs) -> None:
        if tag not in _ELEMENTS:
            self._no_mark(self.get_starttag_text() or "")
            if self.build:
                self.out.append(self.get_starttag_text() or "")
            return
        self._tag(len(self.get_starttag_text() or "<>"))
        if not self.build:
            if tag in ("script", "style"):
                self.opened = self.spans[-1][0]
            return
        if tag in ("script", "style"):
            self.hidden += 1
        elif tag in ("h1", "h2", "h3", "h4", "h5", "h6"):
            self.out.append("\n" + "#" * int(tag[1]) + " ")
        elif tag == "li":
            self.out.append("\n- ")
        elif tag == "pre":
            self.pre += 1
            self.out.append("\n```\n")
        elif tag in ("td", "th"):
            self.out.append(" | ")
        elif tag == "img":
            self.out.append(dict(attrs).get("alt") or "")
        elif tag in ("br", "p", "div", "tr", "ul", "ol", "table", "section", "article", "blockquote", "hr"):
            self.out.append("\n")

    def handle_startendtag(self, tag, attrs) -> None:
        self.handle_starttag(tag, attrs)
        if tag in ("script", "style"):
            self.hidden, self.opened = self.hidden - self.build, None

    def handle_endtag(self, tag) -> None:
        if tag not in _ELEMENTS:
            at = self._offset()
            self._no_mark(self.source[at : self.source.find(">", at) + 1])
            return
        self._tag(2)
        if not self.build:
            if tag in ("script", "style") and self.opened is not None:
                self.spans.append((self.opened, self.spans.pop()[1]))
                self.opened = None
            return
        if tag in ("script", "style"):
            self.hidden, self.held = max(0, self.hidden - 1), []
        elif tag == "pre" and self.pre:
            self.pre -= 1
            self.out.append("\n```\n")
        elif tag in ("h1", "h2", "h3", "h4", "h5", "h6", "p", "div", "ul", "ol", "table", "section", "article", "blockquote"):
            self.out.append("\n")

    def handle_comment(self, data) -> None:
        self._tag(len(data) + (5 if self.build or self.source.startswith("<!--", self._offset()) else 3))

    def handle_decl(self, data) -> None:
        self._tag(len(data) + 3)

    def handle_pi(self, data) -> None:
        self._no_mark(data)

    def unknown_decl(self, data) -> None:
        self._no_mark(data)

    def handle_data(self, data) -> None:
        if self.build:
            (self.held if self.hidden else self.out).append(data)
        elif "<" in data:  # of a tag that breaks off
            self._no_mark(data)

    def handle_entityref(self, name) -> None:
        if name + ";" in html.entities.html5:
            self._reference(f"&{name}")
        if self.build and not self.hidden:
            self.out.append(html.unescape(f"&{name};") if name + ";" in html.entities.html5 else f"&{name}")

    def handle_charref(self, name) -> None:
        self._reference(f"&#{name}")
        if self.build and not self.hidden:
            self.out.append(html.unescape(f"&#{name};"))


def _parse(text: str, build: bool = False) -> _Events:
    text = _LONE.sub(_STAND_IN, text) if "&#" in text else text
    p = _Events(text, build)
    p.feed(text)
    p.close()
    return p


@lru_cache(maxsize=2)
def _events(text: str) -> _Events:
    return _parse(text)


def _plain(text: str) -> tuple[str, bool]:
    """``text`` without the content of fenced code and without slots; whether it had a fence."""
    fenced = False
    if "```" in text or "~~~" in text:
        body = FENCE.sub("\n", text)
        fenced = body != text
        text = body
    return without_slots(text), fenced


def _holds(text: str, marks: tuple) -> bool:
    return any(any(x in text for x in triggers) and pattern.search(text) for triggers, pattern in marks)


def kinds(text: str | None) -> list[str]:
    """The kinds of markup with at least one mark in ``text``."""
    if not text:
        return []
    body, fenced = _plain(text)
    out = []
    if _MAYBE_HTML.search(body):
        events = _events(body)
        if events.n_tags or events.n_entities:
            out.append("html")
    if fenced or _holds(body, _MARKDOWN):
        out.append("markdown")
    if _holds(body, _WIKI):
        out.append("wiki")
    if _holds(body, _LATEX):
        out.append("latex")
    return out


_MARK = re.compile(r"\]\([^)\n]*\)|\[\[|\]\]|\{\{|\}\}|\\[A-Za-z]+|\[(?=[^\]\n]*\]\()")
# Marks of structure: their lines are never left out.
_STRUCTURE = re.compile(r"[ \t]*(?:#{1,6}[ \t]|={2,6}[ \t]*\S|[-=*~_`]{3,}|[-*+•»][ \t]+(?!\[[^\]]*\]\([^)]*\)\s*$)|\d{1,3}[.)]\s|\||\{\||\{\{(?!.*\}\})|\}\}\s*$|!|>|\$|\\(?:\[|\(|(?:sub)*section|title|item|begin|end))|.*<(?:h[1-6]|li|pre|code|t[drh]|table|math)\b", re.I)


def _without_html(text: str) -> str:
    """``text`` without HTML's marks, comments and closed scripts, line by line."""
    out, done = [], 0
    for start, end in sorted(_events(text).spans):
        if end > done:
            start = max(start, done)
            out += text[done:start], "\n" * text.count("\n", start, end)
            done = end
    return "".join(out) + text[done:]


@lru_cache(maxsize=2)
def ratios(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Text-to-tag ratio and number of marks of each line, HTML and its extent by the parser's events."""
    lines = text.split("\n")
    by_line, bare = (_events(text).by_line, _without_html(text).split("\n")) if "<" in text else ({}, lines)
    others = any(x in text for x in ("](", "[[", "]]", "{{", "}}", "\\"))
    ratio, marks = np.zeros(len(lines)), np.zeros(len(lines), int)
    for k, x in enumerate(lines):
        if x.strip():
            found = _MARK.findall(bare[k]) if others else ()
            marks[k] = len(found) + by_line.get(k, 0)
            ratio[k] = (len(bare[k]) - sum(map(len, found))) / max(1, marks[k])
    return ratio, marks


def _with_whole_html(text: str, regions: list[bool]) -> list[bool]:
    """``regions`` with all lines of HTML that stands over several, so that none is cut in two."""
    regions = list(regions)
    for start, end in _events(text).spans if "<" in text else ():
        if more := text.count("\n", start, end):
            first = bisect_right(_events(text).starts, start) - 1
            regions[first : first + more + 1] = [True] * (more + 1)
    return regions


def _smooth(ratio: np.ndarray, sigma: float) -> np.ndarray:
    r = max(1, math.ceil(3 * sigma))
    kernel = np.exp(-0.5 * (np.arange(-r, r + 1) / sigma) ** 2)
    return np.convolve(np.pad(ratio, r, mode="edge"), kernel / kernel.sum(), mode="valid")


def _regions(lines: list[str], ratio: np.ndarray, sigma: float) -> list[bool]:
    at = [k for k, x in enumerate(lines) if x.strip()]
    out = [False] * len(lines)
    if at:
        v = ratio[at]
        smooth = _smooth(v, sigma)
        least = 0.5 * float(smooth.std())
        for k, s, x in zip(at, smooth, v):
            out[k] = bool(s >= least and x > 0)
    return out


def content_regions(text: str, sigma: float = 1.0) -> list[bool]:
    """Per line whether it lies in a content region by its smoothed text-to-tag ratio.

    Blank lines take no part in the smoothing and are never content. The
    threshold is half the standard deviation of the smoothed ratios.
    """
    return _regions(text.split("\n"), ratios(text)[0], sigma)


def without_mark_lines(text: str, sigma: float = 1.0) -> str:
    """``text`` without the lines of marks that lie outside its content regions."""
    lines = text.split("\n")
    ratio, marks = ratios(text)
    regions = _with_whole_html(text, _regions(lines, ratio, sigma))
    for m in CODE.finditer(text):
        first = text.count("\n", 0, m.start())
        last = first + m[0].count("\n") + 1
        regions[first:last] = [True] * (last - first)
    return "\n".join(x for x, n, inside in zip(lines, marks, regions) if inside or not n or _STRUCTURE.match(x))


_MD_RULES = (
    (re.compile(r"(?m)^([^\n]+)\n={3,}[ \t]*$"), r"# \1"),
    (re.compile(r"(?m)^([^\s|\-][^\n]*)\n-{3,}[ \t]*$"), r"## \1"),
    (re.compile(r"!\[([^\]\[]*)\]\([^)\n]*\)"), r"\1"),
    (re.compile(r"\[([^\]\[]*)\]\([^)\n]*\)"), r"\1"),
    (re.compile(r"\[([^\]\[\n]+)\]\[\w*\]"), r"\1"),
    (re.compile(r"(?m)^ {0,3}\[[^\]\n]+\]:[ \t]+\S.*$\n?"), ""),
    (re.compile(r"\[\^[^\]\s]+\]:?"), ""),
    (re.compile(r"(?<![\w*\\])(\*{1,3})(?=[^\s*])((?:[^*\n]|\n(?!\s*\n))*?[^\s*])\1(?![\w*])"), r"\2"),
    (re.compile(r"(?<![\w_\\])(_{1,2})(?=[^\s_])([^_\n]*?[^\s_])\1(?![\w_])"), r"\2"),
    (re.compile(r"~~(?=\S)((?:[^~\n]|\n(?!\s*\n))*?)~~"), r"\1"),
    (re.compile(r"(?m)^ {0,3}>[ \t]?"), ""),
    (re.compile(r"(?m)^[ \t]*\|?[ \t]*:?-{3,}:?[ \t]*\|[ \t|:\-]*$\n?"), ""),
    (re.compile(r"(?m)^[ \t]*[*+•»][ \t]+"), "- "),
)
_WIKI_RULES = (
    (re.compile(r"\{\{\s*(?:lang|nowrap|nobr|small)\s*\|(?:[^{}|]*\|)*([^{}|]*)\}\}"), r"\1"),
    (re.compile(r"\{\{[^{}]*\}\}"), ""),
    (re.compile(r"\[\[(?:[^\[\]|]*\|)*:?([^\[\]|]+)\]\]"), r"\1"),
    (re.compile(r"\[(?:https?:|ftp:)?//[^\s\]]+\s+([^\]\n]*)\]"), r"\1"),
    (re.compile(r"\[(?:https?:|ftp:)?//[^\s\]]+\]"), ""),
    (re.compile(r"'{2,5}"), ""),
    (re.compile(r"(?m)^(={2,6})[ \t]*([^=\n]+?)[ \t]*\1[ \t]*$"), lambda m: "#" * len(m[1]) + " " + m[2]),
    (re.compile(r"(?m)^\{\|.*$\n?|^\|-.*$\n?|^\|\}.*$\n?"), ""),
    (re.compile(r"(?m)^[|!][ \t]*(.*)$"), lambda m: "| " + re.sub(r"\s*(?:\|\||!!)\s*", " | ", m[1])),
)
_LATEX_RULES = (
    (re.compile(r"\\(?:section|chapter)\*?\{([^{}]*)\}"), r"# \1"),
    (re.compile(r"\\title\{([^{}]*)\}"), r"# \1"),
    (re.compile(r"\\subsection\*?\{([^{}]*)\}"), r"## \1"),
    (re.compile(r"\\subsubsection\*?\{([^{}]*)\}"), r"### \1"),
    (re.compile(r"\\begin\{(equation|align|displaymath)\*?\}(.*?)\\end\{\1\*?\}", re.S), r"$$\2$$"),
    (re.compile(r"\\\(((?:[^\n]|\n(?!\s*\n))+?)\\\)"), r"$\1$"),
    (re.compile(r"\\\[([^\]]+?)\\\]"), r"$$\1$$"),
    (re.compile(r"~?\\(?:footnote|label|ref|cite[pt]?|index|pageref|eqref)\*?(?:\[[^\]]*\])?\{[^{}]*\}"), ""),
    (re.compile(r"(?m)^[ \t]*\\item(?:\[[^\]]*\])?[ \t]*"), "- "),
    (re.compile(r"\\(?:begin|end)\{(?:itemize|enumerate|document|center|quote|abstract|description|figure|table)\}\n?"), ""),
    (re.compile(r"\\(?:textbf|textit|emph|underline|texttt|textsc|text|mbox|url)\{([^{}]*)\}"), r"\1"),
    (re.compile(r"\\(?:maketitle|par|noindent|newline|linebreak|bigskip|smallskip|medskip|centering)\b|\\\\"), ""),
)


def clean(text: str | None, found: list[str] | None = None) -> str | None:
    """Clean text with headings, lists, code and formulas still marked."""
    if not text:
        return text
    found = kinds(text) if found is None else found
    text = text.replace("\r\n", "\n")
    if not found:
        return text
    kept: list[str] = []

    def aside(m: re.Match) -> str:
        kept.append(m[0])
        return f"\x00{len(kept) - 1}\x00"

    text = without_mark_lines(FENCE.sub(aside, text))
    if "latex" in found:
        for rule, to in _LATEX_RULES:
            text = rule.sub(to, text)
        text = re.sub(r"\$\$[^$]+\$\$|\$(?=[^\s$])[^$\n]*\$", aside, text)
    if "wiki" in found:
        for rule, to in _WIKI_RULES:
            text = rule.sub(to, text)
    if "html" in found:
        text = _parse(text, build=True).text()
    if "markdown" in found:
        text = re.sub(r"`[^`\n]+`", aside, text)
        for rule, to in _MD_RULES:
            text = rule.sub(to, text)
    text = re.sub(r"\n{3,}", "\n\n", text)
    while "\x00" in text:
        before, text = text, re.sub("\x00(\\d+)\x00", lambda m: kept[int(m[1])], text)
        if before == text:
            break
    return text.strip("\n")


_OUT = pa.schema([("doc_id", pa.int64()), ("kinds", pa.list_(pa.string())), ("clean_text", pa.string()), ("content_text", pa.string()), ("n_lines", pa.int32()), ("n_content_lines", pa.int32())])


def _clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows = []
        for i, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            found = kinds(text)
            if text is None:
                rows.append((i, found, None, None, 0, 0))
                continue
            regions = content_regions(text)
            content = "\n".join(x for x, keep in zip(text.split("\n"), _with_whole_html(text, regions)) if keep)
            rows.append((i, found, clean(text, found), clean(content, kinds(content)), len(regions), sum(regions)))
        cols = list(zip(*rows)) if rows else [[] for _ in _OUT]
        yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(cols, _OUT)], schema=_OUT)


def clean_markup(docs: DataFrame) -> DataFrame:
    """Per document its kinds, clean_text, and content_text of the content regions alone."""
    return docs.select("doc_id", "text").mapInArrow(
        _clean, "doc_id long, kinds array<string>, clean_text string, content_text string, n_lines int, n_content_lines int"
    )


def markup_kinds(docs: DataFrame) -> DataFrame:
    """(doc_id, markup_kind): each kind with at least one mark, by the pass of ``clean_markup``; needs doc_id and text only."""
    return clean_markup(docs).select("doc_id", F.explode("kinds").alias("markup_kind"))
