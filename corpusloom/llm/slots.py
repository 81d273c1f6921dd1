"""Syntax of unfilled template slots and of code, shared by the markup and residue operators."""

from __future__ import annotations

import re

# Names that templates commonly give to their variables, besides any snake_case or dotted name.
_VARIABLE = (
    r"(?:title|name|summary|author|caption|city|price|date|url|image|content|body|text|description|heading|label|user|email|phone|address|"
    r"baslik|başlık|ozet|özet|yazar|fiyat|sehir|şehir|tarih|isim|ad|titel|zusammenfassung|autor|preis|stadt|datum|beschreibung|[a-z]+(?:_[a-z0-9]+)+|[a-z]+(?:[A-Z][a-z]+)+)"
)
_UNSET = r"(?:undefined|null|NaN|None|nil|\[object Object\])"

# Syntaxes of unfilled slots, each with what a text must hold for it. Wiki templates and
# code must have been told apart by the caller.
_SLOTS = [
    (trigger, re.compile(pattern))
    for trigger, pattern in (
        # {{name}}, not glued to what precedes it as wiki templates are
        ("{{", r"\{\{(?:(?<=[\s(:\"']..)|(?<![\s\S]..))\s*[A-Za-z_][\w.]*\s*\}\}(?![}<])"),
        ("${", r"\$\{\s*[A-Za-z_][\w.]*\s*\}"),
        ("<%", r"<%[=-]?\s*[\w.\s]{1,60}%>"),
        ("{%", r"\{%-?\s*\w[^%\n]{0,60}%\}"),
        ("%", r"%%?[A-Z][A-Z_]{2,30}%%?"),
        ("%(", r"%\([A-Za-z_]\w*\)[sdf]"),
        ("__", r"__(?<!\w__)[A-Z][A-Z_]{2,30}__(?!\w)"),
        ("#", r"#(?<![\w#&]#)[A-Z][A-Z_]{2,30}#(?!\w)"),
        ("@", r"@(?:Model|model|ViewBag)\.\w+"),
        ("[", r"\[(?:INSERT|ENTER|YOUR|ADD)\b[^\]\n]{1,40}\]"),
        ("[", r"\[(?:[Bb]uraya|Hier)\b[^\]\n]{1,40}\]|\[[^\]\n]{1,30}\b(?:hier einfügen|gelecek|buraya)\]"),
        ("<", r"<(?:your|insert|enter|dein|ihr|hier)\b[^>\n]{1,40}>"),
        ("«", rf"«\s*{_VARIABLE}\s*»"),
        ("TBD:", rf"TBD: ?{_VARIABLE}\b"),
        ("TODO:", rf"TODO: ?{_VARIABLE}\b"),
        ("} ", rf"\{{\d\}} {_VARIABLE} \{{\d\}}"),
        ("Untitled {", r"Untitled \{\w+\}"),
        (": ", rf"(?<!\w)(?:{_VARIABLE}): {_UNSET}(?!\w)"),
    )
]
_UNSET_WORDS = ("undefined", "null", "NaN", "None", "nil", "[object Object]")


def _possible(text: str):
    for trigger, pattern in _SLOTS:
        if trigger in text and (trigger != ": " or any(x in text for x in _UNSET_WORDS)):
            yield pattern


def find_slot(text: str) -> str | None:
    """The first unfilled slot of ``text`` that is found, or None."""
    for pattern in _possible(text):
        if m := pattern.search(text):
            return m[0]
    return None


def find_slots(text: str) -> list[str]:
    """The first match of each syntax that ``text`` holds."""
    return [m[0] for pattern in _possible(text) if (m := pattern.search(text))]


def without_slots(text: str) -> str:
    for pattern in _possible(text):
        text = pattern.sub(" ", text)
    return text


#: Fenced and otherwise marked code, whose content is nobody's markup and no slot.
FENCE = re.compile(r"(?ms)^[ \t]*(```+|~~~+)[^\n`]*\n.*?(?:^[ \t]*\1[ \t]*\r?$|\Z)")
CODE = re.compile(r"(?is)<(pre|code|script|style|nowiki|source|syntaxhighlight)\b[^>]*>.*?</\1\s*>|\\begin\{(verbatim|lstlisting)\}.*?\\end\{\2\}")
INLINE_CODE = re.compile(r"`[^`\n]+`")


def without_code(text: str, inline: bool = True) -> str:
    """``text`` with marked code replaced by a space."""
    if "```" in text or "~~~" in text:
        text = FENCE.sub(" ", text)
    if "</" in text or "\\begin{" in text:
        text = CODE.sub(" ", text)
    return INLINE_CODE.sub("`", text) if inline and "`" in text else text
