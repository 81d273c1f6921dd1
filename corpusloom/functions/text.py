"""Text expressions with the semantics the pipeline needs, as Catalyst expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Line ends other than LF that also separate lines.
LINE_END = r"\r\n|[\n\r\x0B\x0C\x1C-\x1E\x{85}\x{2028}\x{2029}]"


def let(x: Column, f: Callable[[Column], Column]) -> Column:
    """``f(x)`` with ``x`` evaluated once, however often ``f`` names it; null stays an argument like any other."""
    return F.element_at(F.transform(F.array(x), f), 1)


def casefold(x: Column) -> Column:
    """Case folding: dotted capital I becomes two code points, sharp s becomes ss, final sigma and long s become plain."""
    return F.translate(F.replace(F.lower(F.replace(x, F.lit("İ"), F.lit("i̇"))), F.lit("ß"), F.lit("ss")), "ςſ", "σs")


def strip(x: Column) -> Column:
    """Without white space of any kind at both ends; ``trim`` removes spaces only."""
    return F.regexp_replace(x, r"(?U)^\s+|\s+$", "")


def lines(x: Column) -> Column:
    """The non-blank lines, stripped."""
    return F.filter(F.transform(F.split(x, LINE_END), strip), lambda s: s != "")


def word_count(x: Column) -> Column:
    """Number of white-space separated words of a stripped text."""
    return F.when(x == "", F.lit(0)).otherwise(F.size(F.split(x, r"(?U)\s+")))


def count_present(x: Column, phrases: tuple[str, ...]) -> Column:
    """How many of the phrases occur in ``x``."""
    return let(x, lambda t: F.size(F.filter(F.array(*map(F.lit, phrases)), lambda p: F.contains(t, p))))


def contains_any(x: Column, phrases: tuple[str, ...]) -> Column:
    """Whether any of the phrases occurs in ``x``."""
    return let(x, lambda t: F.exists(F.array(*map(F.lit, phrases)), lambda p: F.contains(t, p)))
