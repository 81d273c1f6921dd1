"""JSON replies of language models: finding and reading the JSON in them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusloom.functions.text import let, strip

_FENCED = r"(?s)```(?:json)?\s*(.*?)```"
_BRACKETED = r"(?s)(\{.*\}|\[.*\])"


def json_variant(reply: Column) -> Column:
    """The JSON value of a reply as VARIANT, or null.

    The first fenced block, or else the whole reply, is parsed; failing that,
    the longest run from its first opening bracket to the last closing one.
    """

    def fenced(text: Column) -> Column:
        return F.when(F.rlike(text, F.lit(_FENCED)), strip(F.regexp_extract(text, _FENCED, 1))).otherwise(text)

    def whole(x: Column) -> Column:
        # the parser ignores what follows a value: inside brackets it can't, and there must be one value only
        wrapped = F.try_parse_json(F.concat(F.lit("["), x, F.lit("]")))
        return let(wrapped, lambda v: F.when(F.try_variant_get(v, "$[1]", "variant").isNull(), F.try_variant_get(v, "$[0]", "variant")))

    def parsed(body: Column) -> Column:
        return F.coalesce(whole(body), whole(strip(F.regexp_extract(body, _BRACKETED, 1))))

    return let(let(strip(reply), fenced), parsed)


def first_heading(text: Column) -> Column:
    """The first level-one heading of a Markdown text, or null."""
    return F.nullif(strip(F.regexp_extract(text, r"(?md)^#\s+(.+?)\s*$", 1)), F.lit(""))


def title_or_heading(title: Column, text: Column) -> Column:
    """The stripped title, else the first heading, else ''."""
    return F.coalesce(F.nullif(strip(title), F.lit("")), first_heading(text), F.lit(""))
