"""Titles of linked pages: which to keep, their addresses and file names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusloom.functions.text import casefold, strip

# Name spaces whose pages are no articles.
BLOCKED_NAMESPACES = (
    "book", "category", "category talk", "draft", "file", "file talk", "gadget", "gadget definition", "help", "help talk", "media", "mediawiki", "module", "portal", "portal talk", "project", "special", "talk",
    "template", "template talk", "timedtext", "topic", "user", "user talk",
    "dosya", "dosya tartışma", "kategori", "kategori tartışma", "kitap", "konu", "kullanıcı", "kullanıcı mesaj", "mediawiki tartışma", "medya", "modül", "portal tartışma", "taslak", "tartışma", "vikipedi",
    "vikipedi tartışma", "yardım", "yardım tartışma", "şablon", "şablon tartışma", "özel",
)

_UNSAFE = r'[<>:"/\\|?*]'


def keep_title(title: Column, blocked: tuple[str, ...] = BLOCKED_NAMESPACES) -> Column:
    """False for null and blank titles and those whose prefix before the first colon is a blocked name space."""
    prefix = casefold(strip(F.substring_index(title, ":", 1)))
    # the cheap tests come first: most titles have no colon and need no folding
    return F.coalesce(F.rlike(title, F.lit(r"(?U)\S")) & ~(F.contains(title, F.lit(":")) & prefix.isin(*blocked)), F.lit(False))


def article_url(title: Column, base: str) -> Column:
    """Address of a title: spaces as underscores, UTF-8 percent-encoded, slashes kept."""
    enc = F.url_encode(F.replace(title, F.lit(" "), F.lit("_")))
    for a, b in (("%2F", "/"), ("%7E", "~"), ("*", "%2A")):
        enc = F.replace(enc, F.lit(a), F.lit(b))
    return F.concat(F.lit(base), enc)


def safe_name(name: Column) -> Column:
    """Without characters that file systems reject; empty and dot names are the caller's to handle."""
    return strip(F.regexp_replace(name, _UNSAFE, ""))


def output_name(title: Column, depth: Column) -> Column:
    """File name of a seed's discovered entities."""
    return F.concat(F.regexp_replace(safe_name(title), r"(?U)\s+", "_"), F.lit("_depth_"), depth.cast("string"), F.lit(".json"))
