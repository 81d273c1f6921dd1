"""Hosts of addresses and how far their text can be trusted."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusloom.functions.text import casefold, contains_any, let

# Parts of host names whose pages need cleaning.
NOISY_HOST_PARTS = ("blog", "blogspot", "wordpress", "medium", "substack", "news", "haber", "gazete", "magazine", "dergi", "recipe", "recipes", "tarif", "yemek", "lezzet", "nefisyemek")
# Registrable domains, labels and parts of host names whose pages come clean.
TRUSTED_DOMAINS = ("wikipedia.org", "britannica.com")
TRUSTED_LABELS = ("gov", "edu", "ac", "museum")
TRUSTED_HOST_PARTS = ("muze", "müze")


def url_source(url: Column) -> Column:
    """The raw authority of an address: user info, port and case as they stand; '' if there is none."""
    return F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)", 1)


def url_domain(url: Column) -> Column:
    """The folded host without user info, port and a leading www."""
    host = F.substring_index(F.substring_index(casefold(url_source(url)), "@", -1), ":", 1)
    return F.regexp_replace(host, r"^www\.", "")


def is_noisy(domain: Column, parts: tuple[str, ...] = NOISY_HOST_PARTS) -> Column:
    return contains_any(domain, parts)


def is_trusted(domain: Column, domains: tuple[str, ...] = TRUSTED_DOMAINS, labels: tuple[str, ...] = TRUSTED_LABELS, parts: tuple[str, ...] = TRUSTED_HOST_PARTS, noisy: tuple[str, ...] = NOISY_HOST_PARTS) -> Column:
    """Whether a host's pages come clean; a noisy host never is."""

    def trusted(d: Column) -> Column:
        known = F.lit(False)
        for x in domains:
            known = known | (d == x) | F.endswith(d, F.lit("." + x))
        labelled = F.arrays_overlap(F.split(d, r"\."), F.array(*map(F.lit, labels)))
        return ~is_noisy(d, noisy) & (known | labelled | contains_any(d, parts))

    return let(domain, trusted)
