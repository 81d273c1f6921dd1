"""Signs of page noise in a text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusloom.functions.text import casefold, contains_any, count_present, let, lines, word_count

# Phrases of site navigation.
NAVIGATION_PHRASES = (
    "cookie", "çerez", "gizlilik politikası", "privacy policy", "advertisement", "advertisements", "reklam", "subscribe", "newsletter", "sign in", "log in", "login", "üye girişi", "ana sayfa", "menü",
    "related articles", "you may also like", "read more", "devamını oku", "yorumlar", "all rights reserved", "tüm hakları saklıdır", "share this", "social media",
)
# Phrases of talk that holds no knowledge.
PERSONAL_PHRASES = (
    "i think", "i tried", "i love", "i loved", "my favorite", "personally", "in my opinion", "we think", "we loved", "we recommend", "our favorite", "book now", "visit us", "contact us", "call us", "try this today",
    "benim favorim", "bence", "denedim", "denedik", "çok sevdim", "çok sevdik", "tavsiye ederim", "tavsiye ederiz", "bize ulaşın", "rezervasyon", "hemen deneyin", "ziyaret edin",
)
# Thresholds of the navigation test.
MIN_PHRASES, MIN_LINES, MAX_WORDS, MAX_SHARE = 2, 20, 4, 0.35


def navigation_phrases(text: Column, phrases: tuple[str, ...] = NAVIGATION_PHRASES) -> Column:
    return count_present(casefold(text), phrases)


def is_navigation_line(line: Column) -> Column:
    """A stripped line of few words that starts with a link, bare or as a list item."""
    return (F.startswith(line, F.lit("[")) | F.startswith(line, F.lit("- [")) | F.startswith(line, F.lit("* ["))) & (word_count(line) <= MAX_WORDS)


def has_navigation(text: Column, phrases: tuple[str, ...] = NAVIGATION_PHRASES) -> Column:
    """Two phrases, or more than 35 % navigation lines among at least 20 lines."""

    def many(ls: Column) -> Column:
        return (F.size(ls) >= MIN_LINES) & (F.size(F.filter(ls, is_navigation_line)) / F.size(ls) > MAX_SHARE)

    return (navigation_phrases(text, phrases) >= MIN_PHRASES) | let(lines(text), many)


def has_personal_talk(text: Column, phrases: tuple[str, ...] = PERSONAL_PHRASES) -> Column:
    return contains_any(casefold(text), phrases)
