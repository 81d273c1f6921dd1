"""Texts sent to language models, built as expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusloom.functions.chunks import format_batch

PLAN = """Decide whether a page belongs in a knowledge base about one topic.
Topic: %s
Found from: %s
Page: %s
Introduction: %s
Categories:
%s
Known types: %s
Known kinds of information: %s
When in doubt, include it. Answer with JSON: include, expand, entity_type (name, subtype), information_to_collect (name, priority 1 to 5), reason."""
SEARCH = """Write one web query for each kind of information to be collected.
Page: %s
Introduction: %s
Kinds of information: %s
Answer with JSON: tasks, each with information and query."""
CLEAN = """Remove from this fragment of a web page whatever is not about its subject: menus, notices, adverts, personal talk.
Keep every fact and the order, leave headings, lists and tables, do not summarise.
If nothing remains, answer with exactly %s

%s"""
CLEAN_BATCH = """Remove from each of these %s fragments of a web page whatever is not about its subject: menus, notices, adverts, personal talk.
Keep every fact and the order, leave headings, lists and tables, do not summarise.
Answer with the same separator and PART line before each fragment, every number once and in order.
If nothing of a fragment remains, put exactly %s in its place

%s"""


def plan_prompt(seed: Column, parent: Column, title: Column, summary: Column, categories: Column, types: str, kinds: str) -> Column:
    """The question whether to include an entity; a root's parent is given as None."""
    return F.format_string(PLAN, seed, F.coalesce(parent, F.lit("None")), title, F.coalesce(summary, F.lit("")), F.coalesce(F.array_join(categories, "\n"), F.lit("")), F.lit(types), F.lit(kinds))


def registry_text(entries: list[tuple[str | None, str | None]]) -> str:
    """A registry as a prompt shows it: one line an entry, with its description if it has one."""
    return "\n".join(f"- {name}: {description}" if description else f"- {name}" for name, description in entries if name)


def search_prompt(title: Column, summary: Column, kinds: Column) -> Column:
    """The request for one query for each kind of information (an array of names)."""
    return F.format_string(SEARCH, title, F.coalesce(summary, F.lit("")), F.coalesce(F.array_join(kinds, ", "), F.lit("")))


def clean_prompt(text: Column, marker: str) -> Column:
    return F.format_string(CLEAN, F.lit(marker), text)


def clean_batch_prompt(parts: Column, marker: str) -> Column:
    """The request to clean all parts of a batch at once."""
    return F.format_string(CLEAN_BATCH, F.size(parts).cast("string"), F.lit(marker), format_batch(parts))
