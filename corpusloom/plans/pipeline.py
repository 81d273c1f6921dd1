"""The whole pipeline as a composition of DataFrame stages.

seeds -> expand -> enrich -> decide -> search -> extract -> route -> clean -> store

Remote services answer from tables: decisions, search results, extractions and
cleaning replies. Work already stored is skipped before anything is planned,
and every address is extracted once however many tasks name it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import chunks, hosts, replies
from corpusloom.operators import enrich, frontier, planning, routing, searching, storing


@dataclass
class Tables:
    """What the services answered. Every field is a DataFrame.

    seeds (title, max_depth, entity_limit); links (src, ord, dst); pages (title,
    summary, categories); decisions (title, reply); plans (plan_id, entity_id,
    tasks); ids (entity_id, title), the ids that the plans use;
    extractions (url, pos, title, text); cleaned (url, batch_no, reply); stored (entity_title).
    """

    seeds: DataFrame
    links: DataFrame
    pages: DataFrame
    decisions: DataFrame
    ids: DataFrame
    plans: DataFrame
    extractions: DataFrame
    cleaned: DataFrame
    stored: DataFrame


def discovered(t: Tables) -> DataFrame:
    """Entities of all usable seeds with their metadata, without those stored already."""
    entities, _ = frontier.expand(frontier.usable_seeds(t.seeds)[0], t.links)
    return enrich.enrich(storing.not_stored(entities, t.stored), t.pages)


def decided(entities: DataFrame, t: Tables) -> DataFrame:
    """Entities with a decision each: the one replied, or the permissive default."""
    joined = entities.join(t.decisions.dropDuplicates(["title"]), "title", "left").withColumn("d", planning.parse_decision(F.col("reply")))
    return planning.with_fallback(joined.select(*entities.columns, "d.*"))


def addresses(kept: DataFrame, t: Tables, k: int = 2) -> DataFrame:
    """(entity_id, plan_id, task_no, result_no, url) of the first results of every task of a kept entity."""
    ids = t.ids.join(kept.select("title").distinct(), "title", "left_semi")
    return searching.top_results(t.plans, k).join(ids.select("entity_id"), "entity_id").select("entity_id", "plan_id", "task_no", "result_no", "url")


def cleaned_pages(urls: DataFrame, t: Tables) -> DataFrame:
    """(url, title, text, route) of every distinct address that was extracted."""
    pages = routing.best_extraction(t.extractions.join(urls.select("url").distinct(), "url", "left_semi"), "url", "pos")
    routed = pages.withColumn("title", replies.title_or_heading(F.col("title"), F.col("text"))).withColumn("route", routing.route(F.col("url"), F.col("text"))).where("route <> 'drop'")
    single = t.cleaned.where("batch_no = 0").select("url", "reply")
    passed = routed.where("route = 'pass'").select("url", "title", "text", "route")
    short = routed.where("route = 'single'").join(single, "url", "left").select("url", "title", chunks.clean_one(F.col("text"), F.col("reply")).alias("text"), "route")
    long = routed.where("route = 'batch'")
    parts = routing.batched(long, "url").join(t.cleaned, ["url", "batch_no"], "left").select("url", "batch_no", chunks.clean_batch(F.col("parts"), F.col("reply")).alias("parts"))
    joined = routing.merged(parts, "url").select("url", "text").join(long.select("url", "title", "route"), "url").select("url", "title", "text", "route")
    return passed.unionByName(short).unionByName(joined)


def run_counters(t: Tables, docs: DataFrame, kept: DataFrame, rejected: DataFrame) -> DataFrame:
    """One row: discovered, planned, included, excluded, fallbacks, downloaded."""
    entities, _ = frontier.expand(frontier.usable_seeds(t.seeds)[0], t.links)
    one = lambda df, name: df.agg(F.count("*").alias(name))
    planned = planning.counters(kept.union(rejected))
    return one(entities, "n_discovered").join(planned, F.lit(True)).join(one(docs, "n_downloaded"), F.lit(True))


def run(t: Tables) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(documents to store, entities kept, entities rejected)."""
    kept, rejected = planning.split(decided(discovered(t), t))
    found = addresses(kept, t)
    pages = cleaned_pages(found, t)
    docs = found.join(pages, "url").withColumn("source", hosts.url_source(F.col("url"))).join(t.ids.withColumnRenamed("title", "entity"), "entity_id")
    return storing.last_per_source(docs, "entity", "source", ["plan_id", "task_no", "result_no"]), kept, rejected
