"""The q_ queries of the core operators and the SQL that checks them.

Every query runs over its whole tables. Replies of language models, which the
tables don't hold, are derived from the rows themselves by their length, so
that every kind of reply occurs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions import chunks, hosts, prompts, replies, signals, titles
from corpusloom.functions import text as tx
from corpusloom.operators import enrich, frontier, planning, ranking, routing, searching, storing
from corpusloom.plans import pipeline
from corpusloom.session import bounded_rows, documents, ship, table

_BASE = "https://tr.wiki.example/wiki/"


def _latest_entities(spark: SparkSession, sf: str) -> DataFrame:
    """The last loaded row of every title; the deepest of equal times."""
    e = table(spark, sf, "entities")
    rest = F.struct("loaded_at", "depth", "entity_id", "parent")
    return e.groupBy("title").agg(F.max(rest).alias("r")).select("title", "r.depth", "r.parent", "r.entity_id")


def q_bfs(spark, sf):
    return frontier.expand(table(spark, sf, "seeds"), table(spark, sf, "links"))[0]


def q_bfs_children(spark, sf):
    claims = frontier.expand(table(spark, sf, "seeds"), table(spark, sf, "links"))[1]
    return claims.select("seed", "parent", F.col("pos").cast("int").alias("pos"), "child")


def q_links_scan(spark, sf):
    from pyspark.sql.window import Window

    links = table(spark, sf, "links")
    pos = F.row_number().over(Window.partitionBy("src").orderBy("ord", F.col("dst").asc_nulls_first())) - 1
    return links.select("src", pos.alias("pos"), "dst")


def q_title_filter(spark, sf):
    return table(spark, sf, "links").select(F.col("dst").alias("title")).distinct().select("title", titles.keep_title(F.col("title")).alias("kept"))


def q_article_url(spark, sf):
    return table(spark, sf, "entities").select("title").distinct().select("title", titles.article_url(F.col("title"), _BASE).alias("article_url"))


def q_output_filename(spark, sf):
    e = table(spark, sf, "entities").select("title", "depth").union(table(spark, sf, "seeds").select("title", "max_depth")).distinct()
    return e.select("title", "depth", titles.output_name(F.col("title"), F.col("depth")).alias("file_name"))


def q_sanitize(spark, sf):
    return documents(spark, sf).select("doc_id", titles.safe_name(F.col("url")).alias("safe_url"), titles.safe_name(F.col("title")).alias("safe_title"))


def q_enrich(spark, sf):
    done = enrich.enrich(_latest_entities(spark, sf), table(spark, sf, "page_info"))
    return done.select("title", "depth", "parent", "summary", F.size("categories").alias("n_categories"), F.array_join("categories", "\n").alias("categories"))


def q_fixed_batches(spark, sf):
    return ranking.fixed_batches(table(spark, sf, "entities").select("title").distinct(), ["title"], 50).select("title", "batch_no", "batch_pos")


def q_url_source(spark, sf):
    return documents(spark, sf).select("doc_id", hosts.url_source(F.col("url")).alias("url_source"))


def q_url_domain(spark, sf):
    return documents(spark, sf).select("doc_id", hosts.url_domain(F.col("url")).alias("url_domain"))


def q_source_route(spark, sf):
    d = hosts.url_domain(F.col("url"))
    return documents(spark, sf).select("doc_id", hosts.is_noisy(d).alias("noisy"), hosts.is_trusted(d, domains=(*hosts.TRUSTED_DOMAINS, "wiki.example", "invalid")).alias("trusted"))


def q_nav_artifacts(spark, sf):
    t = F.col("text")
    ls = tx.lines(t)
    return documents(spark, sf).select(
        "doc_id",
        signals.navigation_phrases(t).alias("n_phrases"),
        F.size(ls).alias("n_lines"),
        F.size(F.filter(ls, signals.is_navigation_line)).alias("n_navigation_lines"),
        signals.has_navigation(t).alias("has_navigation"),
    )


def q_prose_flags(spark, sf):
    return documents(spark, sf).select("doc_id", signals.has_personal_talk(F.col("text")).alias("personal"))


def q_chunk_overlap(spark, sf):
    d = documents(spark, sf).select("doc_id", "text", F.posexplode(chunks.overlap_windows(F.col("text"))).alias("pos", "s"))
    return d.select("doc_id", "pos", "s.start", F.col("s.len").alias("length"), F.md5(F.substring(F.col("text"), F.col("s.start") + 1, F.col("s.len"))).alias("digest"))


def q_chunk_sections(spark, sf):
    return routing.chunked(documents(spark, sf)).select("doc_id", "chunk_no", "start", "length", F.md5("chunk").alias("digest"))


def _batches(spark, sf) -> DataFrame:
    return routing.batched(documents(spark, sf))


def q_batch_pack(spark, sf):
    size = F.aggregate(F.transform("parts", lambda p: F.length(p)), F.lit(0), lambda a, x: a + x)
    return _batches(spark, sf).select("doc_id", "batch_no", F.size("parts").alias("n_parts"), size.alias("size"))


def q_batch_format(spark, sf):
    text = chunks.format_batch(F.col("parts"))
    return _batches(spark, sf).select("doc_id", "batch_no", F.length(text).alias("length"), F.md5(text).alias("digest"))


def _batch_reply(text: Column) -> Column:
    kind = F.length(text) % 6
    return (
        F.when(kind == 0, F.lit(None).cast("string"))
        .when(kind == 1, F.replace(text, F.lit("\nPART 1\n"), F.lit("\nPART 2\n")))
        .when(kind == 2, F.concat(F.lit("Here it is.\n\n"), text))
        .when(kind == 3, F.concat(text, F.lit(f"\n\n{chunks.SEPARATOR}\nPART 99\n\nmore")))
        .when(kind == 4, F.concat(F.lit(f"{chunks.SEPARATOR}\nPART 1\n\n {chunks.EMPTY_MARKER} \n")))
        .otherwise(F.replace(text, F.lit("e"), F.lit("E")))
    )


def _replied(spark, sf) -> DataFrame:
    text = chunks.format_batch(F.col("parts"))
    return _batches(spark, sf).select("doc_id", "batch_no", "parts", _batch_reply(text).alias("reply"))


def q_batch_parse(spark, sf):
    parsed = chunks.parse_batch(F.col("reply"), F.size("parts"))
    return _replied(spark, sf).select("doc_id", "batch_no", parsed.isNotNull().alias("usable"), F.md5(F.array_join(parsed, "\n\n")).alias("digest"))


def _single_reply(text: Column) -> Column:
    kind = F.length(text) % 4
    return F.when(kind == 0, F.lit(None).cast("string")).when(kind == 1, F.lit(f"  {chunks.EMPTY_MARKER}\n")).when(kind == 2, F.lit("")).otherwise(F.concat(F.lit("* "), text))


def q_clean_apply(spark, sf):
    done = chunks.clean_one(F.col("text"), _single_reply(F.col("text")))
    return documents(spark, sf).select("doc_id", F.length(done).alias("length"), F.md5(done).alias("digest"))


def q_chunk_merge(spark, sf):
    cleaned = _replied(spark, sf).select("doc_id", "batch_no", chunks.clean_batch(F.col("parts"), F.col("reply")).alias("parts"))
    return routing.merged(cleaned).select("doc_id", "n_parts", F.md5("text").alias("digest"))


def q_route(spark, sf):
    return documents(spark, sf).select("doc_id", routing.route(F.col("url"), F.col("text"), domains=(*hosts.TRUSTED_DOMAINS, "invalid")).alias("route"))


def q_extract_best(spark, sf):
    best = routing.best_extraction(documents(spark, sf).select("entity_title", "doc_id", "text"), "entity_title", "doc_id")
    return best.select("entity_title", "doc_id", F.length("text").alias("length"))


def q_title_fallback(spark, sf):
    return documents(spark, sf).select("doc_id", replies.title_or_heading(F.col("title"), F.col("text")).alias("best_title"))


def _escaped(x: Column) -> Column:
    x = F.regexp_replace(F.coalesce(x, F.lit("")), r"[\x00-\x1F]", " ")
    return F.replace(F.replace(x, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))


def _decision_replies(spark, sf) -> DataFrame:
    d = _decisions(spark, sf)
    word = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("null"))
    body = F.concat(F.lit('{"include": '), word("include"), F.lit(', "expand": '), word("expand"), F.lit(', "entity_type": {"name": "'), _escaped(F.col("entity_type.name")), F.lit('"}, "reason": "'), _escaped(F.col("reason")), F.lit('"}'))
    d = d.select("decision_id", body.alias("body"))
    body, kind = F.col("body"), F.length("body") % 6
    reply = (
        F.when(kind == 0, body)
        .when(kind == 1, F.concat(F.lit("```json\n"), body, F.lit("\n```")))
        .when(kind == 2, F.concat(F.lit("Here is the decision:\n"), body, F.lit("\nDone.")))
        .when(kind == 3, F.concat(F.lit("x [1] "), body))
        .when(kind == 4, F.substring(body, 1, 20))
        .otherwise(F.concat(F.lit("no decision for "), F.col("decision_id").cast("string")))
    )
    return d.select("decision_id", reply.alias("reply"))


def q_json_extract(spark, sf):
    v = replies.json_variant(F.col("reply"))
    return _decision_replies(spark, sf).select(
        "decision_id", v.isNotNull().alias("parsed"), F.try_variant_get(v, "$.include", "boolean").alias("include"), F.try_variant_get(v, "$.entity_type.name", "string").alias("type_name")
    )


def q_json_quarantine(spark, sf):
    return planning.quarantine(_decision_replies(spark, sf)).select("decision_id", F.md5("reply").alias("digest"))


def _decisions(spark, sf) -> DataFrame:
    """Decisions delivered again, unchanged, count once."""
    return table(spark, sf, "decisions").dropDuplicates(["decision_id"])


def q_plan_validate(spark, sf):
    return planning.with_validity(_decisions(spark, sf)).select("decision_id", "valid")


def q_plan_fallback(spark, sf):
    d = planning.with_fallback(_decisions(spark, sf))
    return d.select("decision_id", "include", "expand", F.col("entity_type.name").alias("type_name"), F.size("information_to_collect").alias("n_items"), "valid")


def q_plan_split(spark, sf):
    kept, rejected = planning.split(planning.with_fallback(_decisions(spark, sf)))
    return kept.select("decision_id", "entity_id", F.lit("kept").alias("side")).union(rejected.select("decision_id", "entity_id", F.lit("rejected")))


def q_run_counters(spark, sf):
    return planning.counters(planning.with_fallback(_decisions(spark, sf)))


def q_search_topk(spark, sf):
    return searching.top_results(table(spark, sf, "search_plan"))


def q_doc_upsert(spark, sf):
    r = searching.results(table(spark, sf, "search_plan")).withColumn("source", hosts.url_source(F.col("url"))).withColumn("entity", F.col("entity_id").cast("string"))
    return storing.last_per_source(r.select("entity", "source", "plan_id", "task_no", "result_no", "url"), "entity", "source", ["plan_id", "task_no", "result_no"]).select("entity_key", "source_key", "plan_id", "task_no", "result_no", "url")


def q_incremental_skip(spark, sf):
    return storing.not_stored(table(spark, sf, "entities").select("title").distinct(), documents(spark, sf))


def _registry(spark, sf, name: str, id_: str) -> str:
    df = table(spark, sf, name)
    rows = bounded_rows(df.select(id_, "name", *(["description"] if "description" in df.columns else [F.lit(None).alias("description")])), 10_000, name)
    return prompts.registry_text([(r["name"], r["description"]) for r in sorted(rows, key=lambda r: r[0])])


def q_prompt_fields(spark, sf):
    found = frontier.expand(table(spark, sf, "seeds"), table(spark, sf, "links"))[0]
    e = enrich.enrich(found, table(spark, sf, "page_info"))
    p = prompts.plan_prompt(F.col("seed"), F.col("parent"), F.col("title"), F.col("summary"), F.col("categories"), _registry(spark, sf, "entity_types", "type_id"), _registry(spark, sf, "information_types", "info_id"))
    return e.select("seed", "title", F.length(p).alias("length"), F.md5(p).alias("digest"))


def q_search_prompt(spark, sf):
    names = table(spark, sf, "entities").groupBy("entity_id").agg(F.min("title").alias("title"))
    kept, _ = planning.split(planning.with_fallback(_decisions(spark, sf)))
    e = enrich.enrich(kept.join(names, "entity_id").select("decision_id", "title", "information_to_collect"), table(spark, sf, "page_info"))
    p = prompts.search_prompt(F.col("title"), F.col("summary"), F.transform("information_to_collect", lambda x: x["name"]))
    return e.select("decision_id", F.length(p).alias("length"), F.md5(p).alias("digest"))


def q_clean_prompt(spark, sf):
    p = prompts.clean_prompt(F.col("text"), chunks.EMPTY_MARKER)
    return documents(spark, sf).select("doc_id", F.length(p).alias("length"), F.md5(p).alias("digest"))


def q_clean_batch_prompt(spark, sf):
    p = prompts.clean_batch_prompt(F.col("parts"), chunks.EMPTY_MARKER)
    return _batches(spark, sf).select("doc_id", "batch_no", F.length(p).alias("length"), F.md5(p).alias("digest"))


def _tables(spark, sf) -> pipeline.Tables:
    """The pipeline's tables; extraction answers every address with a page headed by it, no language model answers."""
    plans, entities = table(spark, sf, "search_plan"), table(spark, sf, "entities")
    empty = lambda schema: spark.createDataFrame([], schema)
    text = F.concat(F.lit("# "), F.col("url"), F.lit("\nA page about it."))
    return pipeline.Tables(
        seeds=table(spark, sf, "seeds"), links=table(spark, sf, "links"), pages=table(spark, sf, "page_info"), decisions=empty("title string, reply string"),
        ids=entities.select("entity_id", "title").distinct(), plans=plans,
        extractions=searching.results(plans).select("url").distinct().select("url", F.lit(0).alias("pos"), F.lit(None).cast("string").alias("title"), text.alias("text")),
        cleaned=empty("url string, batch_no int, reply string"), stored=table(spark, sf, "documents").select("entity_title"),
    )


def q_pipeline(spark, sf):
    docs, _, _ = pipeline.run(_tables(spark, sf))
    return docs.select("entity_key", "source_key", "entity", "plan_id", "task_no", "result_no", "url", F.col("title").alias("page_title"), "route", F.length("text").alias("length"))


_QUERIES = (
    q_bfs, q_bfs_children, q_links_scan, q_title_filter, q_article_url, q_output_filename, q_sanitize, q_enrich, q_fixed_batches, q_url_source, q_url_domain, q_source_route, q_nav_artifacts, q_prose_flags,
    q_chunk_overlap, q_chunk_sections, q_batch_pack, q_batch_format, q_batch_parse, q_clean_apply, q_chunk_merge, q_route, q_extract_best, q_title_fallback, q_json_extract, q_json_quarantine, q_plan_validate,
    q_plan_fallback, q_plan_split, q_run_counters, q_search_topk, q_doc_upsert, q_incremental_skip, q_prompt_fields, q_search_prompt, q_clean_prompt, q_clean_batch_prompt, q_pipeline,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def shipped(f):
        def run(spark: SparkSession, sf: str) -> DataFrame:
            ship(spark)
            return f(spark, sf)

        return run

    return {f.__name__: shipped(f) for f in _QUERIES}


def oracle_sql() -> dict[str, str]:
    from corpusloom.plans.oracles import SQL

    return dict(SQL)
