"""The pN_ queries with their production parameters, and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm import canonical, main_content, markup, mixing, near_duplicates, packing, repeated_lines, residue, splitting, toxicity
from corpusloom.session import documents, ship, table


def p1_found(spark: SparkSession, sf: str) -> DataFrame:
    return main_content.page_furniture(documents(spark, sf))


def p1_articles(spark: SparkSession, sf: str) -> DataFrame:
    return main_content.main_content(documents(spark, sf))


def _mapped_values(spark: SparkSession, sf: str) -> DataFrame:
    subtypes = table(spark, sf, "entity_subtypes").select("subtype_id", "name", F.lit(None).cast("array<string>").alias("alt_names"))
    lists = {
        "type": table(spark, sf, "entity_types").select("type_id", "name", "alt_names"),
        "subtype": subtypes,
        "information": table(spark, sf, "information_types").select("info_id", "name", "alt_names"),
    }
    return canonical.map_values(canonical.decision_values(table(spark, sf, "decisions")), lists)


def p2_found(spark: SparkSession, sf: str) -> DataFrame:
    return _mapped_values(spark, sf).select("decision_id", "field_kind", "item_pos", "ref_id")


def p2_unmatched(spark: SparkSession, sf: str) -> DataFrame:
    return _mapped_values(spark, sf).where("ref_id = -1").groupBy("field_kind", "value").agg(F.count("*").alias("n"))


def p3_found(spark: SparkSession, sf: str) -> DataFrame:
    return markup.markup_kinds(documents(spark, sf))


def p3_cleaned(spark: SparkSession, sf: str) -> DataFrame:
    return markup.clean_markup(documents(spark, sf))


def p4_found(spark: SparkSession, sf: str) -> DataFrame:
    pieces = splitting.split_documents(documents(spark, sf), table(spark, sf, "split_specs"), with_text=False)
    return pieces.where("piece_no = 0").select("doc_id", "spec_id", "cut_kind")


def p4_pieces(spark: SparkSession, sf: str) -> DataFrame:
    return splitting.split_documents(documents(spark, sf), table(spark, sf, "split_specs"))


def p5_found(spark: SparkSession, sf: str) -> DataFrame:
    return repeated_lines.repeated_lines(documents(spark, sf)).select("doc_id", "line_no")


def p5_cleaned(spark: SparkSession, sf: str) -> DataFrame:
    return repeated_lines.without_repeated_lines(documents(spark, sf)).select("doc_id", "source", "clean_text", "n_removed")


def p6_found(spark: SparkSession, sf: str) -> DataFrame:
    links, members = near_duplicates.near_duplicate_links(documents(spark, sf), shingle=3, threshold=0.7, min_words=40)
    return near_duplicates.document_pairs(links, members)


def p6_classes(spark: SparkSession, sf: str) -> DataFrame:
    return near_duplicates.near_duplicate_classes(documents(spark, sf), shingle=3, threshold=0.7, min_words=40)


def p7_found(spark: SparkSession, sf: str) -> DataFrame:
    return residue.template_residue(documents(spark, sf))


def p7_kept(spark: SparkSession, sf: str) -> DataFrame:
    return residue.without_residue(documents(spark, sf)).select("doc_id", "url", "title", "text")


def p8_containers(spark: SparkSession, sf: str) -> DataFrame:
    return packing.pack_documents(documents(spark, sf), table(spark, sf, "pack_specs"))


def p8_fill(spark: SparkSession, sf: str) -> DataFrame:
    return packing.fill_report(p8_containers(spark, sf), table(spark, sf, "pack_specs"))


def p8_placed(spark: SparkSession, sf: str) -> DataFrame:
    """Which documents every pack has placed."""
    return p8_containers(spark, sf).select("pack_id", "doc_id").distinct()


def p9_mix(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.mix_documents(documents(spark, sf), table(spark, sf, "mix_targets"))[0]


def p9_shares(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.mix_documents(documents(spark, sf), table(spark, sf, "mix_targets"))[1]


def p9_targets(spark: SparkSession, sf: str) -> DataFrame:
    """The targets that can be met, scaled to add to 1, and whether a budget or a cap on repeats was exceeded."""
    shares = p9_shares(spark, sf).join(table(spark, sf, "mix_targets").select("mix_id", "source_type", "max_repeats"), ["mix_id", "source_type"])
    exceeded = (F.col("tokens") > F.col("budget")) | (F.col("most_copies") > F.greatest(F.col("max_repeats"), F.lit(0)))
    return shares.select("mix_id", "source_type", F.round("target_share", 6).alias("target_share"), exceeded.alias("exceeded"))


def _toxicity(spark: SparkSession, sf: str, exact: bool = True) -> DataFrame:
    docs = documents(spark, sf)
    model = toxicity.fit(docs, table(spark, sf, "review_labels"), table(spark, sf, "flag_terms"))
    return toxicity.score_documents(docs, model, exact)


def p10_found(spark: SparkSession, sf: str) -> DataFrame:
    return toxicity.found_categories(_toxicity(spark, sf, exact=False))


def p10_scores(spark: SparkSession, sf: str) -> DataFrame:
    return _toxicity(spark, sf)


def p10_sources(spark: SparkSession, sf: str) -> DataFrame:
    return toxicity.source_rates(_toxicity(spark, sf))


_QUERIES = (p1_found, p1_articles, p2_found, p2_unmatched, p3_found, p3_cleaned, p4_found, p4_pieces, p5_found, p5_cleaned, p6_found, p6_classes, p7_found, p7_kept, p8_containers, p8_fill, p8_placed, p9_mix, p9_shares, p9_targets, p10_found, p10_scores, p10_sources)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def shipped(f):
        def run(spark: SparkSession, sf: str) -> DataFrame:
            ship(spark)
            return f(spark, sf)

        return run

    return {f.__name__: shipped(f) for f in _QUERIES}


def oracle_sql() -> dict[str, str]:
    return {
        "p4_found": """
            SELECT d.doc_id, s.spec_id,
                   CASE WHEN list_max(list_transform(regexp_split_to_array(d.text, '[ \\t\\r\\n]+'), lambda x: length(x))) > s.max_chars
                        THEN 'hard' ELSE 'soft' END AS cut_kind
            FROM documents d JOIN split_specs s ON length(d.text) > s.max_chars""",
        "p5_found": """
            WITH l AS (
              SELECT doc_id, source, unnest(range(len(x)))::INTEGER AS line_no, unnest(x) AS raw
              FROM (SELECT doc_id, source, string_split(text, chr(10)) AS x FROM documents)),
            n AS (
              SELECT doc_id, source, line_no,
                     regexp_replace(lower(trim(regexp_replace(raw, '[\\s\\x{00A0}]+', ' ', 'g'), ' ')), '[0-9]+', '0', 'g') AS line FROM l),
            c AS (SELECT source, line, count(DISTINCT doc_id) AS n_docs FROM n WHERE length(line) >= 25 GROUP BY ALL),
            t AS (SELECT source, count(*) AS n_source FROM documents GROUP BY source)
            SELECT n.doc_id, n.line_no FROM n JOIN c USING (source, line) JOIN t USING (source)
            WHERE c.n_docs >= 4 AND c.n_docs * 10 >= t.n_source""",
        "p6_found": """
            WITH w AS (SELECT doc_id, list_transform(regexp_extract_all(text, '[\\p{L}\\p{N}]+'), lambda x: lower(x)) AS ws FROM documents WHERE text IS NOT NULL),
            s AS (SELECT doc_id, list_distinct(list_transform(range(1, len(ws) - 1), lambda k: ws[k] || ' ' || ws[k + 1] || ' ' || ws[k + 2])) AS sh FROM w WHERE len(ws) >= 40),
            e AS (SELECT doc_id, len(sh) AS n, unnest(sh) AS g FROM s),
            j AS (SELECT a.doc_id AS doc_id_a, b.doc_id AS doc_id_b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS c FROM e a JOIN e b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id)
            SELECT doc_id_a, doc_id_b FROM j WHERE c >= 0.7 * (na + nb - c)""",
        "p8_placed": """
            SELECT pack_id, doc_id FROM pack_specs p JOIN documents d ON d.text <> '' AND (p.lang IS NULL OR lower(p.lang) = lower(regexp_extract(trim(d.lang), '^([A-Za-z]{2,3})(?:[-_].*)?$', 1)))""",
        "p9_targets": """
            WITH k AS (SELECT DISTINCT lower(trim(source_type)) AS k FROM documents WHERE text <> ''),
            t AS (SELECT mix_id, source_type, CASE WHEN target_share > 0 AND max_repeats > 0 AND lower(trim(source_type)) IN (SELECT k FROM k WHERE k IS NOT NULL) THEN target_share ELSE 0 END AS s FROM mix_targets)
            SELECT mix_id, source_type, round(CASE WHEN s > 0 THEN s / sum(s) OVER (PARTITION BY mix_id) ELSE 0 END, 6) AS target_share, false AS exceeded FROM t""",
    }
