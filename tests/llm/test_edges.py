"""Every operator on nulls, empty tables, long texts, ties, repeated rows and clashing columns."""

import pytest
from pyspark.sql import functions as F

from corpusloom.llm import canonical, main_content, markup, mixing, near_duplicates, packing, repeated_lines, residue, splitting, toxicity

DOC = "doc_id long, entity_title string, url string, title string, text string, lang string, source string, source_type string, leaf string, set_key int, n_tokens string, line string"
LONG = "A sentence about the mill and its owners in the valley. " * 4000


def docs(spark, rows):
    full = [(i, None, None, None, t, lang, s, k, "x", 1, "y", "z") for i, t, lang, s, k in rows]
    return spark.createDataFrame(full, DOC)


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(1, None, None, None, None), (2, "", "tr", "s", "Blog "), (3, "\n \n", "und", "s", ""), (None, "words " * 50, "en", None, "blog"), (4, LONG, "en-XX", "s", "blog"), (4, LONG, "en-XX", "s", "blog"), (5, "a\x00b\ufffd\U0001f33f" * 30, "zz", "s", "blog"), (6, "x" * 200_000, None, "s", None)]
    return docs(spark, rows)


SPECS = [(1, 4000, 200), (2, 100, 0)]


def ops(spark):
    specs = lambda rows: spark.createDataFrame(rows, "spec_id int, max_chars int, overlap_chars int")
    packs = spark.createDataFrame([(1, 64, None), (2, 512, "EN")], "pack_id int, capacity_tokens int, lang string")
    mix = spark.createDataFrame([(1, "BLOG", 1.0, 2), (1, "none", 1.0, 1), (2, None, None, None), (2, "blog", -1.0, 1)], "mix_id int, source_type string, target_share double, max_repeats int")
    labels = spark.createDataFrame([(4, " Abusive "), (5, None), (2, "none")], "doc_id long, category string")
    terms = spark.createDataFrame([("rat", "abusive", None), (None, "hateful", 2)], "term string, category string, severity int")
    return {
        "furniture": main_content.page_furniture,
        "articles": main_content.main_content,
        "kinds": markup.markup_kinds,
        "clean": markup.clean_markup,
        "split": lambda d: splitting.split_documents(d, specs(SPECS)),
        "no specs": lambda d: splitting.split_documents(d, specs([])),
        "lines": repeated_lines.repeated_lines,
        "without lines": repeated_lines.without_repeated_lines,
        "pairs": lambda d: near_duplicates.document_pairs(*near_duplicates.near_duplicate_links(d, shingle=3, threshold=0.7)),
        "classes": near_duplicates.near_duplicate_classes,
        "residue": residue.template_residue,
        "without residue": residue.without_residue,
        "pack": lambda d: packing.pack_documents(d, packs),
        "mix": lambda d: mixing.mix_documents(d, mix)[0],
        "shares": lambda d: mixing.mix_documents(d, mix)[1],
        "toxic": lambda d: toxicity.found_categories(toxicity.score_documents(d, toxicity.fit(d, labels, terms))),
        "no labels": lambda d: toxicity.source_rates(toxicity.score_documents(d, toxicity.fit(d, labels.limit(0), terms.limit(0)))),
    }


NAMES = ["furniture", "articles", "kinds", "clean", "split", "no specs", "lines", "without lines", "pairs", "classes", "residue", "without residue", "pack", "mix", "shares", "toxic", "no labels"]


@pytest.mark.parametrize("name", NAMES)
def test_odd_rows(spark, odd, name):
    rows = ops(spark)[name](odd).collect()
    if name == "articles":
        assert len(rows) == odd.count()
    if name in ("furniture", "toxic"):
        assert not rows
    if name == "residue":  # one sentence 4,000 times over is dummy copy, however long
        assert [tuple(r) for r in rows] == [(4, "filler")]
    if name == "without lines":
        assert len(rows) == 8 and {r.n_removed for r in rows} == {0} and all(r.clean_text == r.text for r in rows)
    if name == "shares":
        assert {(r.mix_id, r.source_type): r.tokens > 0 for r in rows} == {(1, "BLOG"): True, (1, "none"): False, (2, None): False, (2, "blog"): False}


@pytest.mark.parametrize("name", NAMES)
def test_empty_table(spark, odd, name):
    rows = ops(spark)[name](odd.limit(0)).collect()
    assert len(rows) == (4 if name == "shares" else 0)


def test_values_on_odd_rows(spark):
    occ = spark.createDataFrame([(1, "type", 0, None), (2, "type", 0, "  "), (3, "type", 0, "Dish"), (4, "type", 0, "dish!"), (4, "type", 0, "dish!"), (5, "type", 0, "?" * 50), (6, "type", 0, "z" * 5000), (7, "nothing", 0, "x")], "decision_id int, field_kind string, item_pos int, value string").where("field_kind = 'type'")
    ref = spark.createDataFrame([(1, "Dish", None), (2, None, ["x"]), (3, "Harbour town", [None, "port"])], "id int, name string, alt_names array<string>")
    got = sorted((r.decision_id, r.ref_id) for r in canonical.map_values(occ, {"type": ref}).collect())
    assert got == [(4, 1), (4, 1), (5, -1), (6, -1)]
    assert canonical.map_values(occ.limit(0), {"type": ref}).count() == 0
    assert [r.ref_id for r in canonical.map_values(occ, {"type": ref.limit(0)}).where("decision_id = 4").collect()] == [-1, -1]
    nulls = spark.createDataFrame([(1, None, None), (2, ("T", None), [None, ("a", 1)])], "decision_id int, entity_type struct<name:string,subtype:string>, information_to_collect array<struct<name:string,priority:int>>")
    assert sorted((r.decision_id, r.field_kind, r.item_pos, r.value) for r in canonical.decision_values(nulls).collect()) == [(2, "information", 1, "a"), (2, "type", 0, "T")]


def test_rejected_parameters(spark, odd):
    with pytest.raises(ValueError):
        splitting.split_documents(odd, spark.createDataFrame([(1, 10, 10)], "spec_id int, max_chars int, overlap_chars int"))
    with pytest.raises(ValueError):
        packing.pack_documents(odd, spark.createDataFrame([(1, 0, None)], "pack_id int, capacity_tokens int, lang string"))


def test_nothing_else_imports_this_package():
    from pathlib import Path

    root = Path(main_content.__file__).resolve().parent.parent
    for p in root.rglob("*.py"):
        if p.parent.name != "llm":
            assert "corpusloom.llm" not in p.read_text(encoding="utf-8"), p
    assert F is not None
