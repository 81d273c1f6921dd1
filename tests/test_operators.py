"""Core operators against independent models and on edge rows."""

import random
from collections import deque

import duckdb
import pytest
from pyspark.sql import functions as F

from corpusloom.operators import enrich, frontier, planning, ranking, routing, searching, storing
from corpusloom.sources import providers


def fifo(title, depth, limit, links):
    out, queue, known, children = [], deque([(title, 0, None)]), {title}, {}
    while queue:
        t, d, p = queue.popleft()
        out.append((t, d, p))
        if len(out) >= limit:
            break
        if d < depth:
            for x in links.get(t, []):
                if x and x not in known:
                    known.add(x)
                    children.setdefault(t, []).append(x)
                    queue.append((x, d + 1, t))
    return out, children


@pytest.mark.parametrize("seed", range(3))
def test_expand_equals_queue(spark, seed):
    rng = random.Random(seed)
    nodes = [f"n{k}" for k in range(25)]
    rows, links = [], {}
    for a in nodes:
        targets = rng.sample(nodes, rng.randrange(0, 6))
        links[a] = targets
        rows += [(a, k, b) for k, b in enumerate(targets)] * rng.choice([1, 2])
    rows += [("n0", 90, None), ("n0", 91, "Kategori:x"), (None, 1, "n3"), ("n0", 92, "n0")]
    links["n0"] = [*links["n0"], "n0"]
    rng.shuffle(rows)
    seeds = [("n0", 3, 9), ("n1", 2, 100), ("n2", 0, 5), ("n3", 4, 1), ("n4", 2, 0), ("absent", 2, 5)]
    found, claims = frontier.expand(spark.createDataFrame(seeds, "title string, max_depth int, entity_limit int"), spark.createDataFrame(rows, "src string, ord long, dst string"))
    got, kids = found.collect(), claims.collect()
    for t, d, most in seeds:
        want, children = fifo(t, d, most, links)
        mine = sorted((r for r in got if r.seed == t), key=lambda r: r["rank"])
        assert [(r.title, r.depth, r.parent) for r in mine] == want
        assert [r["rank"] for r in mine] == list(range(1, len(want) + 1))
        own = {}
        for r in sorted((r for r in kids if r.seed == t), key=lambda r: (r.parent, r.pos)):
            own.setdefault(r.parent, []).append(r.child)
        assert own == children


def test_empty_links(spark):
    found, claims = frontier.expand(spark.createDataFrame([("a", 2, 5)], "title string, max_depth int, entity_limit int"), spark.createDataFrame([], "src string, ord long, dst string"))
    assert [r.title for r in found.collect()] == ["a"] and claims.count() == 0


def test_enrich_keeps_misses(spark):
    e = spark.createDataFrame([("a", 1), ("b", 2)], "title string, summary int")
    p = spark.createDataFrame([("a", None, None), ("a", "s", ["k"]), (None, "x", None)], "title string, summary string, categories array<string>")
    assert sorted(map(tuple, enrich.enrich(e, p).select("title", "summary", "categories").collect())) == [("a", "s", ["k"]), ("b", "", [])]


def test_fixed_batches(spark):
    got = ranking.fixed_batches(spark.range(103).select(F.format_string("%04d", "id").alias("k")), ["k"], 50).orderBy("k").collect()
    assert [(r.batch_no, r.batch_pos) for r in got] == [(k // 50, k % 50) for k in range(103)]


DEC = "decision_id int, entity_id int, include boolean, expand boolean, entity_type struct<name:string,subtype:string>, information_to_collect array<struct<name:string,priority:int>>, reason string"


def test_decisions(spark):
    rows = [
        (1, 1, True, True, ("T", None), [("a", 1), ("b", 5)], "r"),
        (2, 2, False, True, ("T", None), [("a", 0)], "r"),
        (3, 3, False, None, ("T", None), [], "r"),
        (4, 4, False, True, ("T", "s"), None, "r"),
        (5, 5, False, True, None, [], "r"),
        (6, 6, False, True, ("T", None), [("a", 6)], "r"),
        (7, 7, False, True, ("T", None), [("a", None)], "r"),
    ]
    d = planning.with_fallback(spark.createDataFrame(rows, DEC)).cache()
    assert {r.decision_id: r.valid for r in d.collect()} == {1: True, 2: False, 3: False, 4: True, 5: False, 6: False, 7: False}
    kept, rejected = planning.split(d)
    assert kept.count() + rejected.count() == 7 and [r.decision_id for r in rejected.collect()] == [4]
    assert tuple(planning.counters(d).first()) == (7, 6, 1, 5)


def test_parse_decision(spark):
    rows = [('{"include": "true", "expand": false, "entity_type": {"name": "T"}, "information_to_collect": [{"name": "a", "priority": "5"}], "reason": "r"}',), ("[1]",), ("no",)]
    got = spark.createDataFrame(rows, "x string").select(planning.parse_decision(F.col("x")).alias("d")).collect()
    assert got[0].d.include is True and got[0].d.information_to_collect[0].priority == 5 and got[1].d is None and got[2].d is None


def test_search_and_store(spark):
    schema = "plan_id int, entity_id int, tasks array<struct<information:string,query:string,results:array<struct<url:string,title:string,score:double,reason:string>>>>"
    r = [("http://h/a", "t", 0.0008, None), ("http://h/b", None, None, None), ("http://g/c", "t", 1.0, None)]
    plans = spark.createDataFrame([(1, 1, [("i", "q", r), ("j", "q2", [])])] * 2 + [(2, 2, None)], schema)
    top = searching.top_results(plans).orderBy("result_no").collect()
    assert [(x.url, x.reason) for x in top] == [("http://h/a", "Search score: 0.0008"), ("http://h/b", "Search score: N/A")]
    docs = spark.createDataFrame([("A/B", "h", 1, "old"), ("AB", "h", 2, "new"), ("AB", "g", 1, "x")], "e string, s string, no int, text string")
    assert sorted((x.entity_key, x.source_key, x.text) for x in storing.last_per_source(docs, "e", "s", ["no"]).collect()) == [("AB", "g", "x"), ("AB", "h", "new")]
    left = storing.not_stored(spark.createDataFrame([("A/B",), ("C",)], "title string"), docs.withColumnRenamed("e", "entity_title"))
    assert [x.title for x in left.collect()] == ["C"]


def test_incremental_write(spark, tmp_path):
    path = str(tmp_path / "docs")
    df = spark.createDataFrame([("a", "x"), ("b", "y")], "k string, v string")
    storing.write_partitioned(df, path, ["k"])
    storing.write_partitioned(spark.createDataFrame([("a", "z")], "k string, v string"), path, ["k"])
    assert sorted((r.k, r.v) for r in spark.read.parquet(path).collect()) == [("a", "z"), ("b", "y")]


def test_best_extraction(spark):
    rows = [("u", 2, "aa"), ("u", 1, "bb"), ("u", 3, None), ("w", 1, None)]
    got = routing.best_extraction(spark.createDataFrame(rows, "k string, o int, text string"), "k", "o").collect()
    assert sorted((r.k, r.o) for r in got) == [("u", 1), ("w", 1)]


def test_providers(spark, tmp_path):
    calls, naps = [], []

    def flaky(x):
        calls.append(x)
        if len(calls) < 3:
            raise OSError("busy")
        return " ok "

    assert providers.attempt(flaky, "p", sleep=naps.append) == ("ok", None) and naps == [1.0, 2.0]
    assert providers.attempt(lambda x: "", "p", sleep=naps.append) == (None, "empty reply")
    asked = spark.createDataFrame([("a",), ("b",), ("a",)], "prompt string")
    none = spark.createDataFrame([], "prompt_key string, reply string, error string")
    live = providers.ask_live(providers.unanswered(asked, none), lambda: lambda p: p.upper(), 2)
    assert sorted(r.reply for r in live.collect()) == ["A", "B"]
    assert sorted(r.reply for r in providers.replay(asked, live).collect()) == ["A", "A", "B"]
    assert providers.unanswered(asked, live).count() == 0
    pages = {"": {"pages": {"1": {"links": [{"title": "a"}]}}, "continue": {"c": 1}}, "1": {"pages": {"1": {}}}}
    assert providers.fetch_pages(lambda t, c: pages[str(c.get("c", ""))], "x") == ["a"]
    path = str(tmp_path / "r.json")
    providers.save_registry(spark.createDataFrame([("n", "d")], providers.REGISTRY), path)
    assert [tuple(r) for r in providers.load_registry(spark, path).collect()] == [("n", "d")]


def test_queries_match_sql(spark, sf):
    """Every q_ query against its SQL on the smallest tables."""
    import glob
    import os

    from corpusloom.plans import queries as plans

    con = duckdb.connect()
    for p in glob.glob(f"{sf}/*.parquet"):
        con.sql(f"create view {os.path.basename(p)[:-8]} as select * from read_parquet('{p}')")
    sql = plans.oracle_sql()
    assert set(sql) == set(plans.queries())
    for name in ("q_bfs_children", "q_enrich", "q_nav_artifacts", "q_batch_parse", "q_route", "q_json_extract", "q_plan_fallback", "q_doc_upsert", "q_prompt_fields"):
        df = plans.queries()[name](spark, sf)
        cols = sorted(df.columns)
        mine = sorted(repr(tuple(str(v) for v in r)) for r in df.select(*cols).collect())
        theirs = sorted(repr(tuple(str(v) for v in r)) for r in con.sql(f"SELECT {', '.join(chr(34) + c + chr(34) for c in cols)} FROM ({sql[name]})").fetchall())
        assert mine == theirs, name


def test_expansion_stops_at_an_empty_level(spark):
    seeds = spark.createDataFrame([("a", 30, 10)], "title string, max_depth int, entity_limit int")
    links = spark.createDataFrame([("a", 0, "b")], "src string, ord long, dst string")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("deep", "deep")
    found, _ = frontier.expand(seeds, links)
    assert found.count() == 2
    jobs = len(tracker.getJobIdsForGroup("deep"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs < 40  # two levels, whatever the depth allowed


def test_bad_seeds_stop_no_others(spark):
    seeds = spark.createDataFrame([("a", 1, 10), (None, 1, 5), ("b", None, 5), ("c", 1, -1)], "title string, max_depth int, entity_limit int")
    good, bad = frontier.usable_seeds(seeds)
    assert [r.title for r in good.collect()] == ["a"] and sorted(r.error for r in bad.collect()) == ["no depth", "no limit", "no title"]


def test_live_services(spark):
    def wiki():
        pages = {("a", ""): {"pages": {"1": {"links": [{"title": "x"}, {"title": "y"}]}}, "continue": {"c": "2"}}, ("a", "2"): {"pages": {"1": {"links": [{"title": "z"}]}}}}

        def continued(title, token):
            if title == "broken":
                raise OSError("down")
            return pages.get((title, str(token.get("c", ""))), {"pages": {}})

        return continued

    titles = spark.createDataFrame([("a",), ("a",), ("broken",), ("none",), (None,)], "title string")
    got = sorted((r.src, r.ord, r.dst, r.error) for r in providers.outlinks(titles, wiki, 2, gap=0, tries=2, pause=lambda k: 0.0).where("dst is not null").collect())
    assert got == [("a", 0, "x", None), ("a", 1, "y", None), ("a", 2, "z", None)]
    errors = providers.outlinks(titles, wiki, 2, gap=0, tries=2, pause=lambda k: 0.0).where("error is not null").collect()
    assert [(r.src, r.error) for r in errors] == [("broken", "OSError: down")]

    many = spark.createDataFrame([(f"t{k}",) for k in range(7)], "title string")
    infos = providers.page_infos(many, lambda: lambda ts: [{"title": t, "summary": str(len(ts)), "categories": ["k"]} for t in ts], 2, size=3, gap=0).collect()
    assert sorted((r.title, r.summary) for r in infos) == [(f"t{k}", "3" if k < 6 else "1") for k in range(7)]

    def search():
        return lambda q: (_ for _ in ()).throw(ValueError("no")) if q == "bad" else [{"url": f"http://{q}", "title": q, "score": 0.5}]

    found = {r.query: r for r in providers.searches(spark.createDataFrame([("q",), ("bad",)], "query string"), search, 1, tries=1).collect()}
    assert found["q"].results[0].url == "http://q" and found["bad"].results == [] and "no" in found["bad"].error
    texts = providers.extractions(spark.createDataFrame([("u",), ("v",)], "url string"), lambda: lambda u: [{"title": u, "text": "1"}, {"title": None, "text": "22"}] if u == "u" else "no list", 1, tries=1)
    assert sorted((r.url, r.pos, r.text, r.error) for r in texts.collect() if r.url == "u") == [("u", 0, "1", None), ("u", 1, "22", None)]
    assert [r.error for r in texts.collect() if r.url == "v"] == ["unreadable answer"]
    providers.PROVIDERS["echo"] = lambda: lambda p: p
    assert providers.provider("echo")()("x") == "x"
    with pytest.raises(ValueError, match="echo"):
        providers.provider("nobody")


def test_registry_beyond_its_bound_is_no_silent_loss(spark, tmp_path):
    rows = spark.createDataFrame([(str(k), None) for k in range(5)], providers.REGISTRY)
    with pytest.raises(ValueError):
        providers.save_registry(rows, str(tmp_path / "r.json"), most=4)


def test_discovered_entities_are_stored_per_title_and_depth(spark, tmp_path):
    path = str(tmp_path / "found")
    df = lambda s: spark.createDataFrame([("A/B", 1, s), ("C", 2, s)], "title string, depth int, summary string")
    storing.write_discovered(df("old"), path)
    storing.write_discovered(df("new").where("title = 'C'"), path)
    assert sorted((r.title, r.summary) for r in spark.read.parquet(path).collect()) == [("A/B", "old"), ("C", "new")]
