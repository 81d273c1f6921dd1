"""The composed pipeline on replay tables, and the stream."""

import datetime

from pyspark.sql import functions as F

from corpusloom.functions import chunks
from corpusloom.plans import pipeline
from corpusloom.streaming import ingest


def test_pipeline_end_to_end(spark):
    df = spark.createDataFrame
    long = "\n".join(f"# S{k}\n" + "w" * 3000 for k in range(6))
    result = lambda u: (u, None, 0.5, None)
    t = pipeline.Tables(
        seeds=df([("root", 1, 10)], "title string, max_depth int, entity_limit int"),
        links=df([("root", 0, "a"), ("root", 1, "b"), ("root", 2, "done"), ("root", 3, "Kategori:x")], "src string, ord long, dst string"),
        pages=df([("a", "about a", ["k"])], "title string, summary string, categories array<string>"),
        decisions=df([("b", '{"include": false, "expand": false, "entity_type": {"name": "T"}, "information_to_collect": [], "reason": "r"}'), ("a", "broken")], "title string, reply string"),
        ids=df([(1, "root"), (2, "a"), (3, "b"), (4, "done")], "entity_id int, title string"),
        plans=df([(1, 2, [("i", "q", [result("http://x.edu/1"), result("http://blog.y/2"), result("http://z/3")]), ("j", "q", [result("http://z/4"), result("http://z/5")])]), (2, 3, [("i", "q", [result("http://z/4")])])],
                 "plan_id int, entity_id int, tasks array<struct<information:string,query:string,results:array<struct<url:string,title:string,score:double,reason:string>>>>"),
        extractions=df([("http://x.edu/1", 0, None, "# Clean\nprose"), ("http://blog.y/2", 0, "T", "short"), ("http://blog.y/2", 1, "T2", "longer text"), ("http://z/4", 0, "t", long), ("http://z/5", 0, "t", " ")],
                       "url string, pos int, title string, text string"),
        cleaned=df([("http://blog.y/2", 0, "cleaned text"), ("http://z/4", 0, "no parts")], "url string, batch_no int, reply string"),
        stored=df([("done",)], "entity_title string"),
    )
    docs, kept, rejected = pipeline.run(t)
    assert sorted(r.title for r in kept.collect()) == ["a", "root"] and [r.title for r in rejected.collect()] == ["b"]
    got = {r.url: r for r in docs.collect()}
    assert set(got) == {"http://x.edu/1", "http://blog.y/2", "http://z/4"}
    assert got["http://x.edu/1"].title == "Clean" and got["http://x.edu/1"].route == "pass"
    assert got["http://blog.y/2"].text == "cleaned text"
    assert got["http://z/4"].text.replace("\n\n", "") == long.replace("\n\n", "") and got["http://z/4"].route == "batch"


def _raw(spark, rows):
    at = datetime.datetime(2024, 1, 1)
    return spark.createDataFrame([(k, e, f"http://{h}/x", "t", text, at + datetime.timedelta(hours=k)) for k, e, text, h in rows], ingest.SCHEMA)


def test_stream_upserts(spark, tmp_path):
    src, out, ck = (str(tmp_path / x) for x in ("in", "out", "ck"))
    # "A/B" and "AB" have one safe name and replace each other
    for rows in ([(1, "A/B", "old", "a"), (2, "e", "b", "b")], [(3, "AB", "new", "a"), (4, "e", None, "c")]):
        _raw(spark, rows).write.mode("append").parquet(src)
        ingest.upsert_stream(ingest.raw_documents(spark, src), out, ck, buckets=16).awaitTermination()
    assert sorted((r.source_key, r.text) for r in ingest.stored(spark, out).collect()) == [("a", "new"), ("b", "b")]
    q = ingest.arrivals(ingest.raw_documents(spark, src)).writeStream.format("memory").queryName("arrivals").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.table("arrivals").agg(F.sum("n_documents")).first()[0] == 4


def test_store_survives_a_crash(spark, tmp_path, monkeypatch):
    import pytest

    out = str(tmp_path / "out")
    rows = lambda: sorted((r.entity_key, r.text) for r in ingest.stored(spark, out).collect())
    ingest.upsert_batch(_raw(spark, [(1, "a", "one", "h"), (2, "b", "two", "h")]), 0, out, 8)
    second = _raw(spark, [(3, "a", "three", "h")])
    with monkeypatch.context() as m:
        m.setattr(ingest.Store, "commit", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            ingest.upsert_batch(second, 1, out, 8)
    assert rows() == [("a", "one"), ("b", "two")]
    for _ in range(2):
        ingest.upsert_batch(second, 1, out, 8)
        assert rows() == [("a", "three"), ("b", "two")]
    for k in range(2, 7):
        ingest.upsert_batch(_raw(spark, [(10 + k, "b", f"v{k}", "h")]), k, out, 8)
    assert rows() == [("a", "three"), ("b", "v6")] and len(ingest.Store(spark, out).versions()) == 3


def test_constants():
    assert chunks.PART_COST == 33 and len(chunks.SEPARATOR) == 20
