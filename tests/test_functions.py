"""Golden rows for the scalar expressions."""

import random
from urllib.parse import quote

import pytest
from pyspark.sql import functions as F

from corpusloom.functions import chunks, hosts, replies, signals, text, titles


def values(spark, rows, expr, schema="x string"):
    return [r[0] for r in spark.createDataFrame([(r,) if not isinstance(r, tuple) else r for r in rows], schema).select(expr).collect()]


def test_keep_title(spark):
    rows = [None, "", "  ", "Plain", "Kategori:X", " KATEGORI :X", ":Dosya:X", "Star Wars: IV", "Şablon tartışma:X", "KİTAP:X"]
    assert values(spark, rows, titles.keep_title(F.col("x"))) == [False, False, False, True, False, False, True, True, False, True]


def test_article_url_equals_percent_encoding(spark):
    rows = ["a b", "A/B", "C++", "~*'()", "100%", "Çiğ köfte"]
    assert values(spark, rows, titles.article_url(F.col("x"), "u/")) == ["u/" + quote(r.replace(" ", "_")) for r in rows]


def test_names(spark):
    assert values(spark, ["A/B", "AB", "???", "..", ' a "b" '], titles.safe_name(F.col("x"))) == ["AB", "AB", "", "..", "a b"]
    assert values(spark, ["a  b?"], titles.output_name(F.col("x"), F.lit(2))) == ["a_b_depth_2.json"]


def test_hosts(spark):
    urls = ["https://user:p@www.Host.com:8080/a?b#c", "//h/x", "not a url", "http://a b.com/x", "http:///x", None]
    assert values(spark, urls, hosts.url_source(F.col("x"))) == ["user:p@www.Host.com:8080", "h", "", "a b.com", "", None]
    assert values(spark, urls[:4], hosts.url_domain(F.col("x"))) == ["host.com", "h", "", "a b.com"]
    d = ["news.x.edu", "x.gov.tr", "x.ac.uk", "multimedium.edu", "notwikipedia.org", "tr.wikipedia.org", "müze.tr"]
    assert values(spark, d, hosts.is_trusted(F.col("x"))) == [False, True, True, False, False, True, True]


def test_navigation_thresholds(spark):
    nav, prose = "[menu entry](x)", "some prose that is long enough"
    texts = ["advertisements", "cookie", "\n".join([nav] * 7 + [prose] * 13), "\n".join([nav] * 8 + [prose] * 12), "\n".join([nav] * 10 + [prose] * 9), "\n".join(["[a b c d e"] * 20)]
    assert values(spark, texts, signals.has_navigation(F.col("x"))) == [True, False, False, True, False, False]


def windows(n):
    out, start = [], 0
    while start < n:
        end = min(start + 3500, n)
        out.append((start, end - start))
        if end == n:
            break
        start = end - 200
    return out


@pytest.mark.parametrize("n", [0, 1, 3500, 3501, 4000, 4001, 6800, 6801, 10101])
def test_overlap_windows(spark, n):
    got = values(spark, ["a" * n], chunks.overlap_windows(F.col("x")))[0]
    assert [(s["start"], s["len"]) for s in got] == windows(n)


def packed(md):
    """An independent model of section packing."""
    if not md:
        return []
    starts = [k for k, c in enumerate(md) if c == "#" and (k == 0 or md[k - 1] == "\n")]
    if not starts:
        return windows(len(md))
    cuts = ([0] if starts[0] else []) + starts + [len(md)]
    out, at, size = [], 0, 0
    for a, b in zip(cuts, cuts[1:]):
        if b - a > 4000 or (size and size + b - a > 4000):
            out += [(at, size)] if size else []
            size = 0
        if b - a > 4000:
            out += [(a + s, n) for s, n in windows(b - a)]
        else:
            at, size = (a if not size else at), size + b - a
    return out + ([(at, size)] if size else [])


def test_section_chunks_against_model(spark):
    rng = random.Random(1)
    texts = ["", "x" * 3800, "intro\n## a\nb", "#tag\n" + "y" * 5000 + "\n# z"]
    for _ in range(30):
        texts.append("".join(rng.choice(["", "# ", "\n#"]) + "w" * rng.choice([1, 50, 900, 3990, 4100, 9000]) + "\n" for _ in range(rng.randrange(1, 9))))
    got = values(spark, texts, chunks.section_chunks(F.col("x")))
    assert [[(s["start"], s["len"]) for s in g] for g in got] == [packed(t) for t in texts]
    assert values(spark, [None], chunks.section_chunks(F.col("x"))) == [[]]


def test_batch_numbers(spark):
    sizes = [[], [12000], [12001, 5], [5950, 5950, 1], [5950, 5950, 2], [5967, 5967], [5967, 5968]]
    assert values(spark, [(s,) for s in sizes], chunks.batch_numbers(F.col("x")), "x array<int>") == [[], [0], [0, 1], [0, 0, 0], [0, 0, 1], [0, 0], [0, 1]]


def test_parse_batch(spark):
    sep = chunks.SEPARATOR
    part = lambda k, body: f"{sep}\nPART {k}\n\n{body}"
    rows = [
        ("\n\n".join([part(1, "a"), part(2, "b")]), 2),
        ("chat\n" + part(2, "b") + "\n\n" + part(1, "a"), 2),
        (part(1, "a"), 2),
        (part(1, "a") + "\n" + part(1, "b"), 2),
        (part(0, "a"), 1),
        (part(2, "a"), 1),
        (part(1, f" {chunks.EMPTY_MARKER} "), 1),
        (None, 1),
        (part(1, "a") + "\n" + part(99999999999, "b"), 2),
    ]
    got = values(spark, rows, chunks.parse_batch(F.col("x"), F.col("n")), "x string, n int")
    assert got == [["a", "b"], ["a", "b"], None, None, None, None, [""], None, None]


def test_clean_one(spark):
    rows = [("t", None), ("t", ""), ("t", f" {chunks.EMPTY_MARKER}\n"), ("t", "new")]
    assert values(spark, rows, chunks.clean_one(F.col("x"), F.col("r")), "x string, r string") == ["t", "t", "", "new"]


def test_json_variant(spark):
    rows = ['{"a":1}', '```json\n{"a":1}\n```', '```JSON\n{"a":1}\n```', 'so: {"a":1} done', '[1] {"a":1}', '{"a":"\\("}', "", None]
    got = values(spark, rows, F.to_json(replies.json_variant(F.col("x"))))
    assert got == ['{"a":1}', '{"a":1}', '{"a":1}', '{"a":1}', "[1]", None, None, None]
    trailing = ['[1] {"a":"[x]"}', '{"a":1} {"b":2}', "1, 2", '{"a":1}]', "[]", "no [1] here"]
    assert values(spark, trailing, F.to_json(replies.json_variant(F.col("x")))) == [None, None, None, '{"a":1}', "[]", "[1]"]


def test_title_or_heading(spark):
    rows = [(" T ", "# H"), (None, "x\n# H  \ny"), ("", "#\n\nfoo"), (None, "none"), (None, None)]
    assert values(spark, rows, replies.title_or_heading(F.col("x"), F.col("t")), "x string, t string") == ["T", "H", "foo", "", ""]


def test_strip_and_fold(spark):
    assert values(spark, ["   a  "], text.strip(F.col("x"))) == ["a"]
    assert values(spark, ["Straße İ"], text.casefold(F.col("x"))) == ["strasse i̇"]
