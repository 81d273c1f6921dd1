"""Main content, markup, residue and repeated lines on small pages and against brute force."""

import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from corpusloom.llm import main_content, markup, repeated_lines, residue, slots

ARTICLE = """Old bridge

The bridge was built in 1612 by the guild of masons and rests on four arches of pale stone.
It carries the road from the market to the mills, and was widened twice after the floods.

- three arches
- one toll house with a slate roof

Visitors walk across it in spring, when the river is high and the mills are busy all day.
The toll was given up in 1874, and the keeper's house became a school for the valley."""
TOP = "Departments\nOur story\nJournal\n\n"
BOTTOM = "\n\nGo to our newsroom\n\nAll texts belong to Example Ltd."


def page(text, *titles, source="www.atlas.example", model=None, again=()):
    """Numbers of the furniture lines of one page."""
    lines = main_content.Lines(main_content._Cells())
    lines.add(text, source, titles)
    b = main_content.Batch(np.array(lines.n), *(np.array(x) for x in (lines.no, lines.chars, lines.tags, lines.flags)), np.isin(lines.no, list(again)), np.array(lines.n_pairs), lines.pairs())
    return b.no[main_content.is_furniture(b, model or main_content.Evidence(), 0.35)].tolist()


def test_density_alone_finds_furniture_of_unseen_wording():
    text = TOP + ARTICLE + BOTTOM
    lines = text.split("\n")
    assert [lines[k] for k in page(text, "Old bridge")] == ["Departments", "Our story", "Journal", "Go to our newsroom", "All texts belong to Example Ltd."]


def test_without_density_rows_change(monkeypatch):
    text = TOP + ARTICLE + BOTTOM
    monkeypatch.setattr(main_content, "density", lambda c, *rest: np.zeros(len(c)))
    assert page(text, "Old bridge") != [0, 1, 2, 15, 17]


def test_long_lines_and_long_lists_are_judged():
    notice = "Atlas keeps small files so that the pages which you have seen are known when you come again. " * 8
    text = f"{notice}\n\n{ARTICLE}\n\n" + "\n".join(f"Page {'abcdefghijklmnopqrst'[k]}" for k in range(20))
    n = len(text.split("\n"))
    assert page(text, "Old bridge", again=[0]) == [0, *range(n - 20, n)]


def test_anchors_and_navigation_elements():
    text = f'[Home](/home) [Map](/map)\n<nav>Our places</nav>\n<a href="/x">Go on</a>\n{ARTICLE}'
    assert page(text, "Old bridge") == [0, 1, 2]


@pytest.mark.parametrize("text", ["One line about cookies of molasses and leeks.", "a < 0 and b > 0 are the cases of this page, which has no more than one long line of text."])
def test_no_furniture(text):
    assert page(text) == []


def test_evidence_is_learnt_from_the_corpus(spark):
    rng = np.random.default_rng(5)
    words = ["".join(chr(97 + x) for x in rng.integers(0, 26, 5)) for _ in range(300)]
    prose = lambda: (" ".join(rng.choice(words, 16)) + ".").capitalize()
    rights = "Todos los derechos de {} quedan reservados para siempre y en todas partes, desde {}"
    rows = []
    for k in range(24):
        host = f"site{'uvwx'[k % 4]}"
        rows.append((k, f"www.{host}.example", f"u{k}", "\n\n".join(["Zur Kasse", *(prose() for _ in range(4)), rights.format(host, 2000 + k)]), None, None))
    # the same wording inside the text, where the place of the line says nothing
    rows.append((99, "www.sitex.example", "u", "\n\n".join([prose(), prose(), rights.format("sitex", 1990), prose(), prose()]), None, None))
    df = spark.createDataFrame(rows, "doc_id long, source string, url string, text string, title string, entity_title string")
    got = sorted((r.doc_id, r.line_no) for r in main_content.furniture_lines(df).collect())
    assert got == [*[(k, n) for k in range(24) for n in (0, 10)], (99, 4)]
    articles = {r.doc_id: r.article for r in main_content.main_content(df).collect()}
    assert articles[0] == "\n\n".join(rows[0][3].split("\n\n")[1:-1]) and len(articles) == 25


def test_density_is_zero_for_links_only():
    d = lambda *x: float(main_content.density(*(np.array([float(v)]) for v in x))[0])
    assert d(10, 1, 10, 1, 100, 10) == 0 and d(100, 1, 0, 0, 100, 10) > d(100, 5, 0, 4, 100, 10)


@pytest.mark.parametrize(
    "text, kinds",
    [
        ("plain * text with 3 * 4 < 13, [sic] and $ 5 or # 7", []),
        ("a <b>bold</b> word", ["html"]),
        ("lone </div>", ["html"]),
        ("x <!-- c --> y", ["html"]),
        ("fish &amp; chips", ["html"]),
        ("AT&T; and <your name here>", []),
        ("# Heading", ["markdown"]),
        ("Title\n-----\ntext", ["markdown"]),
        ("some **bold** words", ["markdown"]),
        ("some `code` here", ["markdown"]),
        ("see [a](http://x) now", ["markdown"]),
        ("note[^1] here", ["markdown"]),
        ("> quoted", ["markdown"]),
        ("| a | b |\n|---|---|\n", ["markdown"]),
        ("```\n<b>[[x]]</b> \\emph{a}\n```", ["markdown"]),
        ("a [[link|text]] here", ["wiki"]),
        ("a {{cite web|url=x}} here", ["wiki"]),
        ("{{ page.title }} and {{summary}}", []),
        ("''quoted'' by marks", ["wiki"]),
        ("== Head ==", ["wiki"]),
        ("{| class=x\n|-\n|}", ["wiki"]),
        ("[https://x.example text]", ["wiki"]),
        ("\\section{A} and \\emph{b}", ["latex"]),
        ("so $a_1$ holds", ["latex"]),
        ("\\(a^2\\)", ["latex"]),
        ("from $ 5 to $ 6 a sack", []),
        ("- bare bullet\n1) item", []),
        ("__SUMMARY__", []),
    ],
)
def test_kinds(text, kinds):
    assert markup.kinds(text) == kinds


def test_clean_keeps_structure():
    html = "<h2>Trade</h2><ul><li>salt</li><li>fish &amp; oil</li></ul><script>x</script><pre>a  b</pre>"
    assert [x for x in markup.clean(html).split("\n") if x.strip()] == ["## Trade", "- salt", "- fish & oil", "```", "a  b", "```"]
    assert markup.clean("== A ==\n'''b''' [[c|d]] {{dn}}") == "## A\nb d "
    assert markup.clean("\\section{A}\n\\begin{itemize}\n\\item x\\footnote{y}\n\\end{itemize}\nso $a_1$ \\textbf{b}") == "# A\n- x\nso $a_1$ b"
    assert markup.clean("**a** [b](c)\n```\n**kept**\n```") == "a b\n```\n**kept**\n```"
    assert markup.clean("plain, as it is") == "plain, as it is"


@pytest.mark.parametrize("text, kind", [("a [[" + "link " * 80 + "]] b", "wiki"), ("$$" + "a+b+" * 300 + "c$$", "latex"), ("so **" + "bold words " * 60 + "end** here", "markdown"), ("[" + "label " * 90 + "](http://x/" + "y" * 600 + ")", "markdown"), ("{{cite " + "x=y|" * 400 + "}}", "wiki"), ("''" + "quoted words " * 60 + "end''", "wiki"), ("\\(" + "a+b+" * 300 + "c\\)", "latex")])
def test_spans_of_any_length(text, kind):
    assert markup.kinds(text) == [kind]


def test_hidden_text_that_never_ends():
    assert "the text goes on" in markup.clean("before <script>the text goes on and <b>on</b>")
    assert "after" in markup.clean("a <script/> after <b>it</b>") and "x=1" not in markup.clean("a <script>x=1</script> b")


def test_clean_text_leaves_out_mark_lines_outside_the_content(monkeypatch):
    prose = "A long line of prose that goes on for a while and says something about the mills."
    page = "\n".join([*(f"- [Page {k}](/p/{k})" for k in range(6)), "# Mills", prose, f"{prose} [Mill](/m)", "- rye", prose])
    assert markup.clean(page) == "\n".join(["# Mills", prose, f"{prose} Mill", "- rye", prose])
    # without the smoothing a link within the text goes, or those around it stay
    monkeypatch.setattr(markup, "_smooth", lambda ratio, sigma: ratio)
    mixed = "\n".join([prose, "See [Mill](/m)", prose, prose])
    alone = markup.clean(mixed)
    monkeypatch.undo()
    assert alone != markup.clean(mixed) == mixed.replace("[Mill](/m)", "Mill")


def test_content_regions():
    page = "\n".join(["<a>x</a><a>y</a>"] * 4 + ["A long line of prose that goes on for a while and says something."] * 4 + ["<a>x</a>"] * 4)
    assert markup.content_regions(page, sigma=0.5)[4:8] == [True] * 4 and not any(markup.content_regions(page, sigma=0.5)[:3])


@pytest.mark.parametrize(
    "text, kinds",
    [
        ("a&#9;b", ["html"]),
        ("a &#00000038; b", ["html"]),
        ("a &# b &# <b>c</b>", ["html"]),
        ("a <y &amp; b <c", ["html"]),
        ("a </y &amp;> b", ["html"]),
        ("AT&T; R&D, &copy and a &# b", []),
        ("\\" + "long" * 8 + "{a}", ["latex"]),
    ],
)
def test_entities_and_commands_of_any_length(text, kinds):
    assert markup.kinds(text) == kinds


def test_html_over_several_lines_is_no_text():
    prose = "A long line of prose that goes on for a while and says something about the mills."
    for hidden in ("<!--\nwords of a remark that nobody should see\n-->", "<script>\nvar words = 'of a script that nobody should see';\n</script>"):
        page = f"{prose}\n{hidden}\n{prose} <b>Mill</b>"
        assert markup.content_regions(page) == [True, False, False, False, True]
        ((_, kinds, clean, content, *_),) = [x.values() for x in next(markup._clean([pa.record_batch([[1], [page]], ["doc_id", "text"])])).to_pylist()]
        assert kinds == ["html"] and "nobody" not in clean + content and "--" not in clean + content
        assert [x for x in clean.split("\n") if x] == [prose, f"{prose} Mill"]


def test_kinds_come_from_the_pass_that_cleans(spark):
    prose = "A long line of prose that goes on for a while and says something about the mills."
    page = "\n".join([*(f"[Page {k}](/p/{k})" for k in range(6)), "Mills", prose, prose])
    docs = spark.createDataFrame([(1, page), (2, None), (3, prose), (4, "a [[b]] <i>c</i>")], "doc_id long, text string")
    found = markup.markup_kinds(docs)
    assert "clean_text" in found._jdf.queryExecution().optimizedPlan().toString()
    # marks of lines that the regions leave out are listed as well
    assert sorted(map(tuple, found.collect())) == [(1, "markdown"), (4, "html"), (4, "wiki")]
    assert markup.clean_markup(docs).where("doc_id = 1").head().clean_text == f"Mills\n{prose}\n{prose}"


@pytest.mark.parametrize("text", ["{{title}}", "a ${name} b", "%%CITY%%", "%(price)s", "<%= entity.title %>", "{% block x %}", "__PRICE__", "#CAPTION#", "@Model.city", "[INSERT TITLE HERE]", "<your price here>", "«first_name»", "TBD: title", "{0} city {1}", "Untitled {n}", "city: undefined", "title: [object Object]"])
def test_slots(text):
    found = lambda x: bool(residue.slots_of(x, []))
    assert found(text) and found(f"Before {text} after") and not found(f"```\n{text}\n```")


@pytest.mark.parametrize("text", ["the month{{dn}} of May", "{{citation needed|date=May}}", "null and void", "in the year # 7", "`{{x}}`", "50% OFF", "a_b_c"])
def test_no_slots(text):
    assert not residue.slots_of(text, []) and slots.find_slot(slots.without_code(text)) is None


def test_filler():
    assert residue.is_filler("Lorem ipsum dolor amet lorem ipsum amet dolor sit lorem.")
    assert residue.is_filler("Sample text Sample text Sample text Rumni.")
    assert residue.is_filler("xxxxxxxxxx asdf qwer zxcv blah blah Bikje")
    assert not residue.is_filler("The printer set Lorem ipsum in the margin of the page and was paid for it by the guild.")
    assert not residue.is_filler("They walked on and on and on to the market of the old town.")
    assert residue.is_filler("Lorem ipsum dolor amet lorem ipsum amet dolor sit lorem. " * 200)
    assert residue.is_filler("This is where the text of the article will stand as soon as somebody has found the time to write all of it down. " * 9)


RESIDUE = "doc_id long, text string, title string, entity_title string, url string"


def test_residue_pages(spark):
    at = lambda k: f"http://h/{'abcdefghijklmnop'[k]}"
    rows = [(k, f"404 - Page not found\n\nTry again" + ("\nReference 7" if k else ""), "t", None, at(k)) for k in range(3)]
    # wording that is known to nobody, with the page's own name in it, and more than a dozen lines
    gone = "\n".join(f"We looked {x}" for x in ("high", "low", "left", "right", "up", "down", "here", "there", "in", "out", "near", "far", "everywhere"))
    rows += [(20 + k, f"{gone}\nbut {n} is gone for good, so please go home and try another one. " + "Go home. " * 200, n, n, at(k)) for k, n in enumerate(("Mill", "Tower", "Gate"))]
    rows += [(30 + k, f"Sie brauchen dafür erst den Schalter.{x}", n, n, at(k + 3)) for k, (n, x) in enumerate((("Hill", "\nJavaScript fehlt."), ("Pond", "\nJavaScript fehlt."), ("Ford", "")))]
    rows += [
        (11, "The archive's viewer needs JavaScript, but the guild printed 12 plates.", "t", "e", None),
        (12, "404 - Page not found\nA sentence that belongs to no message at all and stands alone.", "t", "e", None),
        (13, "Prose.", "{{title}}", "e", None),
        (14, "Lorem ipsum amet ipsum lorem dolor amet.", "t", "e", None),
        (15, "Prose only.", None, None, None),
        # copies of an article under one address are no message
        *((40 + k, "The mill was sold in 1712 and burnt down the year after.", "Mill", "x", "http://h/mill") for k in range(4)),
    ]
    df = spark.createDataFrame(rows, RESIDUE)
    got = {r.doc_id: r.residue_kind for r in residue.template_residue(df).collect()}
    assert got == {0: "error", 1: "error", 2: "error", 20: "error", 21: "error", 22: "error", 30: "script", 31: "script", 32: "script", 13: "placeholder", 14: "filler"}
    assert sorted(r.doc_id for r in residue.without_residue(df).collect()) == [11, 12, 15, 40, 41, 42, 43]
    assert {r.doc_id for r in residue.template_residue(df, whole=True).collect()} == set(got) - {13}


def test_slots_of_unseen_syntax(spark):
    rows = [(k, f"Dear {n}, your order {17 * k} ships on {d}.", n, n, None) for k, (n, d) in enumerate((("Anna", "Monday"), ("Berk", "Friday"), ("Cem", "Sunday")))]
    rows += [
        (10, "Dear CUSTOMERNAME, your order ORDERNO ships on SHIPDATE.", "Order", None, None),
        # emphasis: others write the same word small
        (11, "The HERALD was printed here in town.", "x", None, None),
        *((12 + k, f"The {w} was printed here in town.", "y", None, None) for k, w in enumerate(("Herald", "Mirror", "Courier"))),
        # a name that no other record fills
        (20, "They read aloud about UNESCO in the hall.", "z", None, None),
    ]
    rows = [(i, f"Prose of {'abcdefghijklmnopqrstuvwxyz'[i]} alone.\n{x}", *rest) for i, x, *rest in rows]
    assert {r.doc_id: r.residue_kind for r in residue.template_residue(spark.createDataFrame(rows, RESIDUE)).collect()} == {10: "placeholder"}


def test_shown_slots_need_alignment(spark):
    rows = [(1, "See the entry of {{price}} and the notes.", "a", None, None), (2, "See the entry of __CITY__ and the notes.", "b", None, None), (3, "A bare brace {{price}} in one text.", "c", None, None)]
    df = spark.createDataFrame(rows, RESIDUE)
    assert {r.doc_id for r in residue.template_residue(df).collect()} == {1, 2}
    assert {r.doc_id for r in residue.template_residue(df.where("doc_id = 3")).collect()} == set()


def test_slots_by_alignment(spark):
    towns = ["Velka", "Morin", "Tasso", "Hurde"]
    rows = [(k, f"Prose of {t}.\nKaynak: {t} archive\nEintritt: {k + 2} Taler\nthe gate of {t} opens at {k + 6}\nLegends:", t) for k, t in enumerate(towns)]
    rows += [
        (10, "Prose.\nKaynak: undefined", "Brisk"),
        (11, "Prose.\nEintritt:\n\nMore prose.", "Brisk"),
        (12, "the gate of Brisk opens at NaN", "Brisk"),
        (13, "Prose.\nKaynak: opening_hours", "Brisk"),
        (14, "Prose.\nLegends:\nThe miller said: none of it is null.", "Brisk"),
        (15, "Kaynak:\n- a list below", "Brisk"),
        (16, "Unseen thing: undefined", "Brisk"),
        (17, "```\nKaynak: undefined\n```", "Brisk"),
    ]
    own = "".join
    df = spark.createDataFrame([(i, f"{t}\n\nThe {own(chr(97 + (i * k) % 26) for k in range(1, 9))} is told of here alone.", n, n, None) for i, t, n in rows], RESIDUE)
    assert {r.doc_id: r.residue_kind for r in residue.template_residue(df).collect()} == dict.fromkeys([10, 11, 12, 13], "placeholder")


def brute_lines(rows):
    docs, total = defaultdict(set), defaultdict(set)
    norm = lambda x: re.sub("[0-9]+", "0", " ".join(x.split()).lower())
    for i, s, t in rows:
        total[s].add(i)
        for x in t.split("\n"):
            docs[s, norm(x)].add(i)
    return sorted((i, k) for i, s, t in rows for k, x in enumerate(t.split("\n")) if len(norm(x)) >= 25 and len(docs[s, norm(x)]) >= 4 and len(docs[s, norm(x)]) * 10 >= len(total[s]))


def test_repeated_lines_equal_brute_force(spark):
    rows = []
    for i in range(90):
        s = "hot" if i % 3 else f"s{i % 2}"
        own = "".join(chr(97 + int(c)) for c in str(i))
        lines = [f"Own line {own} that nobody else has here", f"Copyright {2000 + i} by the Atlas of the valley", "All rights of this page are reserved" if i % 7 else "  all RIGHTS of this\u00a0page are reserved\r"]
        lines += ["Rare line that only a few pages carry at all"] * (i in (1, 4, 7)) + ["short"] + ["Print this page or send it by mail"] * (2 if i % 13 == 0 else 0)
        rows.append((i, s, "\n".join(lines)))
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    got = sorted((r.doc_id, r.line_no) for r in repeated_lines.repeated_lines(df).collect())
    assert got == brute_lines(rows) and got
    clean = {r.doc_id: r for r in repeated_lines.without_repeated_lines(df).collect()}
    assert clean[1].clean_text == "Own line b that nobody else has here\nRare line that only a few pages carry at all\nshort" and clean[1].n_removed == 2


def test_leaf_templates():
    t = repeated_lines.LeafTemplates()
    assert t.add("a b c d".split()) == 0 and t.add("a b x d".split()) == 0 and t.add("q r s t".split()) == 1
    assert t.templates[0] == ["a", "b", None, "d"]


def test_cleaned_documents_lack_lines_of_templates_that_cover_many_only_together(spark):
    months = ["January", "February", "March", "April", "May", "June"]
    rows = [(k, "s", f"The article about mill number {'abcdef'[k]} and its people.\nChecked by the staff of the Atlas Review in {m} of this year\nA pattern about {m} and {'uvwxyz'[k]} of {'abcdef'[k]}") for k, m in enumerate(months)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    assert repeated_lines.repeated_lines(df).count() == 0
    assert sorted((r.doc_id, r.line_no, r.n_template) for r in repeated_lines.template_lines(df).where("line_no = 1").collect()) == [(k, 1, 6) for k in range(6)]
    cleaned = {r.doc_id: r.clean_text for r in repeated_lines.without_repeated_lines(df).collect()}
    assert all("Checked" not in t and "A pattern" in t for t in cleaned.values())


def test_templates_count_distinct_documents(spark):
    # two member lines in each of two documents are two documents, not four
    text = lambda k: f"Checked by the staff of the Atlas Review in {k} of this year\nChecked by the staff of the Atlas Review in x{k} of this year"
    df = spark.createDataFrame([(k, "s", text("ab"[k])) for k in range(2)], "doc_id long, source string, text string")
    assert repeated_lines.template_lines(df).count() == 0 and repeated_lines.template_lines(df, min_docs=2).count() == 4


def test_many_unlike_lines_of_one_leaf_are_quick():
    import time

    tree, rng = repeated_lines.LeafTemplates(), np.random.default_rng(3)
    began = time.perf_counter()
    at = {tree.add(["the", "same", "path", *(f"w{x}" for x in rng.integers(0, 100_000, 9))]) for _ in range(20_000)}
    assert len(at) == 20_000 and time.perf_counter() - began < 10
    # the nearest template is found, as by looking at all
    a = tree.add("the same path leads from the old mill to town".split())
    assert tree.add("the same path leads from the new mill to town".split()) == a and tree.templates[a].count(None) == 1
