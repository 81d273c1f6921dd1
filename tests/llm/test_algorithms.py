"""Splitting, near duplicates, value mapping, packing, mixing and toxicity against models and invariants."""

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpusloom.llm import canonical, mixing, near_duplicates, packing, splitting, tokens, toxicity


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="ab .,\n\r#é", max_size=900), st.integers(5, 120), st.integers(0, 4))
def test_pieces_rebuild_the_text(text, most, overlap):
    points = splitting.cut_points(text, most, overlap)
    assert points[-1][0] == len(text)
    at = 0
    for end, _ in points:
        start = max(0, at - overlap)
        assert end - start <= most and (end > at or not text)
        at = end


def test_splits_at_the_strongest_boundary():
    text = "One two three. Four five six.\n\nSeven eight nine. Ten eleven twelve."
    (end, strength), *_ = splitting.cut_points(text, 45, 5)
    assert text[:end].endswith("\n\n") and strength == 5
    assert splitting.longest_run("a bcd\u00a0e\tf") == 5


def test_hard_and_soft(spark):
    docs = spark.createDataFrame([(1, "a" * 30), (2, "ab " * 10), (3, "short")], "doc_id long, text string")
    specs = spark.createDataFrame([(1, 12, 3)], "spec_id int, max_chars int, overlap_chars int")
    rows = splitting.split_documents(docs, specs).orderBy("doc_id", "piece_no").collect()
    assert {r.doc_id: r.cut_kind for r in rows} == {1: "hard", 2: "soft"}
    for r in rows:
        assert r.end - r.start <= 12 and (r.piece_no == 0 or r.core_start - r.start == 3)
    assert "".join(r.piece[r.core_start - r.start :] for r in rows if r.doc_id == 2) == "ab " * 10


def family(rng, n, edits):
    ws = [f"w{rng.randrange(5000)}" for _ in range(n)]
    out = [" ".join(ws)]
    for k in edits:
        x = list(ws)
        for _ in range(k):
            x[rng.randrange(n)] = f"v{rng.randrange(9000)}"
        out.append(" ".join(x))
    return out


def brute_pairs(texts, t, n=3, least=40):
    sets = {}
    for i, x in texts:
        ws = near_duplicates.words(x)
        if len(ws) >= least:
            sets[i] = set(zip(*(ws[k:] for k in range(n))))
    return sorted((a, b) for a in sets for b in sets if a < b and len(sets[a] & sets[b]) >= t * len(sets[a] | sets[b]))


def test_pairs_equal_brute_force(spark):
    rng, texts = random.Random(5), []
    for _ in range(25):
        texts += family(rng, 150, [0, 1, 3, 6, 30])
    texts += ["copy " + " ".join(f"c{k}" for k in range(60))] * 12 + ["few words only"] * 3
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    links, members = near_duplicates.near_duplicate_links(df, shingle=3, threshold=0.7, min_words=40)
    got = sorted((r.doc_id_a, r.doc_id_b) for r in near_duplicates.document_pairs(links, members).collect())
    assert got == brute_pairs(rows, 0.7)


def test_busy_signature_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(near_duplicates, "_BLOCK", 3)
    sigs = spark.createDataFrame([(7, k, 10) for k in range(11)] + [(8, 1, 10), (8, 2, 99)], "sig long, rep long, n int")
    got = sorted(map(tuple, near_duplicates._candidate_pairs(sigs, 0.7).collect()))
    assert got == [(a, b) for a in range(11) for b in range(a + 1, 11)]


def test_components(spark):
    chain = [(k, k + 1) for k in range(0, 40)] + [(100, 101), (101, 102), (200, 100)]
    got = dict(map(tuple, near_duplicates.components(spark.createDataFrame(chain, "a long, b long")).collect()))
    assert {got[k] for k in range(41)} == {0} and {got[k] for k in (100, 101, 102, 200)} == {100}
    assert near_duplicates.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_classes(spark):
    rng = random.Random(8)
    a, b = family(rng, 120, [1]), family(rng, 120, [])
    rows = list(enumerate([a[0], a[1], a[0], b[0], "x y z"]))
    got = {r.doc_id: (r.class_id, r.n_links) for r in near_duplicates.near_duplicate_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {0: (0, 1), 1: (0, 1), 2: (0, 1), 3: (3, 0)}


def slow_levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="abcdé", max_size=14), st.text(alphabet="abcdé", max_size=14))
def test_levenshtein(a, b):
    assert canonical.levenshtein(a, b) == slow_levenshtein(a, b)


def test_tree_returns_every_entry_within():
    rng = random.Random(2)
    ws = ["".join(rng.choices("abc", k=rng.randrange(1, 9))) for _ in range(300)]
    tree = canonical.BKTree()
    for k, w in enumerate(ws):
        tree.add(w, k)
    for q in ws[:20]:
        for most in (0, 1, 3):
            got = {r for _, _, refs in tree.within(q, most) for r in refs}
            assert got == {k for k, w in enumerate(ws) if canonical.levenshtein(q, w) <= most}


@pytest.mark.parametrize("value, ref", [("harbor town", 1), ("HARBOURTOWN", 1), ("town, Harbour", 1), ("(harbour-town)", 1), ("5. Harbour Town etc", 1), ("Harb. town", 1), ("HarbourTown", 1), ("a kind of harbour town", 1), ("liman kenti", 1), ("opening hours & fees", 2), ("opening hours, fees", 2), ("smartphone model", -1), ("???", -1), ("n/a", -1)])
def test_typed_values(value, ref):
    m = canonical.Matcher([(1, "Harbour town", ["liman kenti"]), (2, "opening hours and fees", []), (3, "Harvest vigil", [])])
    assert m.find(value) == ref


def test_token_round_trip():
    enc = tokens.encoding(tokens.DEFAULT_VOCABULARY)
    assert enc.decode(enc.encode_ordinary("Çiğ köfte, Straße <|endoftext|>\n")) == "Çiğ köfte, Straße <|endoftext|>\n"


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_best_fit_respects_every_capacity(rule):
    rng = random.Random(3)
    sizes = sorted((rng.randrange(1, 900) for _ in range(3000)), reverse=True)
    fit = packing.BestFit(1000, 6, 700_000.0, rule, (1.0, 0.1, 0.5))
    bins = {}
    for n in sizes:
        bins.setdefault(fit.put(n), []).append(n)
    assert sum(map(len, bins.values())) == 3000
    assert all(sum(b) <= 1000 and len(b) <= 6 and (sum(n * n for n in b) <= 700_000 or len(b) == 1) for b in bins.values())
    free = packing.BestFit(1000, 10_000, 1e9, rule, (1.0, 0.1, 0.5))
    assert len({free.put(n) for n in sizes}) <= 1.03 * sum(sizes) / 1000 + 1


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_best_fit_is_the_best_of_all(rule):
    rng = random.Random(8)
    sizes = sorted((rng.randrange(1, 1000) for _ in range(1500)), reverse=True)
    fit, left, where = packing.BestFit(1000, 6, 500_000.0, rule, (1.0, 0.1, 0.5)), [], []
    for n in sizes:
        able = [c for c, (t, d, a) in enumerate(left) if t >= n and d >= 1 and a >= n * n]
        best = min((fit.score(n, left[c][1], left[c][0], left[c][2]) for c in able), default=None)
        c = fit.put(n)
        assert (c == len(left)) == (not able)
        if able:
            assert abs(fit.score(n, left[c][1], left[c][0], left[c][2]) - best) < 1e-12
        else:
            left.append([1000, 6, 500_000.0])
        left[c][0] -= n
        left[c][1] -= 1
        left[c][2] -= n * n
        where.append(c)
    alone = {c for n, c in zip(sizes, where) if n * n > 500_000}
    assert all(where.count(c) == 1 for c in alone)
    bound = packing.lower_bound({n: sizes.count(n) for n in set(sizes)}, 1000, 6, 500_000.0)
    assert bound <= len(left) <= 1.04 * bound


def test_constraints_bind():
    rng = random.Random(9)
    sizes = sorted((rng.randrange(1, 700) for _ in range(3000)), reverse=True)
    used = {}
    for documents, cost in ((10_000, 1e9), (10_000, 350_000.0), (2, 1e9)):
        fit = packing.BestFit(1000, documents, cost, "norm", (1.0, 0.1, 0.5))
        used[documents, cost] = len({fit.put(n) for n in sizes})
    assert used[10_000, 350_000.0] > 1.02 * used[10_000, 1e9] and used[2, 1e9] > used[10_000, 1e9]


def test_packing_keeps_every_token(spark):
    rng = random.Random(4)
    rows = [(k, " ".join(["word"] * rng.randrange(1, 300)), rng.choice(["en", "EN", "en-XX", "tr", None])) for k in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    specs = spark.createDataFrame([(1, 100, None), (2, 128, "en")], "pack_id int, capacity_tokens int, lang string")
    got = packing.pack_documents(docs, specs, share_rows=80).toPandas()
    counts = {k: len(tokens.encoding(tokens.DEFAULT_VOCABULARY).encode_ordinary(t)) for k, t, _ in rows}
    one = got[got.pack_id == 1]
    assert one.groupby("doc_id").n_tokens.sum().to_dict() == counts
    assert (one.groupby("container").n_tokens.sum() <= 100).all()
    whole = one[one.doc_id.isin([k for k, n in counts.items() if n <= 100])]
    assert whole.groupby("doc_id").size().max() == 1
    assert set(got[got.pack_id == 2].doc_id) == {k for k, _, lang in rows if lang and lang.lower().startswith("en")}
    report = {r.pack_id: r.fill for r in packing.fill_report(packing.pack_documents(docs, specs), specs).collect()}
    assert report[1] > 0.93
    for r in packing.fill_report(packing.pack_documents(docs, specs), specs).collect():
        assert r.n_over == 0 and r.least_containers <= r.n_containers <= 1.02 * r.least_containers + 1


def test_plan_mixes():
    plan = mixing.plan_mixes([("a", 100), ("b", 1000)], [(1, "A", 3.0, 2), (1, "b ", 1.0, 1), (1, "c", 1.0, 9)])
    assert [(p[2], round(p[3], 2), p[5], p[6], p[7]) for p in plan] == [("a", 0.75, 200, 2, 0), ("b", 0.25, 66, 0, 66), ("c", 0.0, 0, 0, 0)]


def test_ranges_of_keys_are_of_like_size(spark):
    rng = np.random.default_rng(1)
    w = np.clip(rng.beta(2, 3, 60_000), 0.1, 1)
    rows = [(float(x), float(k)) for x, k in zip(w, -np.log(rng.random(len(w))) / w)]
    df = spark.createDataFrame(rows, "weight double, key double").selectExpr("*", "'a' as kind")
    shares = F.array(*map(F.lit, mixing.weight_classes(df)["a"]))
    got = df.select("key", mixing.range_of(F.col("key"), shares, 64).alias("b")).toPandas()
    sizes = got.groupby("b").size()
    assert len(sizes) == 64 and sizes.max() < 1.5 * sizes.mean()
    assert (got.sort_values("key").b.diff().dropna() >= 0).all()


def test_mix_meets_shares_and_caps(spark):
    rng = random.Random(6)
    rows = [(k, rng.choice(["small", *["big"] * 9]), " ".join(["word"] * rng.randrange(5, 60))) for k in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, source_type string, text string")
    targets = spark.createDataFrame([(1, "small", 0.5, 3), (1, "Big", 0.5, 1), (2, "big", 1.0, 2), (2, "small", 0.0, 1)], "mix_id int, source_type string, target_share double, max_repeats int")
    chosen, report = mixing.mix_documents(docs, targets)
    got, shares = chosen.toPandas(), {(r.mix_id, r.source_type): r for r in report.collect()}
    assert not got.duplicated(["mix_id", "source_type", "doc_id"]).any()
    assert got.groupby(["mix_id", "source_type"]).copies.max().to_dict() == {(1, "Big"): 1, (1, "small"): 3, (2, "big"): 2}
    for k in ((1, "small"), (1, "Big")):
        assert abs(shares[k].actual_share - 0.5) < 0.01 and shares[k].tokens <= shares[k].budget
    assert shares[2, "big"].tokens == 2 * shares[2, "big"].available_tokens and shares[2, "small"].tokens == 0
    again = mixing.mix_documents(docs.repartition(3), targets)[0].toPandas()
    key = ["mix_id", "source_type", "doc_id", "copies"]
    assert sorted(map(tuple, got[key].values.tolist())) == sorted(map(tuple, again[key].values.tolist()))


def test_plain_text_reads_past_disguises():
    p = toxicity.plain
    assert p("W\u200bOOOORTHLESS") == "worthless" and p("\u0441l\u043ewn") == "clown" and p("p0rn f1lm") == "porn film" and p("s e x f i l m") == "sexfilm"
    assert p("Şerefsiz, İÇ 1945.") == "serefsiz, ic 0."


def corpus(rng, n):
    nouns, verbs = ["mill", "bridge", "market", "harbour", "garden", "school"], ["was built", "was painted", "was moved", "was sold", "was measured"]
    usual = lambda: f"The {rng.choice(nouns)} of {rng.choice('ABCDEFG')}{rng.randrange(99)} {rng.choice(verbs)} in {rng.randrange(1500, 1900)} by the {rng.choice(nouns)} guild."
    bad = {
        "abusive": lambda: f"You are a {rng.choice(['stupid', 'dumb', 'brainless'])} {rng.choice(['rat', 'donkey', 'fool'])} and everyone in {rng.choice('ABC')}{rng.randrange(99)} knows it.",
        "sexual": lambda: f"Hot singles near {rng.choice('ABC')}{rng.randrange(99)} want {rng.choice(['sex cams', 'porn chat'])} tonight, no sign-up.",
    }
    hard = lambda: f"The stubborn donkey of {rng.choice('ABC')}{rng.randrange(99)} carried salt to the {rng.choice(nouns)} for years."
    out = []
    for _ in range(n):
        s, cats = [usual() for _ in range(rng.randrange(3, 9))], {"none"}
        if rng.random() < 0.25:
            k = rng.choice(list(bad))
            s.insert(rng.randrange(len(s)), bad[k]())
            cats = {k}
        elif rng.random() < 0.3:
            s.append(hard())
        out.append((" ".join(s), cats))
    return out


def test_held_out_accuracy():
    rng = random.Random(7)
    train, held = corpus(rng, 900), corpus(rng, 400)
    noisy = [(t, c if rng.random() > 0.05 else {"none"}) for t, c in train]
    model = toxicity.train(noisy, [("donkey", "abusive", 1), ("sex", "sexual", 2), ("rat", "abusive", 1)])
    found = [({k for k in model.document(t) if k}, c - {"none"}) for t, c in held]
    hits = sum(len(a & b) for a, b in found)
    assert hits >= 0.95 * sum(len(b) for _, b in found) and hits >= 0.95 * sum(len(a) for a, _ in found)


def test_scores_below_the_threshold_are_real():
    rng = random.Random(9)
    model = toxicity.train(corpus(rng, 400), [("donkey", "abusive", 1)])
    model.threshold = 0.8
    union, ordinary = toxicity.Compressor(b"\n".join(model.toxic.values())), toxicity.Compressor(model.ordinary)
    texts = [t for t, _ in corpus(rng, 150)] + ["You grey mill, everyone in the market knows it. Singles of the harbour guild."]
    real = {}
    for t in texts:
        sizes = [(union.size(raw), ordinary.size(raw)) for raw in map(str.encode, toxicity.windows(t))]
        real[t] = max([0.0, *((o - u) / o for u, o in sizes)])
    below = [t for t in texts if 0 < real[t] < model.threshold]
    assert below and [model.document(t)[""] for t in below] == [real[t] for t in below]
    for t in texts:
        got, quick = model.document(t), model.document(t, exact=False)
        assert {k: v for k, v in got.items() if k} == {k: v for k, v in quick.items() if k}


def test_minhash_symbols_estimate_similarity():
    words = [f"w{k}" for k in range(300)]
    h = near_duplicates._Hashes()
    a, b = near_duplicates.shingles(words, 3, h), near_duplicates.shingles(words[:-30], 3, h)
    assert len(np.intersect1d(a, b)) / len(np.union1d(a, b)) == pytest.approx(268 / 298, abs=1e-9)


def test_shards_of_a_list_give_what_the_whole_list_gives(spark):
    rng = random.Random(12)
    word = lambda: "".join(rng.choice("abdeiklmnorstu") for _ in range(rng.randrange(5, 12)))
    names = sorted({f"{word()} {word()}" for _ in range(120)})
    ref = spark.createDataFrame([(k, n, [word()] if k % 3 else None) for k, n in enumerate(names)], "id int, name string, alt_names array<string>")
    typo = lambda x: x[: (k := rng.randrange(len(x)))] + rng.choice("xyz") + x[k + 1 :]
    values = [*(typo(n) for n in names), *(typo(typo(n)) for n in names), *(word() for _ in range(40)), names[0]]
    occ = spark.createDataFrame([(k, "city", v) for k, v in enumerate(values)], "id int, field_kind string, value string")
    whole = {r.id: r.ref_id for r in canonical.map_values(occ, {"city": ref}).collect()}
    sharded = {r.id: r.ref_id for r in canonical.map_values(occ, {"city": ref}, most_entries=25).collect()}
    assert whole == sharded and len(values) - 1 not in whole
    assert sum(whole[k] == k for k in range(len(names))) > 0.9 * len(names)


def test_short_and_joined_insults_are_windows():
    assert toxicity.windows("you idiot") == ["you idiot"]
    assert toxicity.windows("Go. You fool. The miller came home late.")[0].startswith("go. you fool.")
    joined = "-".join(["you", "are", "a", "complete", "and", "utter", "fool", "and", "nobody", "likes", "you"])
    assert toxicity.windows(joined) == [joined.replace("-", " ")]
    assert toxicity.windows("https://example.org/" + "abc/" * 30) == []
