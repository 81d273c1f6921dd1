"""Abusive, hateful and sexual language, scored by compression distance.

Method: separate zstandard dictionaries are trained on toxic text of each
category and on ordinary text. A window of a document (a sentence) that is
compressed better with a toxic dictionary than with the ordinary one is close
to toxic text; the relative saving is its score, and the threshold is
calibrated on labelled documents that took no part in the training. Neutral,
quoting and condemning uses of the same words are ordinary text and held in
the ordinary dictionary, so whole formulations decide, not single words.

Training: the labels are noisy, given to whole documents, and only one
sentence of many may be toxic. Words and word pairs are weighed by how much
more often they occur in documents labelled with a category than in documents
labelled none; the sentences that carry the weights become toxic text. The
model is fitted on a bounded sample (``per_category`` documents of each
category and ``ordinary`` labelled none, chosen by a hash of the id); every
document is scored.

Windows are read past disguises: invisible characters, look-alike letters,
digits for letters, letters stretched or spaced out, capitals.

Defined results: null and empty texts score 0 and have no category; so does
text that no toxic dictionary compresses better than the ordinary one. Every
other score is the document's real best saving, below the threshold too;
without any usable label nothing is found; labels are compared trimmed and in lower
case, null labels ignored.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.session import bounded_rows

CATEGORIES = ("abusive", "hateful", "sexual")
LACKING = 1500  # most windows that are added to the ordinary dictionary because the others take them for toxic

_INVISIBLE = dict.fromkeys([0xAD, 0x34F, 0x61C, 0x115F, 0x180E, *range(0x200B, 0x2010), *range(0x202A, 0x202F), *range(0x2060, 0x2065), 0xFEFF, *range(0xFE00, 0xFE10), *range(0x300, 0x370)])
# Letters of other scripts that look like Latin ones.
_ALIKE = {
    ord(c): to
    for to, letters in {
        "a": "аα", "b": "вβ", "c": "сϲ", "d": "ԁ", "e": "еёε", "g": "ɡ", "h": "һн", "i": "іїι", "j": "ј", "k": "кκ", "m": "м",
        "n": "ո", "o": "оοσ", "p": "рρ", "q": "ԛ", "s": "ѕ", "t": "тτ", "u": "υ", "v": "ѵν", "w": "ԝω", "x": "хχ", "y": "уўγ",
    }.items()
    for c in letters
}
_FOLD = str.maketrans("ışçğüöâîûáàéèêëíìóòôúùñä", "iscguoaiuaaeeeeiiooouuna")
_TABLE = _INVISIBLE | _ALIKE | _FOLD
_LEET = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "!": "i", "|": "i", "€": "e", "£": "l"}
_LEET_IN = re.compile(r"[0134578@$!|€£]+")
_STRETCHED = re.compile(r"([a-z])\1{2,}")
_SPACED = re.compile(r"(?<!\w)[a-z](?:[ .\-_*·]{1,2}[a-z]){3,}(?!\w)")
_COMMON = [("i̇", "i"), ("ı", "i"), ("ş", "s"), ("ç", "c"), ("ğ", "g"), ("ü", "u"), ("ö", "o"), ("ä", "a"), ("ß", "ss"), ("â", "a"), ("\u00a0", " "), ("•", " "), ("»", " "), ("·", " "), ("–", "-"), ("’", "'")]
_MARKED = re.compile(r"[<\[\]{}`*_~]|''")
_TAGS = re.compile(r"<[^<>\n]{1,200}>|\]\([^)\n]*\)|[\[\]{}`~^]|\*\*|__|''+")
_NUMBERS = re.compile(r"\d+(?:[.,]\d+)*")
# Long runs: encoded data and addresses are no language, words joined by signs are.
_BLOB = re.compile(r"\S{50,}")
_JOIN = re.compile(r"[\W_]+")


def _words_of(m: re.Match) -> str:
    run = m[0]
    if "://" in run or "www." in run or 8 * sum(c.isdigit() for c in run) > len(run) or _JOIN.search(run) is None and run != run.lower() and run != run.upper():
        return " "
    return _JOIN.sub(" ", run)


_SENTENCE = re.compile(r"(?<=[.!?…])[\"'”»)]*[ \t]+")
# A line end that only wraps a sentence: the next line goes on in lower case or with a number.
_WRAP = re.compile(r"([^\s.!?:;|>])[ \t]*\r?\n(?=[a-zçğıöşüâîûäß0-9])")
_WORD = re.compile(r"[^\W\d_]+")
_SPEECH = re.compile(r"[^\W\d_]{2}.*[^\W\d_]{3}")


def _unleet(m: re.Match) -> str:
    """Digits and signs that stand for letters: between letters, or one at a word's edge."""
    s, a, b = m.string, m.start(), m.end()
    left, right = a > 0 and "a" <= s[a - 1] <= "z", b < len(s) and "a" <= s[b] <= "z"
    if left and right or b - a == 1 and (left and m[0] in "01345" and not (b < len(s) and s[b].isalnum()) or right and m[0] in "0134578@$" and "a" <= s[b + 1 : b + 2] <= "z" and not (a > 0 and s[a - 1].isalnum())):
        return "".join(_LEET[c] for c in m[0])
    return m[0]


def plain(text: str) -> str:
    """Lower case, folded, without markup and disguises."""
    s = _TAGS.sub("", text) if _MARKED.search(text) else text
    s = _BLOB.sub(_words_of, s).lower()
    if not s.isascii():
        for a, b in _COMMON:
            s = s.replace(a, b)
        if not s.isascii():
            s = s.translate(_TABLE)
            if not s.isascii() and not unicodedata.is_normalized("NFKC", s):
                s = unicodedata.normalize("NFKC", s)
                s = "".join(c for c in unicodedata.normalize("NFD", s.lower()) if not 0x300 <= ord(c) < 0x370)
    s = _LEET_IN.sub(_unleet, s)
    s = _STRETCHED.sub(r"\1", s)
    s = _SPACED.sub(lambda m: re.sub(r"[^a-z]", "", m[0]), s)
    return _NUMBERS.sub("0", s)


def windows(text: str, most: int = 240) -> list[str]:
    """Sentences of the plain text; longer ones in pieces, short ones with the sentence that follows or precedes."""
    out = []
    for para in plain(_WRAP.sub(r"\1 ", text)).split("\n"):
        short = ""
        for x in _SENTENCE.split(para.strip()):
            if len(x) < 10:
                short = f"{short} {x}".strip()
                continue
            if short:
                x, short = f"{short} {x}", ""
            if "  " in x or "\t" in x:
                x = " ".join(x.split())
            while len(x) > most:
                k = x.rfind(" ", 40, most)
                k = most if k < 0 else k
                out.append(x[:k])
                x = x[k:].strip()
            if _SPEECH.search(x):
                out.append(x)
        if _SPEECH.search(short):
            out.append(short)
    return out


def _features(window: str) -> set[str]:
    ws = _WORD.findall(window)
    return {*ws, *(f"{a} {b}" for a, b in zip(ws, ws[1:]))}


class Compressor:
    """Length of a window compressed with a dictionary of raw content."""

    def __init__(self, content: bytes) -> None:
        params = zstandard.ZstdCompressionParameters.from_level(6, window_log=17, format=zstandard.FORMAT_ZSTD1_MAGICLESS, write_content_size=False, write_checksum=False, write_dict_id=False)
        d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT) if len(content) >= 8 else None
        if d is not None:
            d.precompute_compress(compression_params=params)
        self._compress = zstandard.ZstdCompressor(compression_params=params, **({"dict_data": d} if d else {})).compress

    def size(self, window: bytes) -> int:
        return len(self._compress(window))


class Model:
    """Trained dictionaries and the calibrated threshold."""

    def __init__(self, toxic: dict[str, bytes], ordinary: bytes, threshold: float) -> None:
        self.toxic, self.ordinary, self.threshold = toxic, ordinary, threshold
        self._ready: tuple | None = None

    def __getstate__(self) -> tuple:
        return self.toxic, self.ordinary, self.threshold

    def __setstate__(self, state: tuple) -> None:
        self.__init__(*state)

    def _compressors(self) -> tuple:
        if self._ready is None:
            self._ready = (Compressor(b"\n".join(self.toxic.values())), Compressor(self.ordinary), {k: Compressor(v) for k, v in self.toxic.items()})
        return self._ready

    def scores(self, window: str, low: bool = True) -> tuple[float, str | None]:
        """(relative saving of the best toxic dictionary, its category).

        Without ``low`` a window that can't reach the threshold gets 0 unread.
        """
        raw = window.encode()
        u = self._compressors()[0].size(raw)
        if not low and _bound(raw, u) < self.threshold:
            return 0.0, None
        return self._saving(raw, u)

    def _saving(self, raw: bytes, u: int) -> tuple[float, str | None]:
        _, ordinary, each = self._compressors()
        o = ordinary.size(raw)
        saving = (o - u) / o
        if saving < self.threshold:
            return max(saving, 0.0), None
        sizes = {k: c.size(raw) for k, c in each.items()}
        best = min(sizes, key=lambda k: (sizes[k], k))
        return max(saving, (o - sizes[best]) / o), best

    def document(self, text: str | None, exact: bool = True) -> dict[str, float]:
        """The best score of each category; the overall best under ''.

        Without ``exact`` the overall best is only right from the threshold on.
        """
        out = {"": 0.0}
        union = self._compressors()[0]
        sized = []
        for w in windows(text) if text else ():
            raw = w.encode()
            u = union.size(raw)
            sized.append((_bound(raw, u), u, raw))
        # the likeliest windows first: one whose bound is below the threshold and no more than the best so far changes nothing
        for bound, u, raw in sorted(sized, reverse=True):
            if bound < self.threshold and (not exact or bound <= out[""]):
                break
            s, k = self._saving(raw, u)
            if s > out[""]:
                out[""] = s
            if k and s >= self.threshold and s > out.get(k, 0.0):
                out[k] = s
        return out


def _bound(raw: bytes, u: int) -> float:
    """The most that a window can save: its ordinary length is at most its own and that of a frame."""
    return 1 - u / (len(raw) + 12)


def train(labelled: list[tuple[str, set[str]]], terms: list[tuple[str, str, int]], size: int = 100_000, ordinary_size: int = 130_000) -> Model:
    """Model from (text, categories; {'none'} for ordinary) and flag terms (term, category, severity).

    A third of the documents is held out for the threshold.
    """
    rows = [(windows(t), c) for t, c in labelled if t]
    rows = [(w, c) for w, c in rows if w]
    held, fit = rows[::3], [r for k, r in enumerate(rows) if k % 3]
    if len(fit) < 6:
        fit = held = rows
    trained = _fit(_without_copies(fit), terms, size, ordinary_size)
    if not trained.toxic:
        trained.threshold = 9.0
        return trained
    trained.threshold = 0.15
    marks = sorted(((max((trained.scores(w, low=False)[0] for w in ws), default=0.0), bool(cats - {"none"})) for ws, cats in held), reverse=True)
    final = _fit(_without_copies(rows), terms, size, ordinary_size)
    final.threshold = _calibrate(marks)
    return final


def _fit(fit: list[tuple[list[str], set[str]]], terms: list[tuple[str, str, int]], size: int, ordinary_size: int) -> Model:
    """Dictionaries from the windows of labelled documents."""
    n_docs: Counter = Counter()
    seen: dict[str, Counter] = defaultdict(Counter)
    for ws, cats in fit:
        fs = set().union(*map(_features, ws))
        for c in cats:
            n_docs[c] += 1
            seen[c].update(fs)
    prior: dict[str, dict[str, float]] = defaultdict(dict)
    for term, cat, severity in terms:
        w = plain(term).strip()
        if cat in CATEGORIES and w:
            prior[cat][w] = 0.5 * (severity or 1)
    none, n_none = seen["none"], max(1, n_docs["none"])
    toxic_docs = max(1, sum(n_docs[c] for c in CATEGORIES))
    any_toxic: Counter = Counter()
    for c in CATEGORIES:
        any_toxic.update(seen[c])
    weight: dict[str, float] = {}
    least = 2 if toxic_docs < 200 else 3
    for f, n in any_toxic.items():
        w = math.log((n + 0.1) / toxic_docs / ((none[f] + 0.1 + 0.002 * n_none) / n_none))
        if n >= least and w > 0:
            weight[f] = w

    def ordinary(f: str) -> bool:
        """Whether a feature is not much rarer in documents labelled none; some of them are labelled wrongly."""
        return none[f] / n_none > 0.2 * any_toxic[f] / toxic_docs

    def term_score(fs: set[str]) -> float:
        return max((prior[c].get(f, 0.0) for c in CATEGORIES for f in fs), default=0.0)

    def toxic_score(w: str) -> float:
        """How much a window looks like the text of toxic documents and unlike ordinary text; 0 if it is ordinary."""
        fs = _features(w)
        known = [f for f in fs if any_toxic[f] + none[f] >= 3]
        pairs = [f for f in known if " " in f]
        usual = sum(map(ordinary, pairs)) / max(1, len(pairs))
        if usual > 0.5 and len(pairs) > 2:
            return 0.0
        marks = sorted((weight[f] for f in known if f in weight), reverse=True)[:5]
        return (sum(marks) / 5 + term_score(fs)) * (1 - usual)

    def category(w: str) -> str | None:
        fs = [f for f in _features(w) if f in weight]
        total = {}
        for c in CATEGORIES:
            if n_docs[c]:
                part = [weight[f] * math.log((seen[c][f] + 0.5) / (n_docs[c] + 1)) for f in fs]
                total[c] = sum(part) / max(1e-9, sum(weight[f] for f in fs)) + 1.5 * sum(prior[c].get(f, 0.0) for f in _features(w))
        return max(total, key=total.get) if total else None

    chosen: dict[str, list[tuple[float, str]]] = defaultdict(list)
    for ws, cats in fit:
        if cats - {"none"}:
            for s, w in sorted(((toxic_score(w), w) for w in ws), reverse=True)[:4]:
                if s >= 1.2 and (k := category(w)):
                    chosen[k].append((s, w))
    toxic = {}
    for k in CATEGORIES:
        lines, used, n = [], set(), 0
        for s, w in sorted(chosen[k], reverse=True):
            if w not in used and n + len(w) < size:
                used.add(w)
                lines.append(w)
                n += len(w) + 1
        toxic[k] = "\n".join(reversed(lines)).encode()
    toxic = {k: v for k, v in toxic.items() if len(v) >= 8}
    # half of the ordinary text is what looks most like toxic text, the other half what is said most often
    hard, plain_lines, heads = [], [], Counter()
    for ws, cats in fit:
        if cats == {"none"}:
            for w in ws:
                fs = _features(w)
                if (s := term_score(fs) + max((weight.get(f, 0.0) for f in fs), default=0.0)) > 1.0:
                    hard.append((s, w))
                plain_lines.append(w)
                heads[" ".join(w.split()[:2])] += 1
    hard.sort(reverse=True)
    plain_lines.sort(key=lambda w: (-heads[" ".join(w.split()[:2])], w))
    lines, used = [], Counter()
    for pool, most, each in (([w for _, w in hard], ordinary_size // 2, 4), (plain_lines, ordinary_size, 5)):
        n = sum(len(x) + 1 for x in lines)
        for w in pool:
            head = " ".join(w.split()[:2])
            # what would count as toxic in a document labelled so was overlooked by its reviewer
            if used[head] < each and n + len(w) < most and toxic_score(w) < 1.2:
                used[head] += 1
                lines.append(w)
                n += len(w) + 1
    model = Model(toxic, "\n".join(reversed(lines)).encode(), 0.12)
    if not toxic:
        return model
    # ordinary windows that the dictionaries take for toxic ones are what the ordinary one lacks
    lacking, used = [], Counter()
    for ws, cats in fit:
        if cats == {"none"}:
            for w in ws:
                head = " ".join(w.split()[:2])
                if used[head] < 4 and model.scores(w, low=False)[0] >= 0.12 and toxic_score(w) < 0.5:
                    used[head] += 1
                    lacking.append(w)
    extra = "\n".join(lacking[-LACKING:])
    return Model(toxic, (("\n".join(reversed(lines)) + "\n" + extra) if extra else "\n".join(reversed(lines))).encode(), 0.3)


def _without_copies(rows: list[tuple[list[str], set[str]]]) -> list[tuple[list[str], set[str]]]:
    """Rows whose own windows were not mostly seen in an earlier row, so that copies don't count as evidence twice.

    Windows that come again and again are the site's, and tell nothing about copying.
    """
    seen: Counter = Counter()
    out = []
    for ws, cats in rows:
        own = [w for w in ws if seen[w] < 5]
        if (own or len(ws) < 4) and (len(own) < 3 or sum(seen[w] > 0 for w in own) <= 0.4 * len(own)):
            out.append((ws, cats))
            seen.update(set(ws))
    return out


def _calibrate(marks: list[tuple[float, bool]]) -> float:
    """The threshold between 0.15 and 0.5 with the best F1 on (score, toxic), the middle of the best run."""
    total = sum(t for _, t in marks)
    best, spots = -1.0, []
    for k in range(36):
        x = 0.15 + k / 100
        hits = sum(t for s, t in marks if s >= x)
        n = sum(1 for s, _ in marks if s >= x)
        f1 = 2 * hits / max(1, n + total)
        if f1 > best + 1e-9:
            best, spots = f1, [x]
        elif f1 > best - 0.003:
            spots.append(x)
    return spots[len(spots) // 2] if total else 0.3


def fit(docs: DataFrame, labels: DataFrame, terms: DataFrame, per_category: int = 2000, ordinary: int = 4000) -> Model:
    """A model from a bounded sample of the labelled documents.

    ``labels`` needs doc_id, category; at most ``per_category`` documents of a
    category and ``ordinary`` others are read, in the order of a hash: those
    labelled none, and where they are fewer, unlabelled ones.
    """
    category = F.lower(F.trim("category"))
    by_doc = labels.select("doc_id", category.alias("c")).where(F.col("c").isin("none", *CATEGORIES)).groupBy("doc_id").agg(F.collect_set("c").alias("cats"))
    toxic = F.size(F.array_remove("cats", "none")) > 0
    main = F.when(toxic, F.element_at(F.array_sort(F.array_remove("cats", "none")), 1)).otherwise(F.lit("none"))
    ranked = by_doc.withColumn("main", main).withColumn("h", F.xxhash64("doc_id"))
    # a bound per group by thresholds of the hash, so that no group is sorted in one task
    counts = {r.main: r.n for r in ranked.groupBy("main").agg(F.count("*").alias("n")).collect()}
    keep = F.lit(False)
    for k, n in counts.items():
        most = ordinary if k == "none" else per_category
        share = min(1.0, most / max(1, n))
        keep = keep | ((F.col("main") == k) & (F.pmod("h", F.lit(1_000_000)) < int(share * 1_000_000)))
    sample = ranked.where(keep).join(docs.select("doc_id", "text"), "doc_id").select("doc_id", "cats", "text")
    lacking = ordinary - counts.get("none", 0)
    if lacking > 0:
        # few labels: unlabelled documents, nearly all of them ordinary, make up the number
        share = min(1.0, lacking / max(1, docs.count()))
        more = docs.select("doc_id", "text").where(F.col("text").isNotNull() & (F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(1_000_000)) < int(share * 1_000_000)))
        sample = sample.union(more.join(by_doc.select("doc_id"), "doc_id", "left_anti").select("doc_id", F.array(F.lit("none")).alias("cats"), "text"))
    # the shares above bound the sample but for chance
    rows = sorted(bounded_rows(sample, 2 * (3 * per_category + ordinary) + 2000, "labelled sample"), key=lambda r: (r.doc_id is None, r.doc_id))
    known = [(r.term, (r.category or "").strip().lower(), r.severity) for r in bounded_rows(terms.select("term", "category", "severity"), 1_000_000, "flag_terms") if r.term]
    return train([(r.text, {*r.cats} - {"none"} or {"none"}) for r in rows], known)


_OUT = pa.schema([("doc_id", pa.int64()), ("source", pa.string()), ("score", pa.float64()), ("abusive", pa.float64()), ("hateful", pa.float64()), ("sexual", pa.float64())])


def _score(model: Model, exact: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for i, source, text in zip(*(c.to_pylist() for c in b.columns)):
                d = model.document(text, exact)
                rows.append((i, source, d[""], *(d.get(k, 0.0) for k in CATEGORIES)))
            cols = list(zip(*rows)) if rows else [[] for _ in _OUT]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(cols, _OUT)], schema=_OUT)

    return run


def score_documents(docs: DataFrame, model: Model, exact: bool = True) -> DataFrame:
    """(doc_id, source, score, abusive, hateful, sexual) of every document; a category below the threshold is 0.

    Without ``exact`` scores below the threshold may be 0, which is quicker and changes no category.
    """
    return docs.select("doc_id", "source", "text").mapInArrow(_score(model, exact), "doc_id long, source string, score double, abusive double, hateful double, sexual double")


def found_categories(scores: DataFrame) -> DataFrame:
    """(doc_id, category) of each category that occurs."""
    pairs = F.array(*[F.struct(F.lit(k).alias("category"), F.col(k).alias("s")) for k in CATEGORIES])
    return scores.select("doc_id", F.explode(pairs).alias("p")).where("p.s > 0").select("doc_id", "p.category")


def source_rates(scores: DataFrame) -> DataFrame:
    """Per source the documents and the share with each category."""
    flag = lambda k: F.avg(F.when(F.col(k) > 0, 1.0).otherwise(0.0)).alias(f"{k}_rate")
    return scores.groupBy("source").agg(F.count("*").alias("n_documents"), F.avg("score").alias("mean_score"), *map(flag, CATEGORIES))
