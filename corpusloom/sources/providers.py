"""Remote services as tables, and the live filling of those tables.

Five services: language models (text and JSON), outlinks, page metadata in
batches of titles, web search, and extraction of pages. Each is asked through
``ask_live``; structured answers travel as JSON and come back as columns.

A service that was asked once answers from its table ever after, so runs are
repeatable and a re-run task never asks twice for the same. Live calls happen
in Arrow batches, with one client per partition, attempts with growing pauses,
and the error kept as a column instead of failing the job.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.session import bounded_rows

REGISTRY = "name string, description string"


def prompt_key(prompt):
    """The key under which a prompt's reply is stored."""
    return F.sha2(prompt, 256)


def replay(requests: DataFrame, replies: DataFrame, prompt: str = "prompt") -> DataFrame:
    """``requests`` with reply and error from the table (prompt_key, reply, error); null where never asked."""
    return requests.withColumn("prompt_key", prompt_key(F.col(prompt))).join(replies.select("prompt_key", "reply", "error"), "prompt_key", "left")


def unanswered(requests: DataFrame, replies: DataFrame, prompt: str = "prompt") -> DataFrame:
    """Distinct prompts that have no reply yet: what a live run has to ask."""
    keyed = requests.select(prompt_key(F.col(prompt)).alias("prompt_key"), F.col(prompt).alias("prompt")).dropDuplicates(["prompt_key"])
    return keyed.join(replies.where("error is null").select("prompt_key"), "prompt_key", "left_anti")


def attempt(call: Callable[[str], str], request: str, tries: int = 3, pause: Callable[[int], float] = lambda k: 2.0**k, sleep: Callable[[float], None] = time.sleep) -> tuple[str | None, str | None]:
    """(reply, error) after at most ``tries`` calls; an exception may carry retry_after seconds. An empty reply is an error."""
    for k in range(tries):
        try:
            reply = (call(request) or "").strip()
            if reply:
                return reply, None
            error, wait = "empty reply", pause(k)
        except Exception as e:  # the error is data here
            error, wait = f"{type(e).__name__}: {e}", getattr(e, "retry_after", None)
            if getattr(e, "final", False):
                break
            wait = pause(k) if wait is None else float(wait)
        if k + 1 < tries:
            sleep(wait)
    return None, error


def ask_live(
    requests: DataFrame, make_client: Callable[[], Callable[[str], object]], workers: int, tries: int = 3, gap: float = 0.0, pause: Callable[[int], float] = lambda k: 2.0**k
) -> DataFrame:
    """(prompt_key, reply, error) for every request (prompt_key, prompt), at most ``workers`` calls at a time.

    ``make_client`` is called once per partition and gives the function that
    asks; what it returns is kept as text, or as JSON if it is no text. ``gap``
    is a pause after each success, ``pause`` the wait before each further
    attempt. A failed request has an error and stops no other. Write the result
    before reading it more than once.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        client = make_client()

        def call(prompt: str) -> str:
            got = client(prompt)
            return got if got is None or isinstance(got, str) else json.dumps(got, ensure_ascii=False)

        for b in batches:
            out = []
            for prompt in b.column("prompt").to_pylist():
                out.append(attempt(call, prompt, tries, pause))
                if gap and out[-1][1] is None:
                    time.sleep(gap)
            yield pa.RecordBatch.from_arrays([b.column("prompt_key"), pa.array([r for r, _ in out], pa.string()), pa.array([e for _, e in out], pa.string())], names=["prompt_key", "reply", "error"])

    return requests.select("prompt_key", "prompt").repartition(workers).mapInArrow(run, "prompt_key string, reply string, error string")


def asked(values: DataFrame, column: str) -> DataFrame:
    """(prompt_key, prompt) of the distinct values of ``column``."""
    return values.where(F.col(column).isNotNull()).select(F.col(column).alias("prompt")).distinct().select(prompt_key(F.col("prompt")).alias("prompt_key"), "prompt")


def _answers(requests: DataFrame, make_client, workers: int, kind: str, **options) -> DataFrame:
    """(prompt, answer of type ``kind``, error), one row a request."""
    live = ask_live(requests, make_client, workers, **options)
    answer = F.from_json("reply", f"struct<v: {kind}>")["v"]
    wrapped = live.withColumn("reply", F.concat(F.lit('{"v": '), F.col("reply"), F.lit("}")))
    done = wrapped.join(requests, "prompt_key").select("prompt", answer.alias("answer"), "error", "reply")
    return done.select("prompt", "answer", F.when(F.col("error").isNull() & F.col("answer").isNull(), F.lit("unreadable answer")).otherwise(F.col("error")).alias("error"))


def _crawl_pause(k: int) -> float:
    return 5.0 * 2.0**k


def fetch_pages(continued: Callable[[str, dict], dict], title: str) -> list[str]:
    """All outlinks of one title, following continuation tokens until there are none."""
    found, token = [], {}
    while True:
        data = continued(title, token)
        page = next(iter(data.get("pages", {}).values()), {})
        found += [x["title"] for x in page.get("links", [])]
        token = data.get("continue")
        if not token:
            return found


def outlinks(titles: DataFrame, make_client: Callable[[], Callable[[str, dict], dict]], workers: int, gap: float = 0.25, tries: int = 6, pause: Callable[[int], float] = _crawl_pause) -> DataFrame:
    """(src, ord, dst, error) of every title: its links in their order, or one row with the error."""

    def client():
        continued = make_client()
        return lambda title: fetch_pages(continued, title)

    got = _answers(asked(titles, "title"), client, workers, "array<string>", tries=tries, gap=gap, pause=pause)
    return got.select(F.col("prompt").alias("src"), F.posexplode_outer("answer").alias("ord", "dst"), "error").select("src", F.col("ord").cast("long").alias("ord"), "dst", "error").where("dst is not null or error is not null")


def page_infos(titles: DataFrame, make_client: Callable[[], Callable[[list[str]], list[dict]]], workers: int, size: int = 50, gap: float = 0.25, tries: int = 6, pause: Callable[[int], float] = _crawl_pause) -> DataFrame:
    """(title, summary, categories, error), asked for ``size`` titles at a time; titles without an answer have no row."""
    from corpusloom.operators.ranking import fixed_batches

    batches = fixed_batches(titles.where("title is not null").select("title").distinct(), ["title"], size).groupBy("batch_no").agg(F.array_sort(F.collect_list("title")).alias("t"))

    def client():
        ask = make_client()
        return lambda prompt: ask(json.loads(prompt))

    got = _answers(asked(batches.select(F.to_json("t").alias("titles")), "titles"), client, workers, "array<struct<title: string, summary: string, categories: array<string>>>", tries=tries, gap=gap, pause=pause)
    return got.select(F.inline_outer("answer"), "error").where("title is not null or error is not null")


def searches(queries: DataFrame, make_client: Callable[[], Callable[[str], list[dict]]], workers: int, tries: int = 3) -> DataFrame:
    """(query, results, error) of every distinct query; results as the provider ranks them, empty with an error."""
    got = _answers(asked(queries, "query"), make_client, workers, "array<struct<url: string, title: string, score: double, reason: string>>", tries=tries)
    return got.select(F.col("prompt").alias("query"), F.coalesce("answer", F.array().cast("array<struct<url: string, title: string, score: double, reason: string>>")).alias("results"), "error")


def extractions(urls: DataFrame, make_client: Callable[[], Callable[[str], list[dict]]], workers: int, tries: int = 3) -> DataFrame:
    """(url, pos, title, text, error) of every distinct address, one row for each text that was extracted, or the error."""
    got = _answers(asked(urls, "url"), make_client, workers, "array<struct<title: string, text: string>>", tries=tries)
    return got.select(F.col("prompt").alias("url"), F.posexplode_outer("answer").alias("pos", "x"), "error").select("url", "pos", "x.title", "x.text", "error").where("pos is not null or error is not null")


PROVIDERS: dict[str, Callable[[], Callable[[str], object]]] = {}


def provider(name: str) -> Callable[[], Callable[[str], object]]:
    """The registered maker of clients of that name, or an error that lists the known ones."""
    if name not in PROVIDERS:
        raise ValueError(f"no provider {name!r}; known: {', '.join(sorted(PROVIDERS)) or 'none'}")
    return PROVIDERS[name]


def load_registry(spark: SparkSession, path: str) -> DataFrame:
    """A registry of named entries from a JSON array of objects or strings."""
    rows = json.loads(Path(path).read_text(encoding="utf-8"))
    pairs = [(r, None) if isinstance(r, str) else (r.get("name"), r.get("description")) for r in rows]
    return spark.createDataFrame(pairs, REGISTRY)


def save_registry(df: DataFrame, path: str, most: int = 100_000) -> None:
    """A registry as a JSON array; it is a small dimension, a larger one is an error."""
    rows = [r.asDict() for r in bounded_rows(df.select("name", "description"), most, "registry")]
    Path(path).write_text(json.dumps(rows, ensure_ascii=False, indent=2), encoding="utf-8")
