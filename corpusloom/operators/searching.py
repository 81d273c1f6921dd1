"""Search plans: tasks, ranked results, and the reason given for each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def results(plans: DataFrame) -> DataFrame:
    """(plan_id, entity_id, task_no, information, query, result_no, url, title, score), in provider order from 0.

    Plans that are there twice count once; tasks without results have no row.
    """
    once = plans.dropDuplicates(["plan_id"])
    tasks = once.select("plan_id", "entity_id", F.posexplode("tasks").alias("task_no", "task"))
    return tasks.select("plan_id", "entity_id", "task_no", "task.information", "task.query", F.posexplode("task.results").alias("result_no", "r")).select(
        "plan_id", "entity_id", "task_no", "information", "query", "result_no", "r.url", "r.title", "r.score"
    )


def number_text(x: Column) -> Column:
    """A double as plain digits where its size allows it, without needless zeros; in exponent form elsewhere."""
    digits = F.regexp_replace(F.regexp_replace(x.cast("decimal(38,18)").cast("string"), r"0+$", ""), r"\.$", ".0")
    return F.when((x == 0) | F.abs(x).between(1e-4, 1e15), digits).otherwise(x.cast("string"))


def top_results(plans: DataFrame, k: int = 2, label: str = "Search score: ") -> DataFrame:
    """The first ``k`` results of every task with the reason; the array is cut before it is exploded."""
    cut = plans.withColumn("tasks", F.transform("tasks", lambda t: F.struct(t["information"].alias("information"), t["query"].alias("query"), F.slice(t["results"], 1, k).alias("results"))))
    return results(cut).withColumn("reason", F.concat(F.lit(label), F.coalesce(number_text(F.col("score")), F.lit("N/A"))))
