"""Metadata of discovered entities."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def one_page_per_title(pages: DataFrame) -> DataFrame:
    """One row per title: the greatest summary, then the greatest categories; null only if all are."""
    best = F.max(F.struct(F.coalesce("summary", F.lit("")).alias("s"), F.coalesce(F.array_join("categories", "\n"), F.lit("")).alias("k"), F.coalesce("categories", F.array().cast("array<string>")).alias("c")))
    return pages.where("title is not null").groupBy("title").agg(best.alias("b")).select("title", F.col("b.s").alias("page_summary"), F.col("b.c").alias("page_categories"))


def enrich(entities: DataFrame, pages: DataFrame) -> DataFrame:
    """Left join on the exact title; entities without a page get '' and no categories.

    Columns summary and categories of ``entities`` are replaced, all others kept.
    """
    kept = entities.drop("summary", "categories")
    return (
        kept.join(one_page_per_title(pages), "title", "left")
        .withColumn("summary", F.coalesce("page_summary", F.lit("")))
        .withColumn("categories", F.coalesce("page_categories", F.array().cast("array<string>")))
        .drop("page_summary", "page_categories")
    )
