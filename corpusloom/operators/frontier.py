"""Bounded breadth-first expansion of an ordered link graph, all seeds at once.

One level is one pass: frontier joined with links, blocked titles filtered,
titles already seen removed by an anti join, every new title claimed by its
earliest parent. Ranks follow the order in which a queue would serve the
titles, so cutting at a seed's limit keeps exactly the prefix that the queue
would have produced. A seed's frontier never exceeds its limit; the driver only
iterates over levels, at most the largest depth of any seed, and stops at the
first level that adds nothing.

A rank is the number of claims of earlier parents plus the place on the
parent's own page: claims are counted per parent first, and only these counts,
no more than a seed's limit, are summed in order. No window holds a seed's
whole level.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusloom.functions.titles import keep_title
from corpusloom.session import cut

_BROADCAST_ROWS = 200_000


def usable_seeds(seeds: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(seeds that can be expanded, the others with an error): one bad seed never stops the rest."""
    error = (
        F.when(F.coalesce(F.trim("title"), F.lit("")) == "", F.lit("no title"))
        .when(F.col("max_depth").isNull() | (F.col("max_depth") < 0), F.lit("no depth"))
        .when(F.col("entity_limit").isNull() | (F.col("entity_limit") < 0), F.lit("no limit"))
    )
    checked = seeds.withColumn("error", error)
    return checked.where("error is null").drop("error"), checked.where("error is not null")


def expand(seeds: DataFrame, links: DataFrame, keep=keep_title) -> tuple[DataFrame, DataFrame]:
    """Entities and claims of every seed.

    ``seeds`` has title, max_depth, entity_limit; ``links`` src, ord, dst.
    Entities: (seed, title, depth, parent, rank) from rank 1; a seed itself is
    never filtered and is there even with a limit of 0. Claims: (seed, parent,
    pos, child) of every expanded entity, also of children beyond the limit.
    Repeated links count once; links of equal ord are ordered by dst.
    """
    keep_column: Column = keep(F.col("dst"))
    edges = links.where(keep_column & F.col("src").isNotNull()).select("src", "ord", "dst")
    deepest, limits = seeds.agg(F.max("max_depth"), F.sum(F.greatest(F.lit(1), F.coalesce("entity_limit", F.lit(0))))).first()
    small = (limits or 0) <= _BROADCAST_ROWS
    level = seeds.select(
        F.col("title").alias("seed"), "title", F.lit(0).alias("depth"), F.lit(None).cast("string").alias("parent"), F.lit(1).cast("long").alias("rank"), F.col("max_depth"), F.col("entity_limit").cast("long").alias("most"),
        F.lit(1).cast("long").alias("total"),
    ).dropDuplicates(["seed"])
    entities, claims = level, None
    seen = level.select("seed", F.col("title").alias("dst"))
    for depth in range(1, (deepest or 0) + 1):
        # the entity that reaches the limit ends the search and is not expanded
        front = level.where((F.col("depth") < F.col("max_depth")) & (F.col("rank") < F.col("most"))).select("seed", F.col("title").alias("src"), F.col("rank").alias("prank"), "max_depth", "most", "total")
        found = edges.join(F.broadcast(front) if small else front, "src")
        first = found.groupBy("seed", "dst").agg(
            F.min(F.struct("prank", "ord", "src")).alias("claim"), F.first("max_depth").alias("max_depth"), F.first("most").alias("most"), F.first("total").alias("before")
        )
        # children beyond the limit are claimed as well, so they count as seen although they are no entities
        new = first.join(seen, ["seed", "dst"], "left_anti")
        page = Window.partitionBy("seed", "claim.src").orderBy("claim.ord", "dst")
        placed = cut(new.select("seed", F.col("dst").alias("title"), F.col("claim.src").alias("parent"), F.col("claim.prank").alias("prank"), (F.row_number().over(page) - 1).alias("pos"), "max_depth", "most", "before"), f"level-{depth}")
        if placed.isEmpty():
            break
        per_parent = placed.groupBy("seed", "prank").agg(F.count("*").alias("n"))
        earlier = F.sum("n").over(Window.partitionBy("seed").orderBy("prank").rowsBetween(Window.unboundedPreceding, -1))
        offsets = per_parent.select("seed", "prank", F.coalesce(earlier, F.lit(0)).alias("offset"))
        # ranks are consecutive, so the greatest of a level is the number of entities so far
        ranked = placed.join(F.broadcast(offsets) if small else offsets, ["seed", "prank"]).withColumn("rank", F.col("before") + F.col("offset") + F.col("pos") + 1)
        part = placed.select("seed", "parent", F.col("pos"), F.col("title").alias("child"))
        claims = part if claims is None else claims.union(part)
        level = ranked.where("rank <= most").select("seed", "title", F.lit(depth).alias("depth"), "parent", "rank", "max_depth", "most").withColumn("total", F.max("rank").over(Window.partitionBy("seed")))
        entities = entities.union(level.select(*entities.columns))
        seen = seen.union(placed.select("seed", F.col("title").alias("dst")))
    if claims is None:
        claims = entities.select("seed", "parent", F.lit(0).alias("pos"), F.col("title").alias("child")).limit(0)
    return entities.select("seed", "title", "depth", "parent", "rank"), claims
