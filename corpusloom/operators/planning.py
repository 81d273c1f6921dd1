"""Include decisions: reading, validating, defaults, and the split they cause."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.replies import json_variant

ITEM = "array<struct<name:string,priority:int>>"
DECISION = f"struct<include:boolean,expand:boolean,entity_type:struct<name:string,subtype:string>,information_to_collect:{ITEM},reason:string>"

# The permissive decision that stands in for a missing or invalid one.
DEFAULT_TYPE = "Cultural Entity"
DEFAULT_ITEMS = (("overview", 5), ("history", 4), ("cultural significance", 4))
DEFAULT_REASON = "No usable decision, kept so that nothing is lost."


def parse_decision(reply: Column) -> Column:
    """A decision struct from a reply, scalars coerced leniently; null if it holds no JSON object."""
    v = json_variant(reply)
    get = lambda path, kind: F.try_variant_get(v, path, kind)
    decision = F.struct(
        get("$.include", "boolean").alias("include"),
        get("$.expand", "boolean").alias("expand"),
        F.struct(get("$.entity_type.name", "string").alias("name"), get("$.entity_type.subtype", "string").alias("subtype")).alias("entity_type"),
        get("$.information_to_collect", ITEM).alias("information_to_collect"),
        get("$.reason", "string").alias("reason"),
    )
    return F.when(v.isNotNull() & F.startswith(F.schema_of_variant(v), F.lit("OBJECT")), decision)


def is_valid(include: Column, expand: Column, entity_type: Column, items: Column, reason: Column) -> Column:
    """Every required part is there and every priority is from 1 to 5; a null list counts as empty."""
    fine = F.forall(items, lambda i: F.coalesce(i["name"].isNotNull() & i["priority"].between(1, 5), F.lit(False)))
    return include.isNotNull() & expand.isNotNull() & entity_type.isNotNull() & entity_type["name"].isNotNull() & reason.isNotNull() & F.coalesce(fine, F.lit(True))


def with_validity(decisions: DataFrame) -> DataFrame:
    return decisions.withColumn("valid", is_valid(*(F.col(c) for c in ("include", "expand", "entity_type", "information_to_collect", "reason"))))


def with_fallback(decisions: DataFrame) -> DataFrame:
    """Invalid decisions replaced as a whole by the permissive default; a column valid tells which."""
    items = F.array(*[F.struct(F.lit(n).alias("name"), F.lit(p).alias("priority")) for n, p in DEFAULT_ITEMS]).cast(ITEM)
    kind = F.struct(F.lit(DEFAULT_TYPE).alias("name"), F.lit(None).cast("string").alias("subtype"))
    default = {"include": F.lit(True), "expand": F.lit(True), "entity_type": kind, "information_to_collect": items, "reason": F.lit(DEFAULT_REASON)}
    checked = with_validity(decisions)
    return checked.withColumns({c: F.when(F.col("valid"), F.col(c)).otherwise(d) for c, d in default.items()}).withColumn(
        "information_to_collect", F.coalesce("information_to_collect", F.array().cast(ITEM))
    )


def split(decided: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(kept, rejected) by include; together they are the input."""
    return decided.where("include"), decided.where("not include")


def quarantine(replies: DataFrame, reply: str = "reply") -> DataFrame:
    """Rows whose reply holds no JSON, to be appended to a table of bad replies."""
    return replies.where(json_variant(F.col(reply)).isNull())


def counters(decided: DataFrame) -> DataFrame:
    """One row: planned, included, excluded, fallbacks."""
    return decided.agg(
        F.count("*").alias("n_planned"), F.count_if(F.col("include")).alias("n_included"), F.count_if(~F.col("include")).alias("n_excluded"), F.count_if(~F.col("valid")).alias("n_fallback")
    )
