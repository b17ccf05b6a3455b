"""Ownership features over history and first-seen rows.

All are plain aggregates and windows over the SCD2 view and first-seen rows;
``as_of`` is passed as a one-row table (no clock inside a compared query).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.schema import ENTITY_KEYS


def deletions(scd2: DataFrame, keys: Sequence[str] = ENTITY_KEYS) -> DataFrame:
    """Versions that ended because the entity left its account: closed, and the
    entity's next version (if any) does not start at that moment."""
    w = Window.partitionBy(*keys).orderBy("valid_from", "scd_id")
    nxt = F.lead("valid_from").over(w)
    return (
        scd2.select(*keys, "type_key", "valid_from", "valid_to", "scd_id", nxt.alias("_next_from"))
        .where(F.col("valid_to").isNotNull() & (F.col("_next_from").isNull() | (F.col("_next_from") != F.col("valid_to"))))
        .select(*keys, "type_key", "scd_id", F.col("valid_to").alias("deleted_ts"))
    )


def reappearances(scd2: DataFrame, keys: Sequence[str] = ENTITY_KEYS) -> DataFrame:
    """Versions that start after a gap in which the entity was absent."""
    w = Window.partitionBy(*keys).orderBy("valid_from", "scd_id")
    prev_to = F.lag("valid_to").over(w)
    return (
        scd2.select(*keys, "type_key", "valid_from", "scd_id", prev_to.alias("_prev_to"))
        .where(F.col("_prev_to").isNotNull() & (F.col("_prev_to") != F.col("valid_from")))
        .select(
            F.col("scd_id").alias("event_id"),
            *keys,
            "type_key",
            F.col("_prev_to").alias("absent_from"),
            F.col("valid_from").alias("event_ts"),
        )
    )


def first_seen_features(first_seen: DataFrame, scd2: DataFrame, as_of: DataFrame, key: str = "type_key") -> DataFrame:
    """J4-J6 per (account, type): days since first seen, first-seen cohort
    month, first deletion time, days to it, and the number of deletions."""
    dels = deletions(scd2).groupBy("account", key).agg(
        F.min("deleted_ts").alias("first_deleted_ts"), F.count(F.lit(1)).alias("delete_count")
    )
    fs = first_seen.select("account", key, "first_seen_ts").crossJoin(F.broadcast(as_of.select("as_of_ts")))
    return fs.join(dels, on=["account", key], how="left").select(
        "account",
        key,
        "first_seen_ts",
        F.datediff(F.col("as_of_ts"), F.col("first_seen_ts")).alias("days_since_first_seen"),
        F.trunc(F.to_date("first_seen_ts"), "month").alias("first_seen_cohort"),
        "first_deleted_ts",
        F.datediff(F.col("first_deleted_ts"), F.col("first_seen_ts")).alias("days_to_first_delete"),
        F.coalesce(F.col("delete_count"), F.lit(0)).cast("bigint").alias("delete_count"),
    )


def collection_breadth(first_seen: DataFrame, key: str = "type_key") -> DataFrame:
    """Per account and first-seen cohort month, the types first seen then,
    and the account's breadth (distinct types ever seen)."""
    w = Window.partitionBy("account")
    by_cohort = first_seen.groupBy("account", F.trunc(F.to_date("first_seen_ts"), "month").alias("first_seen_cohort")).agg(
        F.count_distinct(key).alias("new_types")
    )
    return by_cohort.withColumn("breadth", F.sum("new_types").over(w).cast("bigint"))
