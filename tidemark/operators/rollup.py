"""Gold: per (account, type) state roll-up."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def account_type_state(
    scd2: DataFrame,
    obtained: DataFrame,
    upgrades: DataFrame,
    first_seen: DataFrame,
    lookup: DataFrame,
    key: str = "type_key",
    with_books: bool = True,
) -> DataFrame:
    """H1-H7: three pre-aggregates joined to first-seen and the lookup.

    Each input is aggregated to (account, key) before any join, so the joins
    see one row per group.  The two event aggregates join left; first-seen
    and lookup join inner as in the contract (a group without a first-seen row
    or a lookup row is dropped).  ``total_deleted`` counts versions of deleted
    entities (the flag is on every version), as its definition states.
    ``max_blessing_level`` is the largest blessing id.
    """
    g = ["account", key]
    aggs = [
        F.count_if(F.col("is_current")).cast("bigint").alias("total_owned"),
        F.count_if(F.col("is_deleted")).cast("bigint").alias("total_deleted"),
        F.max("empower_level").alias("max_empower_level"),
        F.max("blessing_id").alias("max_blessing_level"),
        F.max("rank").alias("max_rank"),
    ]
    if with_books:
        aggs.append(F.min("books_missing").alias("min_books_missing"))
    base = scd2.groupBy(*g).agg(*aggs)
    got = obtained.groupBy(*g).agg(F.count(F.lit(1)).alias("total_obtained"))
    last = upgrades.groupBy(*g).agg(F.max("event_ts").alias("last_upgraded_ts"))
    joined = (
        base.join(got, on=g, how="left")
        .join(last, on=g, how="left")
        .join(first_seen.select(*g, "first_seen_ts"), on=g, how="inner")
        .join(lookup.select(key, "name", "rarity", "affinity", "faction"), on=key, how="inner")
    )
    out = [
        "account",
        key,
        "name",
        "rarity",
        "affinity",
        "faction",
        "first_seen_ts",
        "last_upgraded_ts",
        "total_owned",
        "total_deleted",
        "total_obtained",
        "max_rank",
        "max_empower_level",
        "max_blessing_level",
    ]
    if with_books:
        out.append("min_books_missing")
    return joined.select(*out)
