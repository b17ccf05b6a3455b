"""Staging: rename and round, first-match quarantine, and in-file dedupe."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.expressions import false_if_null
from tidemark.functions.rules import DATA_BUCKETS, DEFAULT_RULES, Rule, ladder
from tidemark.schema import LINEAGE_COLUMNS, ROUND_TO_2, ROUND_TO_INT, STAGED_COLUMNS, STAGED_NAMES

# fixed value: reason given to dedupe losers
DUPLICATE_REASON = "DUPLICATE_KEY:account+entity_id+source_file"
DEDUPE_KEYS = ["account", "entity_id", "source_file"]
FLAG_COLUMNS = [
    "quarantine_reason",
    "quarantine_bucket",
    "is_quarantined",
    "is_quarantined_key",
    "is_quarantined_data",
    "is_quarantined_lineage",
]


def rename(df: DataFrame, mapping: Mapping[str, str] = STAGED_NAMES, keep: Sequence[str] = ()) -> DataFrame:
    """Project to the renamed columns (plus the lineage columns and ``keep``)."""
    cols = [F.col(src).alias(dst) for src, dst in mapping.items()]
    cols += [F.col(c) for c in LINEAGE_COLUMNS if c in df.columns]
    cols += [F.col(c) for c in keep]
    return df.select(*cols)


def normalise(df: DataFrame, to_int: Sequence[str] = ROUND_TO_INT, to_2: Sequence[str] = ROUND_TO_2) -> DataFrame:
    """Round stats: whole-number ones to int (half up), the rest to 2 places."""
    repl = {c: F.round(F.col(c), 0).cast("int") for c in to_int}
    repl.update({c: F.round(F.col(c), 2) for c in to_2})
    return df.withColumns(repl)


def stage(bronze: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Bronze rows to the staged contract (D1 + D2)."""
    return normalise(rename(bronze, keep=keep)).select(*STAGED_COLUMNS, *keep)


def classify(df: DataFrame, rules: Sequence[Rule] = DEFAULT_RULES) -> DataFrame:
    """Add reason, bucket and the four quarantine flags (first failing rule wins)."""
    hit = ladder(rules)
    out = df.withColumn("_q", hit)
    bucket = F.col("_q.bucket")
    return out.select(
        *[F.col(c) for c in df.columns],
        F.col("_q.reason").alias("quarantine_reason"),
        bucket.alias("quarantine_bucket"),
        F.col("_q").isNotNull().alias("is_quarantined"),
        false_if_null(bucket == "KEY").alias("is_quarantined_key"),
        false_if_null(bucket.isin(*DATA_BUCKETS)).alias("is_quarantined_data"),
        false_if_null(bucket == "LINEAGE").alias("is_quarantined_lineage"),
    )


def valid(classified: DataFrame) -> DataFrame:
    return classified.where(~F.col("is_quarantined"))


def quarantined(classified: DataFrame) -> DataFrame:
    """Quarantined rows with the reason under the name ``failure_reason``."""
    return classified.where(F.col("is_quarantined")).withColumnRenamed("quarantine_reason", "failure_reason")


def dedupe_order(tiebreak: str | None = None) -> list[Column]:
    """Newest version, then newest ingest, then latest run, then a tie-break
    column (for example a source row id); without one the other staged columns
    decide, greatest first, so that only equal rows tie."""
    first = ["snapshot_version", "snapshot_ts", "run_id"]
    more = [tiebreak] if tiebreak else [c for c in STAGED_COLUMNS if c not in (*first, *DEDUPE_KEYS)]
    return [F.col(c).desc_nulls_last() for c in [*first, *more]]


def rank_duplicates(df: DataFrame, keys: Sequence[str] = DEDUPE_KEYS, order: Sequence[Column] | None = None) -> DataFrame:
    """Row number and group size per duplicate group; both windows share one
    partitioning, so Spark runs them off one shuffle and one sort."""
    order = list(order or dedupe_order())
    w = Window.partitionBy(*keys)
    return df.withColumn("rn", F.row_number().over(w.orderBy(*order))).withColumn("dup_count", F.count(F.lit(1)).over(w))


def dedupe_winners(df: DataFrame, keys: Sequence[str] = DEDUPE_KEYS, order: Sequence[Column] | None = None) -> DataFrame:
    """One row per key.  With row_number as the only window and ``rn = 1``
    Spark plans a WindowGroupLimit, which also trims rows before the shuffle."""
    order = list(order or dedupe_order())
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def dedupe_losers(ranked: DataFrame) -> DataFrame:
    """Rows beaten by a duplicate, with reason, group size and row number."""
    return ranked.where((F.col("dup_count") > 1) & (F.col("rn") > 1)).select(
        *[c for c in ranked.columns if c not in ("rn", "dup_count")],
        F.lit(DUPLICATE_REASON).alias("failure_reason"),
        F.col("dup_count").alias("duplicate_group_count"),
        F.col("rn").alias("duplicate_row_number"),
    )
