"""Landing paths derived from ``events`` and parsed back.

One path per event row, as a landing folder would hold it (percent-encoded):
``landing/AccountName=<account>/snap_<account>_<ddMMyyyy>_<version>.csv``.
Variants per account: plain, with an underscore, with a space, with a plus.
Per row: a day of ``00`` (bad date) every 11th event, no version part on view
events, version 10000 every 13th event.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.expressions import account_from_path, date_from_file_name, file_name, version_from_file_name
from tidemark.sources.tables import load_table


def _account_variants(user_id: Column) -> tuple[Column, Column]:
    """(raw account name, its percent-encoded form)."""
    base = F.lpad((user_id % 20).cast("string"), 2, "0")
    v = user_id % 4
    raw = (
        F.when(v == 1, F.concat(F.lit("acct"), base, F.lit("_x")))
        .when(v == 2, F.concat(F.lit("acct "), base))
        .when(v == 3, F.concat(F.lit("acct+"), base))
        .otherwise(F.concat(F.lit("acct"), base))
    )
    enc = (
        F.when(v == 2, F.concat(F.lit("acct%20"), base))
        .when(v == 3, F.concat(F.lit("acct%2B"), base))
        .otherwise(raw)
    )
    return raw, enc


def landing_paths(events: DataFrame) -> DataFrame:
    raw, enc = _account_variants(F.col("user_id"))
    eid = F.col("event_id")
    day = F.when(eid % 11 == 0, F.lit("00")).otherwise(F.date_format("ts", "dd"))
    date_txt = F.concat(day, F.date_format("ts", "MMyyyy"))
    version = F.when(eid % 13 == 0, F.lit(10000)).otherwise(eid % 3).cast("string")
    tail = F.when(F.col("event_type") == "view", F.lit("")).otherwise(F.concat(F.lit("_"), version))
    name = F.concat(F.lit("snap_"), enc, F.lit("_"), date_txt, tail, F.lit(".csv"))
    return events.select(
        F.concat(F.lit("landing/AccountName="), enc, F.lit("/"), name).alias("path"),
        eid.alias("record_id"),
    )


def with_path_parts(df: DataFrame, path: str = "path") -> DataFrame:
    """File name, account, snapshot date and version from a path."""
    name = file_name(path)
    return df.select(
        "*",
        name.alias("file_name"),
        account_from_path(path).alias("account"),
        date_from_file_name(name).alias("snapshot_date"),
        version_from_file_name(name).alias("snapshot_version"),
    )


def path_parts(spark: SparkSession, data_dir: str) -> DataFrame:
    return with_path_parts(landing_paths(load_table(spark, data_dir, "events")))
