"""Snapshot control plane: registry with order numbers and late flags, latest
in-order file, current state, last-run summary."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.expressions import event_sort_key
from tidemark.functions.sequence import sequence_within
from tidemark.schema import HISTORY_KEYS, TRACKED

# fixed values: first-run defaults of the per-account watermark
FIRST_RUN_ORDER_NO = 0
FIRST_RUN_SORT_KEY = "00000000-0000-"

REGISTRY_COLUMNS = [
    "account",
    "snapshot_order_no",
    "event_sort_key",
    "is_out_of_order",
    "source_file",
    "snapshot_ts",
    "snapshot_date",
    "snapshot_version",
]


def snapshot_files(keyed: DataFrame) -> DataFrame:
    """distinct snapshot files, one row each; a file that was ingested more than once has its latest time."""
    latest = [F.max(c).alias(c) for c in ("snapshot_ts", "snapshot_date", "snapshot_version")]
    return keyed.groupBy("account", "source_file").agg(*latest)


def register_snapshots(keyed: DataFrame, state: DataFrame | None = None) -> DataFrame:
    """New snapshot files with per-account order numbers and late flags.

    * accounts without state start from the first-run defaults (a left join, so
      an account first seen on a later run is not lost);
    * files already registered are skipped; every other file is taken, however
      old its ingest time is (below the account's maximum it is marked late);
    * order numbers continue the account's sequence by (date, version, file),
      numbered per (account, date) and offset by a prefix sum over dates;
    * a file is late when its sort key is below the account's earlier maximum.
    """
    files = snapshot_files(keyed)
    if state is None:
        new = files.withColumns(
            {
                "max_order_no": F.lit(FIRST_RUN_ORDER_NO).cast("bigint"),
                "max_sort_key": F.lit(FIRST_RUN_SORT_KEY),
            }
        )
    else:
        marks = state.groupBy("account").agg(
            F.max("snapshot_order_no").cast("bigint").alias("max_order_no"),
            F.max("event_sort_key").alias("max_sort_key"),
        )
        new = (
            files.join(state.select("account", "source_file"), on=["account", "source_file"], how="left_anti")
            .join(marks, on="account", how="left")
            .withColumns(
                {
                    "max_order_no": F.coalesce("max_order_no", F.lit(FIRST_RUN_ORDER_NO).cast("bigint")),
                    "max_sort_key": F.coalesce("max_sort_key", F.lit(FIRST_RUN_SORT_KEY)),
                }
            )
        )
    numbered = sequence_within(
        new,
        keys=["account"],
        bucket="snapshot_date",
        order=["snapshot_version", "source_file"],
        out="_seq",
    )
    key = event_sort_key("snapshot_date", "snapshot_version", "source_file")
    return numbered.select(
        "account",
        (F.col("max_order_no") + F.col("_seq")).cast("bigint").alias("snapshot_order_no"),
        key.alias("event_sort_key"),
        (key < F.col("max_sort_key")).alias("is_out_of_order"),
        "source_file",
        "snapshot_ts",
        "snapshot_date",
        "snapshot_version",
    )


def late_snapshots(registry: DataFrame) -> DataFrame:
    """F8: snapshots that arrived after a later one of the same account."""
    return registry.where(F.col("is_out_of_order")).select(
        "account", "source_file", "snapshot_ts", "snapshot_date", "snapshot_version", "snapshot_order_no", "event_sort_key"
    )


def latest_in_order(registry: DataFrame) -> DataFrame:
    """per account the in-order file with the highest order number.
    A grouped ``max_by`` combines map-side, so a hot account costs nothing extra."""
    return (
        registry.where(~F.col("is_out_of_order"))
        .groupBy("account")
        .agg(F.max_by("source_file", "snapshot_order_no").alias("source_file"))
    )


def current_state(keyed: DataFrame, registry: DataFrame) -> DataFrame:
    """the rows of each account's latest in-order file."""
    latest = latest_in_order(registry)
    return keyed.join(latest, on=["account", "source_file"], how="inner").select(*HISTORY_KEYS, *TRACKED, "source_file")


def last_run_summary(keyed: DataFrame, quarantine: DataFrame, registry: DataFrame) -> DataFrame:
    """per account its latest registered snapshot (late or not), the staged
    row count of that file and its quarantined row count (all buckets), zero
    when there are none."""
    latest = registry.groupBy("account").agg(
        F.max_by(
            F.struct("source_file", "snapshot_ts", "snapshot_date", "snapshot_version", "snapshot_order_no", "is_out_of_order"),
            "snapshot_order_no",
        ).alias("_l")
    ).select("account", "_l.*")
    pair = ["account", "source_file"]
    # only rows of the latest files are counted, not those of every file ever seen
    only = latest.select(*pair)
    rows = keyed.select(*pair).join(only, pair, "left_semi").groupBy(*pair).agg(F.count(F.lit(1)).alias("snapshot_rows"))
    bad = quarantine.select(*pair).join(only, pair, "left_semi").groupBy(*pair).agg(F.count(F.lit(1)).alias("quarantined_rows"))
    return latest.join(rows, on=pair, how="left").join(bad, on=pair, how="left").select(
        "account",
        "source_file",
        "snapshot_ts",
        "snapshot_date",
        "snapshot_version",
        "snapshot_order_no",
        "is_out_of_order",
        F.coalesce("snapshot_rows", F.lit(0)).cast("bigint").alias("snapshot_rows"),
        F.coalesce("quarantined_rows", F.lit(0)).cast("bigint").alias("quarantined_rows"),
    )


def latest_by_date_version(final: DataFrame) -> DataFrame:
    """rows of each account's latest file by (date, version, file), without
    a registry; joins on account and file."""
    files = final.select("account", "source_file", "snapshot_date", "snapshot_version").distinct()
    latest = files.groupBy("account").agg(
        F.max_by("source_file", F.struct("snapshot_date", "snapshot_version", "source_file")).alias("source_file")
    )
    return final.join(latest, on=["account", "source_file"], how="inner")


EPOCH = "TIMESTAMP_NTZ '1970-01-01 00:00:00'"
MICROSECOND = "INTERVAL '0.000001' SECOND"


def in_order_sequence(registry: DataFrame, marks: DataFrame | None = None) -> DataFrame:
    """In-order files numbered per account (``seq``), with the time at which each
    takes effect and that of the account's next in-order file (NULL for the latest).

    A file takes effect at its ingest time, but never before, nor together with,
    the file before it: ``max(ts of this and earlier files j, plus (i - j)
    microseconds)``.  So files that one run ingested, and files that were ingested
    again after their successors, have times that rise with ``seq``.

    ``marks`` (account, seq, snapshot_ts) is each account's last file of earlier
    runs; numbers and times continue from it.

    All of it comes from one numbering inside (account, date) and a table with one
    row per (account, date): as ``ts - seq`` only a running maximum is needed, which
    is combined over the dates.  No task holds all files of an account."""
    since = lambda c: F.col(c) - F.expr(EPOCH)  # noqa: E731  an interval, whatever the session's time zone
    us = lambda n: F.expr(MICROSECOND) * n
    files = registry.where(~F.col("is_out_of_order")).select("account", "source_file", "snapshot_date", "snapshot_order_no", since("snapshot_ts").alias("_at"))
    group = ["account", "snapshot_date"]
    w = Window.partitionBy(*group).orderBy("snapshot_order_no")
    files = files.withColumn("_rn", F.row_number().over(w))
    files = files.withColumns({
        "_peak": F.max(F.col("_at") - us(F.col("_rn"))).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
        "_next_at": F.lead("_at").over(w),
    })
    dates = files.groupBy(*group).agg(F.count(F.lit(1)).alias("_n"), F.max("_peak").alias("_top"), F.max(F.when(F.col("_rn") == 1, F.col("_at"))).alias("_first"))
    if marks is None:
        dates = dates.withColumns({"_from": F.lit(0).cast("bigint"), "_held": F.lit(None).cast("interval day to second")})
    else:
        held = marks.select("account", F.col("seq").alias("_from"), (since("snapshot_ts") - us(F.col("seq"))).alias("_held"))
        dates = dates.join(held, "account", "left").withColumn("_from", F.coalesce("_from", F.lit(0).cast("bigint")))
    d = Window.partitionBy("account").orderBy("snapshot_date")
    dates = dates.withColumn("_off", F.col("_from") + F.sum("_n").over(d) - F.col("_n"))
    earlier = F.max(F.col("_top") - us(F.col("_off"))).over(d.rowsBetween(Window.unboundedPreceding, -1))
    dates = dates.withColumn("_before", F.greatest(earlier, F.col("_held")))  # greatest() passes NULLs over
    dates = dates.withColumn("_opens", us(F.col("_off") + 1) + F.greatest(F.col("_before"), F.col("_first") - us(F.col("_off") + 1)))
    dates = dates.select(*group, "_off", "_before", F.lead("_opens").over(d).alias("_next_opens"))
    out = files.join(dates, group).withColumn("seq", F.col("_off") + F.col("_rn"))
    peak = F.greatest(F.col("_before"), F.col("_peak") - us(F.col("_off")))
    after = us(F.col("seq") + 1) + F.greatest(peak, F.col("_next_at") - us(F.col("seq") + 1))
    following = F.when(F.col("_next_at").isNotNull(), after).otherwise(F.col("_next_opens"))
    return out.select("account", "source_file", "seq", (F.expr(EPOCH) + us(F.col("seq")) + peak).alias("snapshot_ts"), (F.expr(EPOCH) + following).alias("next_ts"))


def with_effect(registry: DataFrame, sequence: DataFrame) -> DataFrame:
    """Registry rows of in-order files, ``snapshot_ts`` being the time at which they take effect."""
    times = sequence.select("account", "source_file", F.col("snapshot_ts").alias("_effect"))
    out = registry.join(times, ["account", "source_file"]).withColumn("snapshot_ts", F.col("_effect"))
    return out.select(*REGISTRY_COLUMNS)
