"""Incremental runs over the fixture: state from a first run, a second run on
top, merged — compared with one full computation.

Two-run arrival of the snapshot files (all files arrive, none is dropped):
* the cut date is the midpoint of the snapshot dates;
* run 1 brings the files dated on or before the cut, except those whose day of
  month is a multiple of 5, which are held back;
* run 2 brings everything else; held-back files are ingested then, 100 days
  after their normal ingest time, so they register as late.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import events, identity, registry, state
from tidemark.operators.store import Layout, Store
from tidemark.plans.runs import open_store, run_batch
from tidemark.session import scratch_path, write_layer

# fixed values of the two-run scenario
HELD_BACK_DAY_MULTIPLE = 5
LATE_INGEST_DELAY_DAYS = 100
REGISTRY_KEYS = ["account", "source_file"]


def cut_date(keyed: DataFrame) -> DataFrame:
    """One row: the midpoint of the snapshot dates (a global aggregate)."""
    lo, hi = F.min("snapshot_date"), F.max("snapshot_date")
    return keyed.agg(F.date_add(lo, (F.datediff(hi, lo) / 2).cast("int")).alias("cut"))


def two_runs(keyed: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows of run 1, rows as seen by run 2 with late ingest times, cut row)."""
    cut = cut_date(keyed)
    tagged = keyed.crossJoin(F.broadcast(cut))
    early = F.col("snapshot_date") <= F.col("cut")
    held = early & (F.dayofmonth("snapshot_date") % HELD_BACK_DAY_MULTIPLE == 0)
    run1 = tagged.where(early & ~held).drop("cut")
    shifted = F.when(held, F.col("snapshot_ts") + F.expr(f"INTERVAL {LATE_INGEST_DELAY_DAYS} DAYS")).otherwise(
        F.col("snapshot_ts")
    )
    run2 = tagged.withColumn("snapshot_ts", shifted).drop("cut")
    return run1, run2, cut


def registry_two_runs(keyed: DataFrame) -> DataFrame:
    run1, run2, _ = two_runs(keyed)
    reg1 = registry.register_snapshots(run1)
    new = registry.register_snapshots(run2, state=reg1)
    return state.merge_by_key(reg1, new, REGISTRY_KEYS)


def late_snapshots(keyed: DataFrame) -> DataFrame:
    return registry.late_snapshots(registry_two_runs(keyed))


def registry_roundtrip(spark: SparkSession, keyed: DataFrame) -> DataFrame:
    """Run 1 commits the registry; run 2 reads what its accounts touch,
    merges its new files and commits; the result is read back from the store."""
    store = Store(spark, scratch_path(spark, "registry-state"), {"registry": Layout("account", ("source_file",))})
    run1, run2, _ = two_runs(keyed)
    for rows in (run1, run2):
        change = store.begin()
        change.merge("registry", registry.register_snapshots(rows, state=change.rows_of("registry", rows)), REGISTRY_KEYS)
        change.commit()
    return store.read("registry")


def first_seen_two_runs(keyed: DataFrame) -> DataFrame:
    """E7 incrementally: state from run 1, then run 2 with per-account
    watermarks and an anti join on pairs already seen."""
    run1, run2, _ = two_runs(keyed)
    reg1 = registry.register_snapshots(run1)
    seen1 = identity.first_seen(run1, reg1)
    reg = state.merge_by_key(reg1, registry.register_snapshots(run2, state=reg1), REGISTRY_KEYS)
    new = identity.first_seen(run2, reg, state=seen1)
    return state.merge_by_key(seen1, new, ["account", "type_key"])


def _history_cut(scd2: DataFrame, keyed: DataFrame) -> DataFrame:
    """Versions that had started by the cut (the history a run at the cut saw)."""
    cut = cut_date(keyed).select(F.date_add("cut", 1).cast("timestamp_ntz").alias("cut_ts"))
    return scd2.crossJoin(F.broadcast(cut)).where(F.col("valid_from") <= F.col("cut_ts")).drop("cut_ts")


def upgrades_incremental(scd2: DataFrame, keyed: DataFrame) -> DataFrame:
    """G8-G13 incrementally: events of the earlier history as state, then all
    versions after the state's latest event time, merged on event_id."""
    prior = events.upgrade_events(_history_cut(scd2, keyed))
    new = events.upgrade_events(scd2, cutoff=events.event_cutoff(prior))
    return state.merge_by_key(prior, new, ["event_id"])


def obtained_incremental(scd2: DataFrame, keyed: DataFrame) -> DataFrame:
    prior = events.first_version_events(_history_cut(scd2, keyed))
    new = events.first_version_events(scd2, cutoff=events.event_cutoff(prior))
    return state.merge_by_key(prior, new, ["event_id"])


def stored_runs(spark: SparkSession, bronze: DataFrame, tiebreak: str | None) -> Store:
    """Three runs over the store: the files up to a third of the dates, up to two thirds, and the
    others.  The last run gets all rows once more; what is registered is skipped.

    The bronze rows are written first: each run's rules and cuts read columns then, where the
    optimiser would copy the expressions that make a column into every rule that reads it."""
    bronze = write_layer(spark, bronze, "runs-bronze")
    store = open_store(spark, scratch_path(spark, "runs"), coarse=4, fine=2)
    lo, hi = F.min("snapshot_date"), F.max("snapshot_date")
    third = (F.datediff(hi, lo) / 3).cast("int")
    cuts = bronze.agg(F.date_add(lo, third).alias("first"), F.date_add(lo, third * 2).alias("second"))
    tagged = bronze.crossJoin(F.broadcast(cuts))  # one row
    for batch in (tagged.where("snapshot_date <= first"), tagged.where("snapshot_date > first AND snapshot_date <= second"), tagged):
        run_batch(store, batch.drop("first", "second"), tiebreak)
    return store
