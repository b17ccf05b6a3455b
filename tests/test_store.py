"""Stored tables: buckets, one commit, retention; runs over them equal one computation of all rows."""

from __future__ import annotations

import json
import os
import random

import pytest
from staged import staged_row, ts

from tidemark.operators import events, history
from tidemark.operators.store import Layout, Store
from tidemark.plans.runs import open_store, run_batch, stored_history
from tidemark.plans.silver import Silver
from tidemark.schema import BRONZE_COLUMNS, BRONZE_SCHEMA, STAGED_NAMES

ROWS = "account string, item int, v string"
LAYOUTS = {"t": Layout("account", ("item",), coarse=8, fine=2, most_folders=3), "u": Layout("account")}


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def filled(spark, tmp_path, **more):
    store = Store(spark, str(tmp_path / "store"), LAYOUTS, **more)
    change = store.begin()
    change.merge("t", spark.createDataFrame([(f"a{i % 12}", i, "old") for i in range(120)], ROWS), ["account", "item"])
    assert change.commit() == 1
    return store


def test_merge_of_one_account_rewrites_only_its_buckets(spark, tmp_path):
    store = filled(spark, tmp_path)
    before = store.tables()["t"]["buckets"]
    one = spark.createDataFrame([("a3", 3, "new"), ("a3", 999, "added")], ROWS)
    change = store.begin()
    touched = LAYOUTS["t"].of(one)
    assert len(touched) == 2
    assert rows_of(change.rows_of("t", one)) == sorted((f"a{i % 12}", i, "old") for i in range(3, 120, 12))
    change.merge("t", one, ["account", "item"])
    assert rows_of(store.read("t").where("v = 'new'")) == []  # nothing is visible before the commit
    change.commit()
    after = store.tables()["t"]["buckets"]
    assert {int(b) for b in after if after[b] != before.get(b)} <= touched
    want = {(f"a{i % 12}", i): "old" for i in range(120)} | {("a3", 3): "new", ("a3", 999): "added"}
    assert rows_of(store.read("t")) == sorted((a, i, v) for (a, i), v in want.items())
    assert len(rows_of(store.read("t", version=1))) == 120


def test_of_two_runs_from_one_version_one_commits(spark, tmp_path):
    store = filled(spark, tmp_path)
    first, second = store.begin(), store.begin()
    for change, v in ((first, "x"), (second, "y")):
        change.append("u", spark.createDataFrame([("a1", 1, v)], ROWS))
    first.commit()
    with pytest.raises(Exception):
        second.commit()
    assert rows_of(store.read("u")) == [("a1", 1, "x")] and store.versions() == [1, 2]


def test_retention_deletes_what_no_kept_version_names(spark, tmp_path):
    store = filled(spark, tmp_path, keep=2)
    for n in range(3):
        change = store.begin()
        change.merge("t", spark.createDataFrame([("a3", 3, f"v{n}")], ROWS), ["account", "item"])
        change.commit()
    assert store.versions() == [3, 4] and len(rows_of(store.read("t", 3))) == 120
    named = {f for v in (3, 4) for held in store.tables(v)["t"]["buckets"].values() for f in held}
    there = {os.path.relpath(d, store.root) for d, _, files in os.walk(store.root) if any(f.endswith(".parquet") for f in files)}
    assert there == named


def test_appends_are_compacted_and_a_repeated_merge_key_fails(spark, tmp_path):
    store = filled(spark, tmp_path)
    for n in range(6):
        change = store.begin()
        change.append("u", spark.createDataFrame([("a1", n, "x")], ROWS))
        change.append("t", spark.createDataFrame([("a1", 1000 + n, "x")], ROWS))
        change.commit()
    assert max(len(f) for f in store.tables()["t"]["buckets"].values()) <= 4
    assert [r[1] for r in rows_of(store.read("u"))] == list(range(6)) and store.read("t").count() == 126
    with pytest.raises(Exception, match="duplicate merge key"):
        store.begin().merge("t", spark.createDataFrame([("a3", 3, "p"), ("a3", 3, "q")], ROWS), ["account", "item"])
    assert json.dumps(store.tables())  # the manifest is plain data


def snapshots(seed):
    """Full snapshots of three accounts, some on the same day of a run, with entities that come, go and return."""
    r = random.Random(seed)
    out = []
    for account in ("a1", "a2", "a3"):
        for day in range(1, 13):
            if r.random() < 0.25:
                continue
            ents = {e: r.choice([1, 1, 2, 3, 4]) for e in range(1, 6) if r.random() < 0.7}
            out.append((account, day, ents))
    return out


def bronze_of(spark, snaps, run_of):
    rows = []
    for account, day, ents in snaps:
        for e, rank in ents.items():
            rows.append(staged_row(account=account, entity_id=e, rank=rank, source_type_id=10 * e + 1, name=f"Type {e}", source_file=f"{account}/d{day:02d}", snapshot_ts=run_of(day), snapshot_date=ts(day).date()))
    back = {v: k for k, v in STAGED_NAMES.items()}
    named = [{back.get(k, k): (float(v) if k in ("hp", "atk", "def") else v) for k, v in row.items()} | {"_rescued_data": None} for row in rows]
    return spark.createDataFrame([tuple(x[c] for c in BRONZE_COLUMNS) for x in named], BRONZE_SCHEMA)


@pytest.mark.parametrize("seed", [1, 2])
def test_runs_equal_one_computation(spark, tmp_path, seed):
    snaps = snapshots(seed)
    run_of = lambda day: ts(20 + (day - 1) // 4)  # noqa: E731  four days' snapshots arrive together
    whole = Silver(bronze_of(spark, snaps, run_of))
    store = open_store(spark, str(tmp_path / "runs"), coarse=3, fine=2)
    for k in range(3):
        batch = [x for x in snaps if (x[1] - 1) // 4 == k]
        run_batch(store, bronze_of(spark, batch, run_of))
    again = store.tables()
    run_batch(store, bronze_of(spark, [x for x in snaps if x[1] <= 4], run_of))  # nothing new
    same = lambda a, b: rows_of(a.select(sorted(a.columns)).na.fill("-")) == rows_of(b.select(sorted(b.columns)).na.fill("-"))
    text = lambda df: df.select(*[df[c].cast("string") for c in df.columns])
    assert same(text(stored_history(store)), text(whole.scd2))
    assert whole.scd2.where("is_deleted").count() or seed
    for name, df in (("obtained", whole.obtained), ("upgrades", whole.upgrades), ("gold", whole.gold), ("registry", whole.registry), ("first_seen", whole.first_seen)):
        assert same(text(store.read(name)), text(df)), name
    assert set(again) == set(store.tables())
    assert same(text(events.upgrade_events(whole.scd2, cutoff=events.event_cutoff(None))), text(whole.upgrades))
    ids = [r.scd_id for r in whole.scd2.collect()]
    assert len(ids) == len(set(ids)) and whole.scd2.where("valid_to <= valid_from").count() == 0
    assert history.valid_at(whole.history, ts_col(ts(21, 1))).count() <= whole.history.count()


def test_runs_start_from_written_bronze_rows(spark, tmp_path, monkeypatch):
    """What makes a bronze column is evaluated once, not in each rule of each run that reads the column."""
    from tidemark.plans import incremental

    batches = []
    monkeypatch.setattr(incremental, "run_batch", lambda store, batch, tiebreak: batches.append(batch))
    bronze = bronze_of(spark, snapshots(3), lambda day: ts(20 + (day - 1) // 4))
    incremental.stored_runs(spark, bronze, None)
    assert len(batches) == 3
    for batch in batches:
        assert batch.columns == bronze.columns
        assert batch.inputFiles() and all("/runs-bronze-" in f for f in batch.inputFiles())
    assert [rows_of(batches[2].select("source_file", "ID"))] == [rows_of(bronze.select("source_file", "ID"))]
    assert batches[0].count() and batches[1].count() and batches[0].count() + batches[1].count() < batches[2].count()


def ts_col(t):
    from pyspark.sql import functions as F

    return F.lit(t).cast("timestamp_ntz")
