from __future__ import annotations

import datetime as dt

import pytest
from staged import staged_df, staged_row, ts

from tidemark.operators import registry, state


def _files(spark, specs):
    rows = [staged_row(account=a, source_file=f, snapshot_date=d, snapshot_ts=t, snapshot_version=v) for a, f, d, t, v in specs]
    return staged_df(spark, rows)


def test_two_runs_late_new_account_same_file(spark):
    d = lambda n: dt.date(2024, 1, n)
    run1 = _files(spark, [("a1", "a1/f5", d(5), ts(6), 0), ("a1", "a1/f6", d(6), ts(7), 0)])
    reg1 = registry.register_snapshots(run1)
    assert [(r.source_file, r.snapshot_order_no, r.is_out_of_order) for r in reg1.orderBy("snapshot_order_no").collect()] == [
        ("a1/f5", 1, False), ("a1/f6", 2, False)]
    run2 = _files(spark, [
        ("a1", "a1/f5", d(5), ts(20), 0),   # same file again, ingested later: skipped
        ("a1", "a1/f3", d(3), ts(20), 0),   # late
        ("a1", "a1/f8", d(8), ts(20), 1),   # two files in one batch
        ("a1", "a1/f8b", d(8), ts(20), 0),
        ("b2", "b2/f1", d(1), ts(20), 0),   # new account on a later run
    ])
    new = registry.register_snapshots(run2, state=reg1)
    got = {r.source_file: (r.snapshot_order_no, r.is_out_of_order) for r in new.collect()}
    assert got == {"a1/f3": (3, True), "a1/f8b": (4, False), "a1/f8": (5, False), "b2/f1": (1, False)}
    merged = state.merge_by_key(reg1, new, ["account", "source_file"])
    assert {r.source_file for r in registry.late_snapshots(merged).collect()} == {"a1/f3"}
    latest = {r.account: r.source_file for r in registry.latest_in_order(merged).collect()}
    assert latest == {"a1": "a1/f8", "b2": "b2/f1"}


def test_sort_key_orders_versions_of_any_length(spark):
    versions = [0, 7, 9999, 10000, 99999, 100000]
    df = _files(spark, [("a1", f"a1/f{v}", dt.date(2024, 1, 1), ts(2), v) for v in versions])
    rows = registry.register_snapshots(df).orderBy("event_sort_key").collect()
    assert [r.snapshot_version for r in rows] == versions


def test_sequence_next_ts_crosses_dates(spark):
    d = lambda n: dt.date(2024, 1, n)
    df = _files(spark, [("a1", "a1/x", d(1), ts(2), 0), ("a1", "a1/y", d(1), ts(2, 1), 1), ("a1", "a1/z", d(3), ts(4), 0)])
    seq = registry.in_order_sequence(registry.register_snapshots(df)).orderBy("seq").collect()
    assert [(r.source_file, r.seq, r.next_ts) for r in seq] == [("a1/x", 1, ts(2, 1)), ("a1/y", 2, ts(4)), ("a1/z", 3, None)]


def test_merge_rejects_duplicate_source_keys(spark):
    a = spark.createDataFrame([(1, "x")], "k int, v string")
    b = spark.createDataFrame([(1, "y"), (1, "z")], "k int, v string")
    with pytest.raises(Exception):
        state.merge_by_key(a, b, ["k"]).collect()
    c = spark.createDataFrame([(1, "y"), (2, "z")], "k int, v string")
    assert sorted(state.merge_by_key(a, c, ["k"]).collect()) == [(1, "y"), (2, "z")]


DAY = dt.date(2024, 1, 1)


def at(hour):
    return dt.datetime(2024, 1, 2, hour)


def _keyed(spark, rows):
    return spark.createDataFrame(rows, "account string, source_file string, snapshot_ts timestamp, snapshot_date date, snapshot_version int")


def test_reingested_file_is_registered_once(spark):
    keyed = _keyed(spark, [("a", "f1", at(1), DAY, 1), ("a", "f1", at(3), DAY, 1), ("a", "f2", at(2), DAY, 2)])
    rows = registry.register_snapshots(keyed).orderBy("snapshot_order_no").collect()
    assert [(r.source_file, r.snapshot_order_no) for r in rows] == [("f1", 1), ("f2", 2)]


def test_old_ingest_time_and_long_version_are_kept(spark):
    state = registry.register_snapshots(_keyed(spark, [("a", "f9999", at(5), DAY, 9999)]))
    later = registry.register_snapshots(_keyed(spark, [("a", "f10000", at(1), DAY, 10000), ("a", "f1", at(1), DAY, 1)]), state)
    assert {r.source_file: r.is_out_of_order for r in later.collect()} == {"f10000": False, "f1": True}


def test_snapshots_of_one_run_have_distinct_version_times(spark):
    rows = [("a", f"f{d}", ts(40), dt.date(2024, 1, d), 0, d, False) for d in (1, 2, 3)] + [("b", "g", ts(40), dt.date(2024, 1, 1), 0, 1, False)]
    ddl = "account string, source_file string, snapshot_ts timestamp_ntz, snapshot_date date, snapshot_version int, snapshot_order_no bigint, is_out_of_order boolean"
    seq = {(r.account, r.seq): r for r in registry.in_order_sequence(spark.createDataFrame(rows, ddl)).collect()}
    times = [seq["a", k].snapshot_ts for k in (1, 2, 3)]
    assert times == [ts(40) + dt.timedelta(microseconds=k) for k in range(3)]
    assert [seq["a", k].next_ts for k in (1, 2, 3)] == [times[1], times[2], None]
    assert seq["b", 1].snapshot_ts == ts(40) and seq["b", 1].next_ts is None


def brute_effect(times):
    """Each file's time: its own, but at least a microsecond after the file before it."""
    out = []
    for t in times:
        out.append(t if not out else max(t, out[-1] + dt.timedelta(microseconds=1)))
    return out


def test_effect_times_rise_with_the_order_whatever_the_ingest_times(spark):
    import random

    r = random.Random(3)
    ddl = "account string, source_file string, snapshot_ts timestamp_ntz, snapshot_date date, snapshot_version int, snapshot_order_no bigint, is_out_of_order boolean"
    accounts = {a: [(dt.date(2024, 1, 1 + k // 3), ts(r.choice([5, 5, 9, 12]), r.randint(0, 1))) for k in range(14)] for a in "abc"}
    rows = [(a, f"f{k:02d}", t, d, 0, k + 1, False) for a, files in accounts.items() for k, (d, t) in enumerate(files)]
    want = {(a, k + 1): t for a, files in accounts.items() for k, t in enumerate(brute_effect([t for _, t in files]))}
    whole = registry.in_order_sequence(spark.createDataFrame(rows, ddl))
    got = {(x.account, x.seq): (x.snapshot_ts, x.next_ts) for x in whole.collect()}
    assert got == {k: (t, want.get((k[0], k[1] + 1))) for k, t in want.items()}
    # in two runs: the first six files of each account, then the others from its mark
    first = registry.in_order_sequence(spark.createDataFrame([x for x in rows if x[5] <= 6], ddl))
    marks = first.where("seq = 6").select("account", "seq", "snapshot_ts")
    then = registry.in_order_sequence(spark.createDataFrame([x for x in rows if x[5] > 6], ddl), marks)
    assert {(x.account, x.seq): x.snapshot_ts for x in first.union(then).collect()} == want
