from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tidemark.operators import expect


def test_checks_and_summary(spark):
    df = spark.createDataFrame(
        [(1, "a", 5), (1, "a", None), (2, None, -1), (None, "c", 3)], "k int, s string, v int"
    )
    nn = {r.column_name: r.failures for r in expect.not_null(df, ["k", "s", "v"]).collect()}
    assert nn == {"k": 1, "s": 1, "v": 1}
    assert [tuple(r) for r in expect.unique(df, ["k"]).collect()] == [(1, 2)]
    assert expect.unique(df, ["k", "s"], where="v IS NOT NULL").count() == 0
    assert [tuple(r) for r in expect.accepted_values(df, "v", [3, 5]).collect()] == [(-1, 1)]
    ref = spark.createDataFrame([(1,)], "k int")
    assert [r.k for r in expect.relationship(df, "k", ref, "k").collect()] == [2]
    assert expect.expression_is_true(df, ">= 0", column="v").count() == 1
    assert expect.expression_is_true(df, ">= 0", column="v", null_is_failure=True).count() == 2


def test_declared_checks_read_a_layer_once(spark):
    a = spark.createDataFrame([(1, "a", 5), (1, "a", None), (2, None, -1), (None, "c", 3), (3, "d", 3)], "k int, s string, v int")
    b = spark.createDataFrame([(1,), (3,), (None,)], "k int")
    d = expect.Declared
    declared = {
        "a": [
            d("k_once", keys=("k",)), d("k_once_where", keys=("k",), where="v IS NOT NULL"), d("sv_once", keys=("s", "v")),
            d("v_ok", expect.WARN, fails="NOT (v >= 0)"), d("s_present", fails="s IS NULL"), d("k_in_b", keys=("k",), parent=("b", "k")),
        ],
        "b": [d("none", fails="k > 9")],
    }
    out = expect.evaluate({"a": a, "b": b}, declared)
    got = {(r.layer, r.check_name): (r.failures, r.status) for r in out.collect()}
    assert got == {
        ("a", "k_once"): (1, "fail"), ("a", "k_once_where"): (0, "pass"), ("a", "sv_once"): (0, "pass"), ("a", "v_ok"): (1, "warn"),
        ("a", "s_present"): (1, "fail"), ("a", "k_in_b"): (1, "fail"), ("b", "none"): (0, "pass"),
    }


def test_every_rule_of_the_ladder_fires_in_the_summary_of_a_damaged_layer(spark):
    """Each declared row check of the cleaned rows fails on a row damaged for it, and on that row only."""
    from staged import staged_df, staged_row

    from tidemark.plans.declared import DECLARED

    checks = [c for c in DECLARED["final"] if c.fails]
    damage = {"faction_in_range": {"faction": 19}, "level_within_rank": {"level": 31}, "spd_not_negative": {"spd": -1.0}}
    rows = [staged_row(entity_id=0)]
    for i, c in enumerate(checks, 1):
        column = c.name.rsplit("_present", 1)[0].rsplit("_accepted", 1)[0].rsplit("_not_negative", 1)[0]
        over = damage.get(c.name) or {column: None if c.name.endswith("_present") else "9.9" if column == "schema_version" else 9 if c.name.endswith("_accepted") else -1}
        rows.append(staged_row(**({"entity_id": i} | over)))
    out = expect.evaluate({"final": staged_df(spark, rows)}, {"final": checks})
    assert {r.check_name: r.failures for r in out.collect()} == {c.name: 1 for c in checks}


def test_files_are_pruned_by_the_second_column_alone(spark, tmp_path):
    from tidemark.operators.state import cluster_write

    df = spark.range(20_000).select((F.hash("id") % 1000).alias("x"), F.concat(F.lit("n"), F.lpad((F.abs(F.xxhash64("id")) % 500).cast("string"), 3, "0")).alias("y"), "id")
    cluster_write(df.repartition(4), str(tmp_path / "z"), ["x", "y"], files=16)
    files = spark.read.parquet(str(tmp_path / "z")).groupBy(F.input_file_name().alias("f")).agg(F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"), F.max("y").alias("y1")).collect()
    assert len(files) == 16
    for y in ("n017", "n250", "n433"):
        assert sum(r.y0 <= y <= r.y1 for r in files) <= 8
    for x in (-700, 3, 820):
        assert sum(r.x0 <= x <= r.x1 for r in files) <= 8


def test_audits(spark):
    t = lambda d: dt.datetime(2024, 1, d)
    scd2 = spark.createDataFrame(
        [("a", 1, t(1), t(3), "x"), ("a", 1, t(2), None, "y"), ("a", 2, t(1), t(2), "z"), ("a", 2, t(2), None, "w")],
        "account string, entity_id int, valid_from timestamp_ntz, valid_to timestamp_ntz, scd_id string",
    )
    assert [(r.entity_id, r.next_valid_from) for r in expect.overlapping_windows(scd2).collect()] == [(1, t(2))]
    ev = spark.createDataFrame([("a", 1, t(1)), ("a", 2, t(2))], "account string, entity_id int, event_ts timestamp_ntz")
    now = spark.createDataFrame([(t(20),)], "now_ts timestamp_ntz")
    bad = expect.obtained_mismatch(ev, scd2, 30, now).collect()
    assert [(r.entity_id, r.min_valid_from) for r in bad] == [(2, t(1))]
    attrs = spark.createDataFrame([(1, "A ", 1), (1, "a", 1), (2, "b", 1), (2, "b", 2)], "id int, name string, r int")
    out = expect.attribute_conflicts(attrs, "id", {"name": F.lower(F.trim("name")), "r": F.col("r")}).collect()
    assert sorted(tuple(r) for r in out) == [(2, "r", "1", 1, 2), (2, "r", "2", 1, 2)]
