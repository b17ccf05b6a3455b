"""CSV by header with rescued data, path parts, and bounded stream runs."""

from __future__ import annotations

import datetime as dt
import json
import os
import tempfile

from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StringType, StructField, StructType

from tidemark.schema import LOG_SCHEMA
from tidemark.sources.csv_snapshots import map_records, number_lines, parse_by_header, records, snapshot_lines, with_path_parts
from tidemark.streaming.ingest import IngestResult, batch_writer, read_bronze, run_ingest
from tidemark.streaming.opslog import Run, read_log

SCHEMA = StructType([StructField("ID", IntegerType()), StructField("Name", StringType()), StructField("HP", DoubleType())])


def _parse(spark, text):
    df = spark.createDataFrame([(text, "f")], "value string, source_file string")
    return [r.asDict() for r in parse_by_header(df, SCHEMA, keep=("source_file",)).collect()]


def test_swapped_extra_missing_columns(spark):
    rows = _parse(spark, "Name;Extra;ID\nx;e1;1\n")
    assert rows == [{"source_file": "f", "ID": 1, "Name": "x", "HP": None, "_rescued_data": '{"Extra":"e1"}'}]


def test_uncastable_cell_is_rescued(spark):
    (r,) = _parse(spark, "ID;Name;HP\nabc;x;1.5\n")
    assert r["ID"] is None and r["HP"] == 1.5 and json.loads(r["_rescued_data"]) == {"ID": "abc"}


def test_quotes_and_separator_inside_quotes(spark):
    (r,) = _parse(spark, 'ID;Name;HP\n1;"a;b ""q""";2\n')
    assert r["Name"] == 'a;b "q"' and r["HP"] == 2.0 and r["_rescued_data"] is None


def test_row_longer_than_header_and_repeated_header(spark):
    (r,) = _parse(spark, "ID;Name;Name\n1;x;y;z\n")
    assert r["ID"] == 1 and r["Name"] == "x"
    assert json.loads(r["_rescued_data"]) == {"Name_3": "y", "_extra_1": "z"}


def test_short_row_and_empty_cells_are_null(spark):
    (r,) = _parse(spark, "ID;Name;HP\n7;\n")
    assert r == {"source_file": "f", "ID": 7, "Name": None, "HP": None, "_rescued_data": None}


def test_path_parts(spark):
    paths = [
        "/l/AccountName=ab/snap_ab_05012024_3.csv",
        "/l/AccountName=a_b/snap_a_b_05012024_0.csv",
        "/l/AccountName=a%20b/snap_a%20b_05012024_0.csv",
        "/l/AccountName=a%2Bb/snap_a+b_05012024_1.csv",
        "/l/AccountName=ab/snap_ab_32012024_1.csv",
        "/l/AccountName=ab/snap_ab_05012024.csv",
        "/l/AccountName=ab/snap_ab_05012024_10000.csv",
        "/l/nowhere/snap_ab_05012024_1.csv",
    ]
    df = with_path_parts(spark.createDataFrame([(p,) for p in paths], "source_file string"))
    got = [(r.AccountName, r.snapshot_date, r.snapshot_version) for r in df.collect()]
    d = dt.date(2024, 1, 5)
    assert got == [("ab", d, 3), ("a_b", d, 0), ("a b", d, 0), ("a+b", d, 1), ("ab", None, 1), ("ab", None, None),
                   ("ab", d, 10000), (None, d, 1)]


def _write(root, account, name, text):
    folder = os.path.join(root, f"AccountName={account}")
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as fh:
        fh.write(text)


def test_two_bounded_runs_and_log(spark):
    root = tempfile.mkdtemp(prefix="tidemark-ingest-")
    landing = os.path.join(root, "landing")
    header = "AccountName;ID;HeroID;Name;Rank\n"
    _write(landing, "a1", "snap_a1_01012024_0.csv", header + "a1;1;11;x;3\na1;2;21;y;4\n")
    _write(landing, "a1", "snap_a1_02012024_0.csv", header + "a1;1;11;x;5\n")
    _write(landing, "b2", "snap_b2_01012024_0.csv", "Rank;Name;ID;Odd\n2;z;9;q\n")
    args = (spark, landing, f"{root}/bronze", f"{root}/ckpt", f"{root}/log")
    r1 = run_ingest(*args, run_id="r1", run_ts=dt.datetime(2024, 2, 1), max_files_per_trigger=2)
    assert r1.status == "SUCCESS" and r1.rows == 4 and len(r1.batches) == 2
    r2 = run_ingest(*args, run_id="r2")
    assert r2.status == "EMPTY" and r2.rows == 0
    bronze = read_bronze(spark, f"{root}/bronze")
    got = sorted((r.AccountName, r.ID, r.Rank, r.snapshot_date, r.snapshot_version, r._rescued_data) for r in bronze.collect())
    assert got[-1] == ("b2", 9, 2, dt.date(2024, 1, 1), 0, '{"Odd":"q"}')
    assert {r.run_id for r in bronze.collect()} == {"r1"}
    log = spark.read.schema(LOG_SCHEMA).parquet(f"{root}/log")
    levels = sorted((r.event_level, r.status) for r in log.select("event_level", "status").collect())
    assert levels == [("FILE", "SUCCESS")] * 3 + [("RUN", "EMPTY"), ("RUN", "SUCCESS")]
    assert sorted(log.columns)[:2] == ["batch_id", "checkpoint_location"] and read_log(spark, f"{root}/log").columns == LOG_SCHEMA.fieldNames()
    files = {os.path.basename(r.source_file): (r.row_count, r.rows_rescued) for r in log.where(F.col("event_level") == "FILE").collect()}
    assert files["snap_b2_01012024_0.csv"] == (1, 1)


def test_failed_run_is_logged_and_raised(spark):
    root = tempfile.mkdtemp(prefix="tidemark-ingest-")
    import pytest

    with pytest.raises(Exception):
        run_ingest(spark, os.path.join(root, "missing"), f"{root}/bronze", f"{root}/ckpt", f"{root}/log", run_id="bad")
    log = spark.read.schema(LOG_SCHEMA).parquet(f"{root}/log").collect()
    assert [(r.event_level, r.status) for r in log] == [("RUN", "FAILED")] and log[0].error_class


def test_log_write_failure_is_swallowed(spark):
    from tidemark.streaming.opslog import Run, append_best_effort, run_event

    ctx = Run("r", "t", "p", notes={"a": 1})
    ev = run_event(spark, ctx, run_ts=dt.datetime(2024, 1, 1), status="SUCCESS", started=dt.datetime(2024, 1, 1),
                   event_context={"a": 2, "b": 3}, message="x" * 5000)
    assert len(ev.first().message) == 5000
    assert ev.first().context_json == '{"a":2,"b":3}'
    bad = "/proc/not-writable/log"
    assert append_best_effort(ev, bad, "s", "run-r") is False


def test_control_character_and_byte_order_mark(spark):
    (r,) = _parse(spark, '﻿ID;Name;HP\n1;"a\u0001b;c";2\n')
    assert (r["ID"], r["Name"], r["HP"], r["_rescued_data"]) == (1, "a\u0001b;c", 2.0, None)


def test_two_checkpoints_keep_each_others_rows(spark):
    root = tempfile.mkdtemp(prefix="tidemark-ingest-")
    for name in ("one", "two"):
        _write(f"{root}/{name}", "a1", f"snap_a1_01012024_{len(name)}.csv", f"ID;Name\n1;{name}\n")
        _write(f"{root}/{name}", "b2", f"snap_b2_01012024_{len(name)}.csv", f"ID;Name\n2;{name}\n")
        run_ingest(spark, f"{root}/{name}", f"{root}/bronze", f"{root}/ckpt-{name}", run_id=name)
    bronze = read_bronze(spark, f"{root}/bronze")
    assert sorted((r.AccountName, r.run_id) for r in bronze.collect()) == [("a1", "one"), ("a1", "two"), ("b2", "one"), ("b2", "two")]


def _cells_like_csv(text):
    """What Python's csv module reads, as the reference for well-formed files."""
    import csv
    import io

    return [r for r in csv.reader(io.StringIO(text, newline=""), delimiter=";", quotechar='"', doublequote=True) if r]


def test_records_with_line_breaks_across_ranges(spark):
    import random

    r = random.Random(8)
    pieces = ["x", "long text of a cell", ";", '""', "\n", "\n\n", "\r\n", "é", " "]
    root = tempfile.mkdtemp(prefix="tidemark-ingest-")
    want = {}
    for f in range(3):
        lines = ["ID;Name;HP"]
        for i in range(400):
            quoted = '"' + "".join(r.choice(pieces) for _ in range(r.randint(1, 12))) + '"'
            lines.append(f"{i};{quoted if r.random() < 0.4 else 'plain'};{i}.5")
        text = ("\r\n" if f == 2 else "\n").join(lines) + "\n"
        _write(root, "a1", f"snap_a1_0{f + 1}012024_0.csv", text)
        want[f"snap_a1_0{f + 1}012024_0.csv"] = [(int(a), b or None, float(c)) for a, b, c in _cells_like_csv(text)[1:]]
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    try:
        numbered = number_lines(snapshot_lines(spark, root)).persist()
        assert numbered.select("source_file", "block").distinct().count() > 30
        rows = map_records(records(numbered), SCHEMA).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    got = {}
    for x in rows:
        got.setdefault(os.path.basename(x.source_file), []).append((x.ID, x.Name, x.HP))
        assert x._rescued_data is None
    assert {f: sorted(v, key=str) for f, v in got.items()} == {f: sorted(v, key=str) for f, v in want.items()}


def test_quoted_cell_that_never_ends_keeps_its_lines_apart(spark):
    rows = _parse(spark, 'ID;Name;HP\n1;"a\nb";1\n2;5" d;2\n3;"open;3\n4;c;4\n5;d;5\n')
    assert [(r["ID"], r["Name"], r["HP"]) for r in sorted(rows, key=lambda r: r["ID"])] == [(1, "a\nb", 1.0), (2, '5" d', 2.0), (3, '"open', 3.0), (4, "c", 4.0), (5, "d", 5.0)]


def test_header_with_a_line_break_and_blank_lines(spark):
    rows = _parse(spark, 'ID;"Na\nme";Name\n\n1;x;y\n   \n2;z;w')
    assert [(r["ID"], r["Name"], json.loads(r["_rescued_data"])) for r in sorted(rows, key=lambda r: r["ID"])] == [(1, "y", {"Na\nme": "x"}), (2, "w", {"Na\nme": "z"})]


def test_one_large_file_is_read_by_even_tasks(spark):
    root = tempfile.mkdtemp(prefix="tidemark-ingest-")
    _write(root, "a1", "snap_a1_01012024_0.csv", "ID;Name;HP\n" + "".join(f"{i};name {i % 7};{i}\n" for i in range(30_000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        lines = snapshot_lines(spark, root)
        held = sorted(r["count"] for r in lines.groupBy("block").count().collect())
        assert len(held) > 15 and held[-1] <= 3 * held[len(held) // 2]
        run_ingest(spark, root, f"{root}/bronze", f"{root}/ckpt", run_id="r")
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    bronze = read_bronze(spark, f"{root}/bronze")
    assert bronze.agg(F.count("*"), F.sum("ID"), F.count_distinct("ID")).first()[:] == (30_000, sum(range(30_000)), 30_000)


def test_replayed_batch_replaces_its_rows_and_log(spark):
    root = tempfile.mkdtemp(prefix="tidemark-ingest-")
    _write(f"{root}/in", "a1", "snap_a1_01012024_0.csv", "ID;Name;Odd\n1;x;o\n2;y;\n")
    run_ingest(spark, f"{root}/in", f"{root}/bronze", f"{root}/ckpt", f"{root}/log", run_id="r1", run_ts=dt.datetime(2024, 2, 1))
    ctx = Run("r1", "bronze.snapshots", "ingest_snapshots", progress_at=f"{root}/ckpt")
    # the same batch once more, as after a failure between its write and the checkpoint's commit
    from tidemark.sources.csv_snapshots import with_range

    again = with_range(spark.read.option("lineSep", "\n").option("recursiveFileLookup", "true").text(f"{root}/in"))
    batch_writer(spark, f"{root}/bronze", f"{root}/log", ctx, dt.datetime(2024, 2, 1), dt.datetime(2024, 2, 1), IngestResult("r1", "STARTED"))(again, 0)
    assert read_bronze(spark, f"{root}/bronze").count() == 2
    log = read_log(spark, f"{root}/log")
    assert sorted((r.event_level, r.row_count, r.rows_rescued) for r in log.collect()) == [("FILE", 2, 1), ("RUN", None, None)]
