"""Writes snapshot CSV files into a landing folder, one file per snapshot:
``<root>/AccountName=<account>/snap_<account>_<ddMMyyyy>_<version>.csv``.

Spark cannot choose output file names, so the files are written by the tasks
themselves (``mapInArrow``): rows are hash-partitioned by file, each task
writes the files of its partition with Arrow's CSV writer and returns
(path, rows).  This feeds the file-stream ingest in tests and queries; the
root must be a folder every executor can write (the shared checkpoint folder).
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tidemark.schema import SNAPSHOT_SCHEMA

WRITTEN = StructType([StructField("path", StringType()), StructField("rows", LongType())])
# fixed value: file name prefix of the snapshot files
FILE_PREFIX = "snap"


def _writer(root: str, columns: list[str], reverse_when_odd_day: bool):
    def write(batches):
        import pyarrow as pa
        import pyarrow.csv as pacsv
        import pyarrow.compute as pc

        tables = [pa.Table.from_batches([b]) for b in batches if b.num_rows]
        if not tables:
            return
        t = pa.concat_tables(tables)
        out_paths, out_rows = [], []
        for name in pc.unique(t["_file_name"]).to_pylist():
            part = t.filter(pc.equal(t["_file_name"], name))
            acct_dir = part["_dir"][0].as_py()
            cols = list(columns)
            if reverse_when_odd_day and part["_odd_day"][0].as_py():
                cols = cols[::-1]
            folder = os.path.join(root, acct_dir)
            os.makedirs(folder, exist_ok=True)
            path = os.path.join(folder, name)
            pacsv.write_csv(
                part.select(cols),
                path,
                write_options=pacsv.WriteOptions(include_header=True, delimiter=";", quoting_style="needed"),
            )
            out_paths.append(path)
            out_rows.append(part.num_rows)
        yield pa.RecordBatch.from_arrays([pa.array(out_paths, pa.string()), pa.array(out_rows, pa.int64())], names=["path", "rows"])

    return write


def write_landing(bronze: DataFrame, root: str, extra: dict[str, str] | None = None, partitions: int | None = None) -> DataFrame:
    """Write one CSV per (account, source_file) of bronze-shaped rows; returns a
    lazy DataFrame of (path, rows) — count it to run the write.

    ``extra`` maps additional CSV header names to bronze columns (for example a
    column unknown to the contract, which ingest must rescue).  Files dated on
    an odd day are written with their columns in reverse order.
    """
    extra = dict(extra or {})
    acct = F.coalesce(F.col("AccountName"), F.split("source_file", "/").getItem(0))
    enc = F.regexp_replace(F.regexp_replace(acct, "%", "%25"), " ", "%20")
    enc = F.regexp_replace(enc, r"\+", "%2B")
    name = F.concat(
        F.lit(FILE_PREFIX + "_"),
        enc,
        F.lit("_"),
        F.date_format("snapshot_date", "ddMMyyyy"),
        F.lit("_"),
        F.coalesce(F.col("snapshot_version"), F.lit(0)).cast("string"),
        F.lit(".csv"),
    )
    data_cols = [f.name for f in SNAPSHOT_SCHEMA.fields]
    sel = [F.col(c).cast("string").alias(c) if c == "AccountName" else F.col(c) for c in data_cols]
    sel += [F.col(src).cast("string").alias(hdr) for hdr, src in extra.items()]
    rows = bronze.select(
        *sel,
        name.alias("_file_name"),
        F.concat(F.lit("AccountName="), enc).alias("_dir"),
        (F.dayofmonth("snapshot_date") % 2 == 1).alias("_odd_day"),
    )
    rows = rows.repartition(partitions, "_file_name") if partitions else rows.repartition("_file_name")
    columns = data_cols + list(extra)
    return rows.mapInArrow(_writer(root, columns, True), WRITTEN)
