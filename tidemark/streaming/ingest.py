"""Bounded file-stream ingest of snapshot CSV files into a bronze table.

``run_ingest`` starts a file stream over the landing folder with
``Trigger.AvailableNow``: every file not yet recorded in the checkpoint is
processed once, in micro-batches, and the query stops when it has caught up.
Files are read as lines in ranges, never whole, so one large file is read by
many tasks.  Per micro-batch (``foreachBatch``):

* the lines, numbered in their ranges, are written once to the shared folder; the
  header table, the quote states and the records all come from that table;
* the batch's rows are written once, partitioned by (account, snapshot date), to
  ``<bronze>/query_id=<stream>/batch_id=<id>`` with overwrite.  A range lies in one
  task, so a snapshot of one range gives one file, and a snapshot of many ranges
  is written by as many tasks.  Batch numbers begin anew with each checkpoint, and the
  stream's id keeps two checkpoints apart; a replayed batch (after a failure between
  the write and the checkpoint commit) rewrites the same folder;
* rows and rescued rows per file are counted from the written batch and logged
  as FILE events under the batch's own key, so a replay replaces them.

One RUN event closes the run: SUCCESS, EMPTY when no row arrived (counted in
``foreachBatch``, not from the bounded progress history) or FAILED with the
error class and its whole message, after which the error is
raised again.  The stream is started inside the try, so a failed start is
logged too.  Log writes are best effort.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from tidemark.schema import BRONZE_COLUMNS, BRONZE_SCHEMA, CONTRACT_VERSION, SNAPSHOT_SCHEMA
from tidemark.session import scratch_path
from tidemark.sources.csv_snapshots import LINE_END, has_broken_records, map_records, number_lines, ordered_lines, records, stamp, with_path_parts, with_range
from tidemark.streaming.opslog import Run, Status, append_best_effort, file_events, run_event

BRONZE_PARTITIONS = ["AccountName", "snapshot_date"]


def snapshot_stream(spark: SparkSession, landing: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """A1-A5: lines of the snapshot files in the landing folder as a stream, each
    file once (progress lives in the checkpoint); vanished files are skipped."""
    reader = (
        spark.readStream.format("text")
        .option("lineSep", LINE_END)
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.csv")
        .option("ignoreMissingFiles", "true")
    )
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return with_range(reader.load(landing))


def bronze_rows(numbered: DataFrame, run_id: str, run_ts: datetime | None = None, partitions: int | None = None) -> DataFrame:
    """Written numbered lines to records by header, path parts, stamps, the contract's columns.

    With ``partitions`` a range's rows are dealt to one of so many tasks: a task opens a
    file for each snapshot that it writes, so few rows in many files need many tasks."""
    ts = F.lit(run_ts.replace(tzinfo=None)).cast("timestamp_ntz") if run_ts is not None else None
    rows = map_records(records(numbered, broken=has_broken_records(numbered)), SNAPSHOT_SCHEMA, carry=["block"])
    if partitions:
        rows = rows.repartition(partitions, "source_file", "block")
    return stamp(with_path_parts(rows), run_id, CONTRACT_VERSION, ts).select(*BRONZE_COLUMNS)


@dataclass
class IngestResult:
    run_id: str
    status: str
    rows: int = 0
    batches: list[int] = field(default_factory=list)
    stream: str | None = None


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark gave the stream when its checkpoint was made."""
    return spark.read.json(f"{checkpoint.rstrip('/')}/metadata").first()["id"]


def batch_writer(spark: SparkSession, bronze_path: str, log_path: str | None, ctx: Run, run_ts: datetime, rows_ts: datetime | None, result: IngestResult):
    """B2-B3 + C4: the per-micro-batch function for ``foreachBatch``."""

    def write(batch: DataFrame, batch_id: int) -> None:
        started = datetime.now(timezone.utc)
        result.stream = result.stream or stream_id(spark, ctx.progress_at)
        lines = scratch_path(spark, "ingest-lines")
        # a task for each split of the batch; a range stays in one of them
        splits = max(batch.rdd.getNumPartitions(), spark.sparkContext.defaultParallelism)
        numbered = number_lines(ordered_lines(batch), partitions=splits)
        numbered.write.parquet(lines)
        target = f"{bronze_path.rstrip('/')}/query_id={result.stream}/batch_id={batch_id}"
        rows = bronze_rows(spark.read.schema(numbered.schema).parquet(lines), ctx.run_id, rows_ts, splits)
        rows.write.mode("overwrite").partitionBy(*BRONZE_PARTITIONS).parquet(target)
        written = spark.read.schema(BRONZE_SCHEMA).parquet(target)
        n = written.count()
        drop_folder(spark, lines)
        if n == 0:
            return
        result.rows += n
        result.batches.append(batch_id)
        if log_path:
            events = file_events(written, ctx, run_ts=run_ts, batch_id=batch_id, started=started, finished=datetime.now(timezone.utc))
            append_best_effort(events, log_path, result.stream, f"batch-{batch_id}")

    return write


def drop_folder(spark: SparkSession, path: str) -> None:
    """Remove a scratch folder that this run wrote."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def run_ingest(
    spark: SparkSession,
    landing: str,
    bronze_path: str,
    checkpoint: str,
    log_path: str | None = None,
    *,
    run_id: str | None = None,
    run_ts: datetime | None = None,
    max_files_per_trigger: int | None = None,
    target_table: str = "bronze.snapshots",
) -> IngestResult:
    """B1 + C7-C8: one bounded run; returns status and counts."""
    run_id = run_id or str(uuid.uuid4())
    started = run_ts or datetime.now(timezone.utc)
    ctx = Run(run_id, target_table, "ingest_snapshots", progress_at=checkpoint, notes={"trigger": "availableNow"})
    result = IngestResult(run_id=run_id, status=Status.STARTED)
    try:
        query = (
            snapshot_stream(spark, landing, max_files_per_trigger)
            .writeStream.foreachBatch(batch_writer(spark, bronze_path, log_path, ctx, started, run_ts, result))
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
        result.status = Status.SUCCESS if result.rows else Status.EMPTY
        message = "stream completed" if result.rows else "no new data files"
        if log_path:
            append_best_effort(
                run_event(spark, ctx, run_ts=started, status=result.status, started=started,
                          finished=datetime.now(timezone.utc), message=message),
                log_path, result.stream or "none", f"run-{run_id}",
            )
        return result
    except Exception as err:
        result.status = Status.FAILED
        if log_path:
            append_best_effort(
                run_event(spark, ctx, run_ts=started, status=Status.FAILED, started=started,
                          finished=datetime.now(timezone.utc), message=str(err), error_class=type(err).__name__),
                log_path, result.stream or "none", f"run-{run_id}",
            )
        raise


def read_bronze(spark: SparkSession, bronze_path: str) -> DataFrame:
    """The bronze table with its declared schema (partition columns typed
    by the contract, not inferred from folder names)."""
    schema = StructType(BRONZE_SCHEMA.fields + [StructField("query_id", StringType()), StructField("batch_id", IntegerType())])
    return spark.read.schema(schema).parquet(bronze_path)
