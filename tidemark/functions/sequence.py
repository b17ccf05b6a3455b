"""Numbering rows inside a key without sending the whole key to one task.

``row_number().over(Window.partitionBy(key))`` sorts every row of a key in one
task; when one account holds a third of all files, that task holds a third of
the data.  ``sequence_within`` splits each key by a coarse bucket column (for
snapshots: the date), numbers rows inside each (key, bucket) group, and adds the
count of rows in earlier buckets, which comes from a prefix sum over the
(key, bucket) count table — one row per bucket, not per row.

The same bucket table gives each bucket's first value of a column, so the
value on the *next* row (``next_of``) is a ``lead`` inside the bucket, or the
first value of the key's next bucket — no self-join on ``seq + 1``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def sequence_within(
    df: DataFrame,
    keys: Sequence[str],
    bucket: str,
    order: Sequence[str],
    out: str = "seq",
    next_of: str | None = None,
) -> DataFrame:
    """Add ``out`` = 1..n within ``keys`` by (bucket, *order), all ascending,
    and with ``next_of`` also ``next_<next_of>``: that column's value on the
    row numbered ``out + 1`` (NULL on the last row).

    ``order`` must be a total order inside (keys, bucket) for a stable result.
    Rows with a NULL bucket sort first, as in an ascending window.
    """
    keys, order = list(keys), list(order)
    aggs = [F.count(F.lit(1)).alias("_bucket_rows")]
    if next_of:
        aggs.append(F.min_by(F.col(next_of), F.struct(*order)).alias("_bucket_first"))
    counts = df.groupBy(*keys, bucket).agg(*aggs)
    prefix = Window.partitionBy(*keys).orderBy(F.col(bucket).asc_nulls_first())
    cols = [*keys, bucket, (F.sum("_bucket_rows").over(prefix) - F.col("_bucket_rows")).alias("_bucket_offset")]
    if next_of:
        cols.append(F.lead("_bucket_first").over(prefix).alias("_next_bucket_first"))
    offsets = counts.select(*cols)

    # number inside (key, bucket) first; the join to the small offsets table
    # on the same columns then reuses the window's hash partitioning, so only
    # the offsets move.  Rows with a NULL key or bucket get a NULL number.
    inner = Window.partitionBy(*keys, bucket).orderBy(*[F.col(c).asc_nulls_first() for c in order])
    numbered = df.withColumn("_rn", F.row_number().over(inner))
    if next_of:
        numbered = numbered.withColumn("_next_in_bucket", F.lead(next_of).over(inner))
    joined = numbered.join(offsets, on=[*keys, bucket], how="left")
    outcols = {out: F.col("_bucket_offset") + F.col("_rn")}
    if next_of:
        outcols[f"next_{next_of}"] = F.coalesce(F.col("_next_in_bucket"), F.col("_next_bucket_first"))
    return joined.withColumns(outcols).drop("_rn", "_bucket_offset", "_next_in_bucket", "_next_bucket_first")
