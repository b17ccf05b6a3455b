"""Keyed merge as a pure function, and helpers for written tables.

On plain parquet there is no MERGE, UPDATE or overwrite-in-place, and Spark
refuses to overwrite a table it is reading.  A merge therefore builds the new
state as a DataFrame (``merge_by_key``); ``operators.store`` keeps such states.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType


def merge_by_key(target: DataFrame | None, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Upsert: rows of ``source`` replace target rows with the same key, new keys
    are inserted, other target rows stay.  Duplicate keys in ``source`` fail the
    job (a merge would pick one at random)."""
    keys = list(keys)
    dup = F.count(F.lit(1)).over(_key_window(keys))
    # a filter, not a dropped column, so the optimiser cannot prune the check
    guard = F.when(F.col("_dup") > 1, F.raise_error(F.lit(f"duplicate merge key on {keys}"))).otherwise(F.lit(True))
    checked = source.withColumn("_dup", dup).where(guard).drop("_dup")
    if target is None:
        return checked
    kept = target.join(source.select(*keys), on=keys, how="left_anti")
    return kept.unionByName(checked.select(*kept.columns))


def _key_window(keys: Sequence[str]):
    from pyspark.sql import Window

    return Window.partitionBy(*keys)


def fill_null(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Replace NULLs in the named columns (a projection, not an UPDATE)."""
    return df.fillna(dict(values))


RANK_BITS = 8


def ordered_number(df: DataFrame, column: str) -> Column:
    """A number that orders as the column does (text: by its first six bytes)."""
    kind = df.schema[column].dataType
    if isinstance(kind, StringType):
        return F.conv(F.rpad(F.hex(F.substring(F.encode(F.col(column), "UTF-8"), 1, 6)), 12, "0"), 16, 10).cast("double")
    if isinstance(kind, DateType):
        return F.datediff(F.col(column), F.lit("1970-01-01").cast("date")).cast("double")
    return F.col(column).cast("double")


def interleaved(df: DataFrame, columns: Sequence[str], bits: int = RANK_BITS) -> Column:
    """A place on the Z curve: the bits of the columns' range ranks in turn.

    A rank is the number of quantile bounds below the value; there are at most
    ``2 ** bits - 1`` bounds per column, which is all that the driver sees.  NULLs
    rank lowest."""
    numbers = [ordered_number(df, c) for c in columns]
    shares = [k / (1 << bits) for k in range(1, 1 << bits)]
    bounds = df.agg(*[F.percentile_approx(n, shares).alias(f"b{i}") for i, n in enumerate(numbers)]).first()


    def rank_of(number: Column, held: list[float]) -> Column:
        below = F.filter(F.array(*[F.lit(x) for x in held]), lambda bound: bound < number)
        return F.when(number.isNull(), 0).otherwise(F.size(below)) if held else F.lit(0)

    place = F.lit(0).cast("bigint")
    for i, n in enumerate(numbers):
        rank = rank_of(n, sorted(set(bounds[i] or ())))
        for k in range(bits):
            place = place.bitwiseOR(F.shiftleft(F.shiftright(rank, k).bitwiseAND(1).cast("bigint"), k * len(numbers) + i))
    return place


def cluster_write(df: DataFrame, path: str, columns: Sequence[str], mode: str = "overwrite", files: int | None = None) -> None:
    """Rows laid out by several columns at once before writing: ranges of the
    Z curve, so a file covers a small part of each column's range, and min/max
    statistics prune files by any of the columns, not only by the first."""
    cols = list(columns)
    placed = df.withColumn("_z", interleaved(df, cols))
    part = _in_whole_cells(placed, files, RANK_BITS * len(cols)) if files else placed.repartitionByRange("_z")
    part.sortWithinPartitions("_z", *cols).drop("_z").write.mode(mode).parquet(path)


#: Cells of the curve per file that a cut may lie between.
CELLS_PER_FILE = 64


def _in_whole_cells(placed: DataFrame, files: int, bits: int) -> DataFrame:
    """Rows in ``files`` partitions along the curve, cut where cells of it begin.

    Cuts from a sample lie a little beside the cells, and a file with a sliver of
    the next cell covers the ranges of both.  The driver sees a count for each cell."""
    fine = min(bits, (files * CELLS_PER_FILE - 1).bit_length())
    cell = F.shiftright("_z", bits - fine)
    held = sorted(placed.groupBy(cell.alias("c")).agg(F.count(F.lit(1)).alias("n")).collect())
    ends = list(accumulate(r["n"] for r in held))
    cuts = []
    for k in range(1, files):
        share = k * ends[-1] / files if ends else 0
        best = min(range(len(ends)), key=lambda i: abs(ends[i] - share), default=None)
        if best is not None and best + 1 < len(held):
            cuts.append(held[best + 1]["c"])
    starts = F.array(*[F.lit(c).cast("bigint") for c in cuts]) if cuts else F.array().cast("array<bigint>")
    return placed.repartitionById(files, F.size(F.filter(starts, lambda c: c <= cell)))


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system of a path, the path, and the JVM."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath, jvm
