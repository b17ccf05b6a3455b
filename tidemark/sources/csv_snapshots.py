"""Snapshot CSV files: records from line ranges, by-header mapping with rescued
data, path parts and ingest stamps.

Spark's CSV reader maps columns by position when a schema is given, so a file
with swapped or extra columns is read wrongly without notice; and its multi-line
mode reads a file in one task.  Here a file of any size is read as lines in
ranges (Spark's own splits of a text file), and records are found from the
ranges:

* ``number_lines`` numbers the lines of a range and notes what each prefix of it
  does to the quote state: keep it, flip it, or set it.  Such maps compose, so
  a range is summed up by one of four codes, whatever state it begins in.
* ``range_states`` composes the codes of a file's ranges in order (one small row
  per range): the state at the start of every range, and the record that is
  open there.
* ``records`` joins these back.  A line outside quotes on both sides is a record;
  only lines of records with line breaks are grouped and joined.  A quoted cell
  that never ends is not one: its lines stay records of their own.

``map_records`` then maps cells by the file's own header, from a table with one
row per file: contract fields are ``try_cast``; cells under unknown headers, cells
beyond the header (``_extra_<i>``) and cells that do not cast go to
``_rescued_data`` as a JSON object; a repeated header gets ``_<position>`` appended;
empty cells are NULL; blank lines are no records.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from tidemark.functions.expressions import account_from_path, date_from_file_name, file_name, version_from_file_name

# --- fixed values: the snapshot CSV dialect ---
SEP = ";"
QUOTE = '"'
LINE_END = "\n"
EXTRA_PREFIX = "_extra_"
BYTE_ORDER_MARK = "\ufeff"

# a quote opens a cell only at the cell's start; two quotes inside stand for one
_BODY = '"[^"]*+(?:""[^"]*+)*+'
_CELL = f'{_BODY}"[^{SEP}]*+|[^"{SEP}][^{SEP}]*+|'
_OPEN_END = f"\\A(?:(?:{_CELL}){SEP})*+{_BODY}\\z"
_CELLS = f'{SEP}({_BODY}"[^{SEP}]*+|[^{SEP}]*+)'

# what a stretch of text does to the quote state
KEEP, FLIP, OUTSIDE, INSIDE = 0, 1, 2, 3


def snapshot_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of all CSV files below ``path``, in ranges: source_file, block, ord, value."""
    reader = spark.read.option("lineSep", LINE_END).option("recursiveFileLookup", "true").option("pathGlobFilter", "*.csv")
    return ordered_lines(with_range(reader.text(path)))


def with_range(lines: DataFrame) -> DataFrame:
    """The file of each line, and where in it the line's range begins."""
    return lines.select("value", F.col("_metadata.file_path").alias("source_file"), F.col("_metadata.file_block_start").alias("block"))


def ordered_lines(lines: DataFrame) -> DataFrame:
    """A range is read by one task from top to bottom, so a task's row order is the order inside it."""
    return lines.withColumn("ord", F.monotonically_increasing_id())


def _after(code: Column, state: Column | int) -> Column:
    """The quote state after a stretch that began in ``state``."""
    state = state if isinstance(state, Column) else F.lit(state)
    return F.when(code == KEEP, state).when(code == FLIP, 1 - state).otherwise(code - OUTSIDE)


def _running(df: DataFrame, own: str, keys: Sequence[str], order: str, out: str) -> DataFrame:
    """``out``: the code of all rows up to this one, from each row's ``own``; two running windows on one sort.

    Without a row that sets the state, the flips so far count; else that state and the flips since."""
    upto = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    code = F.col(own)
    df = df.withColumn("_flips", F.sum(F.when(code == FLIP, 1).otherwise(0)).over(upto))
    df = df.withColumn("_set", F.last(F.when(code >= OUTSIDE, F.col("_flips") * 2 + code - OUTSIDE), ignorenulls=True).over(upto))
    since = (F.col("_set") + F.col("_flips") - F.floor(F.col("_set") / 2)) % 2
    return df.withColumn(out, F.when(F.col("_set").isNull(), F.col("_flips") % 2).otherwise(OUTSIDE + since).cast("int")).drop("_flips", "_set")


def number_lines(lines: DataFrame, keys: Sequence[str] = ("source_file", "block"), order: str = "ord", partitions: int | None = None) -> DataFrame:
    """Lines with their number ``n`` in the range, and the codes of the range ``before`` and ``upto`` the line.

    One exchange by range (into ``partitions``, if given); a range is at most one split of a file."""
    keys = list(keys)
    if partitions:
        lines = lines.repartition(partitions, *keys)
    quoted = F.instr("value", QUOTE) > 0
    from_out, from_in = F.col("value").rlike(_OPEN_END), F.concat(F.lit(QUOTE), F.col("value")).rlike(_OPEN_END)
    own = F.when(~quoted, KEEP).when(from_out & from_in, INSIDE).when(from_out, FLIP).when(from_in, KEEP).otherwise(OUTSIDE)
    w = Window.partitionBy(*keys).orderBy(order)
    out = _running(lines.withColumn("_own", own), "_own", keys, order, "upto")
    return out.withColumns({"n": F.row_number().over(w), "before": F.lag("upto", 1, KEEP).over(w)}).drop("_own", order)


def range_states(numbered: DataFrame, keys: Sequence[str] = ("source_file",)) -> DataFrame:
    """Per file and range: the quote ``state`` at its start, the record open there (``from_block``, ``from_n``),
    and where the file's never-ended quoted cell begins, if it has one (``loose_block``, ``loose_n``)."""
    keys = list(keys)
    begins = lambda s: F.max(F.when(_after(F.col("before"), s) == 0, F.col("n")))  # noqa: E731  the last line that begins a record
    held = numbered.groupBy(*keys, "block").agg(F.max(F.col("n").cast("bigint") * 4 + F.col("upto")).alias("_last"), begins(0).alias("_out"), begins(1).alias("_in"))
    held = _running(held.withColumn("_own", (F.col("_last") % 4).cast("int")), "_own", keys, "block", "_upto")
    w = Window.partitionBy(*keys).orderBy("block")
    held = held.withColumn("state", _after(F.lag("_upto", 1, KEEP).over(w), 0))
    start = F.when(F.col("state") == 0, F.col("_out")).otherwise(F.col("_in"))
    held = held.withColumn("_start", F.when(start.isNotNull(), F.struct("block", start.alias("n"))))
    earlier, whole = w.rowsBetween(Window.unboundedPreceding, -1), w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    held = held.withColumns({"_from": F.last("_start", ignorenulls=True).over(earlier), "_loose": F.last("_start", ignorenulls=True).over(whole), "_end": _after(F.last("_upto").over(whole), 0)})
    loose = lambda f: F.when(F.col("_end") == 1, F.col(f"_loose.{f}"))
    return held.select(*keys, "block", "state", F.col("_from.block").alias("from_block"), F.col("_from.n").alias("from_n"), loose("block").alias("loose_block"), loose("n").alias("loose_n"))


def has_broken_records(numbered: DataFrame) -> bool:
    """Whether any line, begun outside quotes, ends inside; if none does, every line is a record."""
    return not numbered.where(F.col("upto").isin(FLIP, INSIDE)).isEmpty()


def records(numbered: DataFrame, keys: Sequence[str] = ("source_file",), broken: bool = True) -> DataFrame:
    """One row per CSV record: the keys, the place of its first line (block, n), its text.
    ``broken=False``: it is known that every line is a record."""
    keys = list(keys)
    if not broken:
        return _without_return(numbered.select(*keys, "block", "n", "value"))
    rows = numbered.join(range_states(numbered, keys), [*keys, "block"])
    inside, after = _after(F.col("before"), F.col("state")), _after(F.col("upto"), F.col("state"))
    loose = F.col("loose_block").isNotNull() & (F.struct("block", "n") >= F.struct(F.col("loose_block").alias("block"), F.col("loose_n").alias("n")))
    rows = rows.withColumns({"_inside": inside, "_part": ((inside == 1) | (after == 1)) & ~loose})
    place = [*keys, "block", "n"]
    whole = rows.where(~F.col("_part")).select(*place, "value")
    upto = Window.partitionBy(*keys, "block").orderBy("n").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    first = F.last(F.when(F.col("_inside") == 0, F.struct("block", "n")), ignorenulls=True).over(upto)
    parts = rows.where("_part").withColumn("_first", F.coalesce(first, F.struct(F.col("from_block").alias("block"), F.col("from_n").alias("n"))))
    text = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("block", "n", "value"))), lambda x: x["value"]), LINE_END)
    joined = parts.groupBy(*keys, "_first").agg(text.alias("value")).select(*keys, F.col("_first.block").alias("block"), F.col("_first.n").alias("n"), "value")
    return _without_return(whole.union(joined))


def _without_return(rows: DataFrame) -> DataFrame:
    return rows.withColumn("value", F.when(F.endswith("value", F.lit("\r")), F.expr("substring(value, 1, length(value) - 1)")).otherwise(F.col("value")))


def _unquote(c: Column) -> Column:
    quoted = c.startswith(QUOTE) & c.endswith(QUOTE) & (F.length(c) >= 2)
    inner = F.replace(F.substring(c, F.lit(2), F.length(c) - 2), F.lit(QUOTE * 2), F.lit(QUOTE))
    return F.when(quoted, inner).otherwise(c)


def _split(line: Column) -> Column:
    """Raw cells of a record; the pattern only for records with a quote."""
    return F.when(F.instr(line, QUOTE) > 0, F.regexp_extract_all(F.concat(F.lit(SEP), line), F.lit(_CELLS), F.lit(1))).otherwise(F.split(line, SEP))


def _header_names(header: Column) -> Column:
    """Header cells, trimmed; a repeated name gets ``_<position>`` appended."""
    names = F.transform(_split(header), lambda x: F.trim(_unquote(x)))
    return F.transform(
        names,
        lambda n, i: F.when(
            F.array_position(F.slice(names, 1, F.greatest(i, F.lit(1))), n).between(1, i) & (i > 0),
            F.concat(n, F.lit("_"), (i + 1).cast("string")),
        ).otherwise(n),
    )


def _cell(cells: Column, pos: Column) -> Column:
    """Cell at a 1-based position, unquoted; NULL when absent, empty or position 0.
    (A CASE rather than nullif: Spark 4 turns nullif into a shared
    subexpression column, and ~30 of them exceed the field limit of
    generated code.)"""
    raw = _unquote(F.when(pos > 0, F.try_element_at(cells, pos)))
    return F.when(F.length(raw) > 0, raw)


#: a known cell's text (as ``_cell`` has it) in SQL
_VALUE = """CASE WHEN {r} = '' OR {r} = '""' THEN NULL
    WHEN startswith({r}, '"') AND endswith({r}, '"') AND length({r}) >= 2 THEN replace(substring({r}, 2, length({r}) - 2), '""', '"') ELSE {r} END"""


def _fragment(name: Column, value: Column) -> Column:
    """``"name":"value"`` with JSON escaping (the body of a one-key object):
    each side is a one-element JSON array with its brackets cut off."""
    key = F.to_json(F.array(name))
    val = F.to_json(F.array(value))
    return F.concat(F.substring(key, 2, F.length(key) - 2), F.lit(":"), F.substring(val, 2, F.length(val) - 2))


def file_headers(rows: DataFrame, schema: StructType, keys: Sequence[str] = ("source_file",)) -> DataFrame:
    """One row per file: its header names, the place of each contract field (0: none), the places of unknown names."""
    known = [f.name for f in schema.fields]
    first = F.regexp_replace("value", "^" + BYTE_ORDER_MARK, "")
    named = rows.where("block = 0 AND n = 1").select(*keys, _header_names(first).alias("_hdr"))
    n_h = F.size("_hdr")
    unknown = F.filter(
        F.sequence(F.lit(1), F.greatest(n_h, F.lit(1))),
        lambda i: (i <= n_h) & ~F.array_contains(F.array(*[F.lit(n) for n in known]), F.element_at("_hdr", i)),
    )
    return named.select(*keys, "_hdr", *[F.array_position("_hdr", n).cast("int").alias(f"_p{i}") for i, n in enumerate(known)], unknown.alias("_unknown"))


def map_records(rows: DataFrame, schema: StructType, keys: Sequence[str] = ("source_file",), carry: Sequence[str] = ()) -> DataFrame:
    """Records mapped by each file's header to ``schema`` plus ``_rescued_data``; ``carry``: other columns to keep."""
    known = [f.name for f in schema.fields]
    body = rows.where("NOT (block = 0 AND n = 1)").where(F.length(F.trim("value")) > 0)
    body = body.join(file_headers(rows, schema, keys), list(keys)).withColumn("_c", _split(F.col("value")))
    n_h, cells = F.size("_hdr"), F.col("_c")
    ext = F.transform(
        F.filter(F.sequence(n_h + 1, F.greatest(F.size(cells), n_h + 1)), lambda i: (i <= F.size(cells)) & _cell(cells, i).isNotNull()),
        lambda i: _fragment(F.concat(F.lit(EXTRA_PREFIX), (i - n_h).cast("string")), _cell(cells, i)),
    )
    unk = F.transform(F.filter("_unknown", lambda i: _cell(cells, i).isNotNull()), lambda i: _fragment(F.element_at("_hdr", i), _cell(cells, i)))
    # lambdas only for records that have such cells
    odd = F.when((F.size("_unknown") > 0) | (F.size(cells) > n_h), F.array_join(F.concat(unk, ext), ","))
    kept = [*keys, *carry]
    # as SQL text: a projection of some hundred expressions is then built with one call for each
    raw = [f"CASE WHEN _p{i} > 0 THEN try_element_at(_c, _p{i}) END AS _r{i}" for i in range(len(known))]
    body = body.select(*kept, F.when(F.length(odd) > 0, odd).alias("_odd"), *[F.expr(x) for x in raw])
    values = body.selectExpr(*kept, "_odd", *[f"{_VALUE.format(r=f'_r{i}')} AS _v{i}" for i in range(len(known))])
    typed, bad = [], []
    for i, f in enumerate(schema.fields):
        if isinstance(f.dataType, StringType):
            typed.append(f"_v{i} AS `{f.name}`")
            continue
        cast, name = f"try_cast(_v{i} AS {f.dataType.simpleString()})", json.dumps(f.name)
        typed.append(f"{cast} AS `{f.name}`")
        bad.append(f"CASE WHEN _v{i} IS NOT NULL AND {cast} IS NULL THEN concat('{name}:', substring(to_json(array(_v{i})), 2, length(to_json(array(_v{i}))) - 2)) END")
    text = f"concat_ws(',', {', '.join([*bad, '_odd'])})"
    return values.selectExpr(*kept, *typed, f"CASE WHEN {text} != '' THEN concat('{{', {text}, '}}') END AS _rescued_data")


def parse_by_header(files: DataFrame, schema: StructType, text: str = "value", keep: tuple[str, ...] = ("source_file",)) -> DataFrame:
    """The same for files whose whole text is a cell: each is one range.  ``keep``: the columns that tell files apart."""
    lines = files.select(*keep, F.lit(0).cast("bigint").alias("block"), F.posexplode(F.split(F.col(text), LINE_END)).alias("ord", "value"))
    return map_records(records(number_lines(lines, [*keep, "block"]), keep), schema, keep)


def with_path_parts(df: DataFrame, path: str = "source_file") -> DataFrame:
    """Account from the directory, date and version from the name."""
    name = file_name(path)
    return df.withColumns(
        {
            "AccountName": account_from_path(path),
            "snapshot_date": date_from_file_name(name),
            "snapshot_version": version_from_file_name(name),
        }
    )


def stamp(df: DataFrame, run_id: str, schema_version: str, ts: Column | None = None) -> DataFrame:
    """Ingest time (one value per micro-batch, without zone like the
    rest of the data), contract version, run id."""
    return df.withColumns(
        {
            "snapshot_ts": ts if ts is not None else F.localtimestamp(),
            "schema_version": F.lit(schema_version),
            "run_id": F.lit(run_id),
        }
    )
