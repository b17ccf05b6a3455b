"""Data expectations as Spark jobs.

Each check returns its failing rows (or groups) as a DataFrame.  ``evaluate``
runs many checks that are declared as data (``Declared``): a layer's rows are
read once and become, for every check that a row bears on, one (check, key)
pair; pairs are counted with map-side sums, and the counts give every check's
failures.  NULL handling: accepted values, relationships and expressions let
NULL pass (``null_is_failure`` turns that off for expressions); uniqueness
ignores rows with a NULL key.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# fixed values: severities and statuses
WARN, ERROR = "warn", "error"
PASS, FAIL = "pass", "fail"


def not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """I1 for many columns in one pass: (column_name, failures) per column."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("bigint").alias("failures")) for c in columns])
    return counts.select(F.inline(pairs))


def unique(df: DataFrame, columns: Sequence[str], where: str | Column | None = None) -> DataFrame:
    """Key groups seen more than once (rows with a NULL key ignored)."""
    cols = list(columns)
    src = (df.where(where) if where is not None else df).dropna(subset=cols)
    return src.groupBy(*cols).agg(F.count(F.lit(1)).alias("n_records")).where(F.col("n_records") > 1)


def accepted_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """I4: values outside the accepted list, with their counts; NULL passes."""
    c = F.col(column)
    return df.where(c.isNotNull() & ~c.isin(*values)).groupBy(column).agg(F.count(F.lit(1)).alias("n_records"))


def relationship(df: DataFrame, column: str, ref: DataFrame, field: str) -> DataFrame:
    """Child rows whose non-NULL key has no parent (a left anti join)."""
    parents = ref.select(F.col(field).alias(column)).where(F.col(column).isNotNull())
    return df.where(F.col(column).isNotNull()).join(parents, on=column, how="left_anti")


def expression_is_true(
    df: DataFrame,
    expression: str,
    column: str | None = None,
    null_is_failure: bool = False,
) -> DataFrame:
    """Rows where the expression is false.  With ``column`` the expression
    is a suffix applied to it (``'>= 0'``, ``'BETWEEN 1 AND 18'``)."""
    text = f"{column} {expression}" if column else expression
    cond = F.expr(text)
    failing = (~cond | cond.isNull()) if null_is_failure else ~cond
    return df.where(failing)


@dataclass(frozen=True)
class Declared:
    """One check as data.

    Without ``keys``: rows for which ``fails`` (SQL) is true are failures.  With
    ``keys`` alone: key groups of more than one row are; rows with a NULL key, or
    outside ``where``, do not count.  With ``parent`` (layer, column): rows whose
    only key is no value of that column are.
    """

    name: str
    severity: str = ERROR
    fails: str | None = None
    keys: tuple[str, ...] = ()
    where: str | None = None
    parent: tuple[str, str] | None = None


def evaluate(layers: Mapping[str, DataFrame], declared: Mapping[str, Sequence[Declared]]) -> DataFrame:
    """(layer, check_name, severity, failures, status) of all declared checks.

    Failures are rows, for uniqueness key groups; a failing ``warn`` check reports
    ``warn``, a failing ``error`` check ``fail``."""
    spark = next(iter(layers.values())).sparkSession
    pair = lambda i, key: F.struct(F.lit(i).alias("check"), key.alias("key"))
    listed, pairs, parents = [], None, None
    for layer, checks in declared.items():
        bearing = []
        for c in checks:
            i = len(listed)
            listed.append((i, layer, c.name, c.severity, bool(c.keys), c.parent is not None))
            if not c.keys:
                bearing.append(F.when(F.expr(c.fails), pair(i, F.lit(""))))
                continue
            complete = F.expr(" AND ".join([*[f"{k} IS NOT NULL" for k in c.keys], *([f"({c.where})"] if c.where else [])]))
            bearing.append(F.when(complete, pair(i, F.to_json(F.struct(*[F.col(k).alias(str(n)) for n, k in enumerate(c.keys)])))))
            if c.parent:
                column = F.col(c.parent[1])
                held = layers[c.parent[0]].where(column.isNotNull()).select(F.lit(i).alias("check"), F.to_json(F.struct(column.alias("0"))).alias("key")).distinct()
                parents = held if parents is None else parents.unionByName(held)
        rows = layers[layer].select(F.explode(F.array(*bearing)).alias("p")).where("p IS NOT NULL").select("p.*")
        pairs = rows if pairs is None else pairs.unionByName(rows)
    counts = pairs.groupBy("check", "key").agg(F.count(F.lit(1)).alias("n"))
    if parents is not None:
        counts = counts.join(parents.withColumn("there", F.lit(True)), ["check", "key"], "left")
    else:
        counts = counts.withColumn("there", F.lit(None).cast("boolean"))
    table = spark.createDataFrame(listed, "check int, layer string, check_name string, severity string, keyed boolean, child boolean")
    found = counts.join(F.broadcast(table), "check").groupBy("check").agg(  # the declared checks: a table of this program
        F.sum(F.when(F.col("child"), F.when(F.col("there").isNull(), F.col("n"))).when(F.col("keyed"), (F.col("n") > 1).cast("bigint")).otherwise(F.col("n"))).alias("n")
    )
    out = table.join(found, "check", "left").withColumn("failures", F.coalesce("n", F.lit(0)).cast("bigint"))
    status = F.when(F.col("failures") == 0, F.lit(PASS)).when(F.col("severity") == WARN, F.lit(WARN)).otherwise(F.lit(FAIL))
    return out.select("layer", "check_name", "severity", "failures", status.alias("status"))


def overlapping_windows(scd2: DataFrame, keys: Sequence[str] = ("account", "entity_id")) -> DataFrame:
    """I8: a closed version that ends after the next version starts."""
    w = Window.partitionBy(*keys).orderBy("valid_from", "scd_id")
    ordered = scd2.select(*keys, "valid_from", "valid_to", F.lead("valid_from").over(w).alias("next_valid_from"))
    return ordered.where(
        F.col("valid_to").isNotNull() & F.col("next_valid_from").isNotNull() & (F.col("valid_to") > F.col("next_valid_from"))
    )


def obtained_mismatch(
    events: DataFrame,
    scd2: DataFrame,
    days: int,
    now: Column | DataFrame,
    keys: Sequence[str] = ("account", "entity_id"),
) -> DataFrame:
    """Recent obtained events whose time is not the entity's first
    version start.  ``now`` is passed in (no clock inside a compared query):
    a literal column, or a one-row table with a ``now_ts`` column."""
    keys = list(keys)
    recent = events.select(*keys, "event_ts")
    if isinstance(now, DataFrame):
        recent = recent.crossJoin(F.broadcast(now.select("now_ts")))
        now = F.col("now_ts")
    recent = recent.where(F.col("event_ts") >= now - F.expr(f"INTERVAL {days} DAYS")).select(*keys, "event_ts")
    firsts = scd2.join(recent.select(*keys).distinct(), on=keys, how="left_semi").groupBy(*keys).agg(
        F.min("valid_from").alias("min_valid_from")
    )
    return recent.join(firsts, on=keys, how="inner").where(F.col("event_ts") != F.col("min_valid_from"))


def attribute_conflicts(df: DataFrame, key: str, columns: dict[str, Column]) -> DataFrame:
    """For keys with more than one distinct value in an attribute, a row per
    value: (key, attribute, value, n_rows, n_values).  Values are counted and
    joined, never collected, however many a key has; NULLs do not count."""
    values = F.array(*[F.struct(F.lit(n).alias("attribute"), c.cast("string").alias("value")) for n, c in columns.items()])
    counts = df.select(key, F.inline(values)).where(F.col("value").isNotNull()).groupBy(key, "attribute", "value").agg(F.count(F.lit(1)).alias("n_rows"))
    several = counts.groupBy(F.col(key).alias("_key"), F.col("attribute").alias("_attribute")).agg(F.count(F.lit(1)).alias("n_values")).where(F.col("n_values") > 1)
    same = F.col(key).eqNullSafe(F.col("_key")) & (F.col("attribute") == F.col("_attribute"))
    return counts.join(several, same).select(key, "attribute", "value", "n_rows", "n_values")
