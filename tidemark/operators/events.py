"""Events from history: first versions ("obtained") and measure increases."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions.expressions import EVENT_ID_SEPARATOR, ntz
from tidemark.schema import ENTITY_KEYS, UPGRADE_MEASURES

# fixed value: event time before any data
EPOCH_TS = "1900-01-01 00:00:00"


def event_cutoff(state: DataFrame | None, column: str = "event_ts", scope: str | None = "account") -> DataFrame:
    """The latest event time in state for each ``scope`` (account), so that an
    account whose data arrive later than others' loses no event.  Without state,
    or with ``scope=None``, one row: the latest time of all, or 1900-01-01."""
    if state is None:
        return state_free_cutoff()
    if scope is None:
        return state.agg(F.coalesce(F.max(column), ntz(EPOCH_TS)).alias("cutoff_ts"))
    return state.groupBy(scope).agg(F.max(column).alias("cutoff_ts"))


def state_free_cutoff() -> DataFrame:
    return SparkSession.getActiveSession().range(1).select(ntz(EPOCH_TS).alias("cutoff_ts"))


def _with_cutoff(df: DataFrame, cutoff: DataFrame) -> DataFrame:
    """``cutoff_ts`` beside each row: by the cutoff's scope column (1900-01-01 for
    a scope without one), or from its only row, broadcast as it is one by construction."""
    scope = [c for c in cutoff.columns if c != "cutoff_ts"]
    if not scope:
        return df.crossJoin(F.broadcast(cutoff.select("cutoff_ts")))
    return df.join(cutoff, on=scope, how="left").withColumn("cutoff_ts", F.coalesce("cutoff_ts", ntz(EPOCH_TS)))


def _after(df: DataFrame, cutoff: DataFrame | None, column: str) -> DataFrame:
    """Rows with ``column`` above the cutoff."""
    if cutoff is None:
        return df
    return _with_cutoff(df, cutoff).where(F.col(column) > F.col("cutoff_ts")).drop("cutoff_ts")


def first_version_events(
    scd2: DataFrame,
    cutoff: DataFrame | None = None,
    keys: Sequence[str] = ENTITY_KEYS,
    type_col: str = "type_key",
) -> DataFrame:
    """The first version of each entity as an event (no earlier version
    exists), when it starts after the cutoff.

    The "no earlier version" anti join with an inequality is quadratic per
    entity; the equal result is ``row_number() = 1`` by (valid_from, scd_id).
    """
    w = Window.partitionBy(*keys).orderBy("valid_from", "scd_id")
    rows = scd2.select(*keys, type_col, "valid_from", "scd_id")
    if cutoff is not None:
        # only entities with something new, and of them only those without anything older
        new, older = _split_at(rows, cutoff, keys)
        rows = new.join(older.select(*keys), on=list(keys), how="left_anti")
    first = rows.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1)
    return first.select(
        F.col("scd_id").alias("event_id"),
        "scd_id",
        *keys,
        type_col,
        F.col("valid_from").alias("event_ts"),
    )


def changed_since(scd2: DataFrame, cutoff: DataFrame, keys: Sequence[str] = ENTITY_KEYS) -> DataFrame:
    """Entities with a version starting after the cutoff."""
    return _after(scd2.select(*keys, "valid_from"), cutoff, "valid_from").select(*keys).distinct()


def _split_at(scd2: DataFrame, cutoff: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(versions after the cutoff, earlier versions of the same entities); history of other entities is not moved."""
    tagged = _with_cutoff(scd2, cutoff)
    new = tagged.where(F.col("valid_from") > F.col("cutoff_ts")).drop("cutoff_ts")
    older = tagged.where(F.col("valid_from") <= F.col("cutoff_ts")).drop("cutoff_ts")
    return new.select(scd2.columns), older.join(changed_since(scd2, cutoff, keys), on=list(keys), how="left_semi").select(scd2.columns)


def latest_versions(df: DataFrame, n: int, keys: Sequence[str] = ENTITY_KEYS) -> DataFrame:
    """The ``n`` latest versions per entity (planned as a WindowGroupLimit)."""
    w = Window.partitionBy(*keys).orderBy(F.col("valid_from").desc(), F.col("scd_id").desc())
    return df.withColumn("rn_desc", F.row_number().over(w)).where(F.col("rn_desc") <= n)


def with_previous(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = ENTITY_KEYS) -> DataFrame:
    """Previous value of each column along the entity's versions; all lags
    share one window, hence one sort."""
    w = Window.partitionBy(*keys).orderBy("valid_from", "scd_id")
    return df.withColumns({f"old_{c}": F.lag(c).over(w) for c in columns})


def unpivot_pairs(df: DataFrame, measures: Sequence[tuple[str, str]], keep: Sequence[str]) -> DataFrame:
    """One row per measure with (upgrade_type, old_value, new_value)."""
    pairs = F.array(
        *[
            F.struct(
                F.lit(label).alias("upgrade_type"),
                F.col(f"old_{c}").cast("int").alias("old_value"),
                F.col(c).cast("int").alias("new_value"),
            )
            for label, c in measures
        ]
    )
    return df.select(*keep, F.inline(pairs))


def upgrade_events(
    scd2: DataFrame,
    measures: Sequence[tuple[str, str]] = UPGRADE_MEASURES,
    cutoff: DataFrame | None = None,
    keys: Sequence[str] = ENTITY_KEYS,
    type_col: str = "type_key",
    across_gaps: bool = True,
) -> DataFrame:
    """A monitored measure rose from one version to the next.

    With a cutoff only versions after it produce events, and only entities that
    have one are read: their new versions and the last one before (every new
    version is compared, not only the latest).  ``across_gaps``: compare also
    with a version that ended before this one began (the entity was gone
    meanwhile)."""
    cols = [*keys, type_col, "valid_from", "valid_to", "scd_id", *[c for _, c in measures]]
    base = scd2.select(*dict.fromkeys(cols))
    if cutoff is None:
        return increases(base.withColumn("_new", F.lit(True)), measures, keys, type_col, across_gaps)
    new, older = _split_at(base, cutoff, keys)
    before = latest_versions(older, 1, keys).select(base.columns)
    return increases(new.withColumn("_new", F.lit(True)).unionByName(before.withColumn("_new", F.lit(False))), measures, keys, type_col, across_gaps)


def increases(
    versions: DataFrame,
    measures: Sequence[tuple[str, str]] = UPGRADE_MEASURES,
    keys: Sequence[str] = ENTITY_KEYS,
    type_col: str = "type_key",
    across_gaps: bool = True,
) -> DataFrame:
    """Events of the versions flagged ``_new``, each compared with the entity's version before it."""
    prev = with_previous(versions, [*[c for _, c in measures], "valid_to"], keys).where(F.col("_new"))
    if not across_gaps:
        prev = prev.where(F.col("old_valid_to") == F.col("valid_from"))
    tall = unpivot_pairs(prev, measures, [*keys, type_col, "valid_from", "scd_id"])
    ev = tall.where(F.col("old_value").isNotNull() & (F.col("new_value") > F.col("old_value")))
    return ev.select(
        F.concat(F.col("scd_id"), F.lit(EVENT_ID_SEPARATOR), F.col("upgrade_type")).alias("event_id"),
        "scd_id",
        *keys,
        type_col,
        F.col("valid_from").alias("event_ts"),
        "upgrade_type",
        "old_value",
        "new_value",
        (F.col("new_value") - F.col("old_value")).alias("delta_value"),
    )
