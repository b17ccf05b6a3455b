"""Slowly-changing (SCD2) history with hard deletes.

A version has the number of the snapshot that opened it (``seq``, within its
account); its id is a hash of the entity and that number, so it does not
change when a file is ingested again and times move.

Two ways to the same table:

* ``scd2_backfill`` builds every version from all snapshots in one pass:
  windows per (account, entity) ordered by the account's snapshot sequence.
  A version starts when the previous observation is missing (first sight, or
  the entity was absent from the account's previous snapshot) or differs in
  a tracked column; it ends at the ingest time of the account's snapshot after
  its last observation, or stays open when there is none.
  With ``prior``, the open versions of earlier runs, it continues them: only the
  new snapshots and the accounts' open versions are read, and closed versions
  are final.
* ``scd2_step`` applies one batch of current rows to stored history: unchanged
  keys keep their open row, changed keys close it and open a new one, new keys
  insert, and open keys missing from an account present in the batch close.

Folding ``scd2_step`` over an account's snapshots in order gives the same rows
as ``scd2_backfill`` (tests check this against a plain-Python replay).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.expressions import row_changed, tracked_struct, version_id
from tidemark.schema import ENTITY_KEYS, HISTORY_KEYS, TRACKED

HISTORY_COLUMNS = [*HISTORY_KEYS, *TRACKED, "source_file", "seq", "valid_from", "valid_to", "scd_id"]


def scd2_backfill(
    keyed: DataFrame,
    sequence: DataFrame,
    keys: Sequence[str] = ENTITY_KEYS,
    tracked: Sequence[str] = TRACKED,
    carry: Sequence[str] = ("type_key", "source_type_id", "source_file"),
    scope: str = "account",
    change: str = "exact",
    prior: DataFrame | None = None,
) -> DataFrame:
    """All versions from all in-order snapshots.

    ``prior`` holds open versions (history rows) of accounts with new snapshots.
    They stand for the account's last snapshot before those of ``sequence`` (whose
    numbers continue), so each is kept open, closed, or followed by a new version;
    the result has them and all new versions.

    ``change="exact"`` compares the tracked columns as a struct (null-safe);
    ``change="hash"`` (J3) compares one 64-bit hash of the tracked values and
    their NULL flags instead, so the windows carry a long instead of a wide
    struct; a change is missed only on a hash collision.

    ``sequence`` is ``registry.in_order_sequence``: (account, source_file, seq,
    snapshot_ts, next_ts).  Rows of late files are dropped by the inner join.
    Every window below shares one partitioning (the entity keys) and one
    order (seq), so the plan has one shuffle and one sort for all of them;
    an entity's group holds at most one row per snapshot of its account.
    """
    keys, tracked = list(keys), list(tracked)
    cols = list(dict.fromkeys([*keys, *carry, "source_file", *tracked]))
    rows = keyed.select(*cols).join(sequence, on=[scope, "source_file"], how="inner")
    rows = rows.withColumns({"_opened": F.col("seq"), "_prior": F.lit(False)})
    if prior is not None:
        # an open version as an observation in the snapshot before the account's first new one
        begin = sequence.groupBy(scope).agg(F.min(F.struct("seq", F.col("snapshot_ts").alias("ts"))).alias("_b"))
        held = prior.join(begin, scope).select(
            *cols, F.col("valid_from").alias("snapshot_ts"), F.col("seq").alias("_opened"), (F.col("_b.seq") - 1).alias("seq"), F.col("_b.ts").alias("next_ts"), F.lit(True).alias("_prior")
        )
        rows = rows.unionByName(held)
    w = Window.partitionBy(*keys).orderBy("seq")
    if change == "hash":
        vals = F.xxhash64(*[x for c in tracked for x in (F.col(c), F.col(c).isNull())])
    else:
        vals = tracked_struct(tracked)
    prev_seq, next_seq = F.lag("seq").over(w), F.lead("seq").over(w)
    prev_vals, next_vals = F.lag(vals).over(w), F.lead(vals).over(w)
    marked = rows.withColumns(
        {
            "_start": prev_seq.isNull() | (prev_seq != F.col("seq") - 1) | row_changed(prev_vals, vals),
            "_end": next_seq.isNull() | (next_seq != F.col("seq") + 1) | row_changed(next_vals, vals),
        }
    )
    # Boundary rows alternate per entity: start, end, start, end ... (a row can
    # be both).  After keeping only those rows (the filter keeps partitioning
    # and order, so no new sort), a start that is not also an end is closed by
    # the next boundary row, read with ``lead`` — O(n) per entity, where a
    # frame to the end of the partition would be O(n^2).
    bounds = marked.where(F.col("_start") | F.col("_end"))
    closing = F.when(F.col("_end"), F.col("next_ts")).otherwise(F.lead("next_ts").over(w))
    versions = bounds.withColumn("_close", closing).where(F.col("_start"))
    return versions.select(
        *HISTORY_KEYS,
        *tracked,
        "source_file",
        F.col("_opened").alias("seq"),
        F.col("snapshot_ts").alias("valid_from"),
        F.col("_close").alias("valid_to"),
        version_id(keys, "_opened").alias("scd_id"),
        *([F.col("_prior")] if prior is not None else []),
    )


def scd2_step(
    history: DataFrame | None,
    current: DataFrame,
    as_of: str = "snapshot_ts",
    keys: Sequence[str] = ENTITY_KEYS,
    tracked: Sequence[str] = TRACKED,
    scope: str = "account",
    close_missing: bool = True,
) -> DataFrame:
    """One snapshot step.

    ``current`` holds the latest rows per entity with their snapshot's number
    ``seq`` and an ``as_of`` column (the version time).  Open rows whose
    ``scope`` (account) appears in ``current`` but whose key does not are
    closed at that account's ``as_of`` (hard delete).  Closed history rows pass
    through untouched; only open rows take part in the join.
    """
    keys, tracked = list(keys), list(tracked)
    carried = [c for c in HISTORY_KEYS if c not in keys] + ["source_file"]
    cur = current.select(*keys, *carried, *tracked, "seq", F.col(as_of).alias("_as_of"))
    if history is None:
        return cur.select(
            *HISTORY_KEYS,
            *tracked,
            "source_file",
            "seq",
            F.col("_as_of").alias("valid_from"),
            F.lit(None).cast("timestamp_ntz").alias("valid_to"),
            version_id(keys, "seq").alias("scd_id"),
        )

    cols = [*HISTORY_KEYS, *tracked, "source_file", "seq"]
    hist = history.select(*cols, "valid_from", "valid_to", "scd_id")
    closed = hist.where(F.col("valid_to").isNotNull())
    open_ = hist.where(F.col("valid_to").isNull())
    if close_missing:
        # one row per account in the batch; AQE broadcasts it when it is small
        scope_times = cur.groupBy(scope).agg(F.max("_as_of").alias("_scope_as_of"))
        open_ = open_.join(scope_times, on=scope, how="left")
    else:
        open_ = open_.withColumn("_scope_as_of", F.lit(None).cast("timestamp_ntz"))

    o, c = open_.alias("o"), cur.alias("c")
    j = o.join(c, on=[F.col(f"o.{k}") == F.col(f"c.{k}") for k in keys], how="full_outer")
    o_present = F.col(f"o.{keys[0]}").isNotNull()
    c_present = F.col(f"c.{keys[0]}").isNotNull()
    changed = row_changed(tracked_struct(tracked, "o."), tracked_struct(tracked, "c."))
    # the stored open version: kept open, closed by a change, or closed by absence
    old_to = F.when(c_present & changed, F.col("c._as_of")).when(~c_present, F.col("o._scope_as_of"))
    old = F.when(
        o_present,
        F.struct(
            *[F.col(f"o.{x}").alias(x) for x in cols],
            F.col("o.valid_from").alias("valid_from"),
            old_to.alias("valid_to"),
            F.col("o.scd_id").alias("scd_id"),
        ),
    )
    # a new version from the batch: the key is new or its tracked values changed
    new_vf = F.col("c._as_of")
    new = F.when(
        c_present & (~o_present | changed),
        F.struct(
            *[F.col(f"c.{x}").alias(x) for x in cols],
            new_vf.alias("valid_from"),
            F.lit(None).cast("timestamp_ntz").alias("valid_to"),
            version_id([F.col(f"c.{k}") for k in keys], "c.seq").alias("scd_id"),
        ),
    )
    stepped = j.select(F.explode(F.array(old, new)).alias("_v")).where(F.col("_v").isNotNull()).select("_v.*")
    return closed.unionByName(stepped)


def valid_at(history: DataFrame, ts: Column) -> DataFrame:
    """The versions in effect at ``ts``.  (What was known at a time is a matter of
    the rows that a history is made of: ``Silver(..., known_at=...)``.)"""
    return history.where((F.col("valid_from") <= ts) & (F.col("valid_to").isNull() | (F.col("valid_to") > ts)))


def scd2_view(history: DataFrame, keys: Sequence[str] = ENTITY_KEYS, tracked: Sequence[str] = TRACKED) -> DataFrame:
    """Consumer view with is_current and is_deleted (the entity has no
    open version; set on every version of a deleted entity)."""
    w = Window.partitionBy(*keys)
    has_open = F.max(F.col("valid_to").isNull().cast("int")).over(w)
    return history.select(
        *HISTORY_KEYS,
        *tracked,
        "valid_from",
        "valid_to",
        F.col("valid_to").isNull().alias("is_current"),
        (has_open == 0).alias("is_deleted"),
        "scd_id",
    )


def still_owned(scd2: DataFrame, keys: Sequence[str] = ENTITY_KEYS) -> DataFrame:
    """History of entities that still have an open version (semi join)."""
    return scd2.join(scd2.where(F.col("is_current")).select(*keys), on=list(keys), how="left_semi")
