"""Type identity: representative rows, content keys, the lookup dimension and
first-seen per (account, type)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.expressions import content_key, inferred_number, normalised_text
from tidemark.schema import TYPE_ATTRIBUTES


def representative(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """One row per ``key``: the smallest ``order`` struct wins.

    A grouped ``min`` of a struct aggregates map-side before the shuffle, so a
    type seen in millions of rows costs one partial row per task, not a sort of
    all its rows in one task.  ``order`` must end in enough columns for a total
    order when ties would change the output.
    """
    fields = list(order)
    # distinct first: a hash aggregate, after which few rows are left for the min of structs (which sorts)
    df = df.select(key, *fields).distinct()
    return df.groupBy(key).agg(F.min(F.struct(*[F.col(c) for c in fields])).alias("_w")).select(
        key, *[F.col(f"_w.{c}").alias(c) for c in fields]
    )


def type_id_map(final: DataFrame, source_key: str = "source_type_id") -> DataFrame:
    """Per source type id the stable winner by normalised name, rarity,
    affinity, faction; its content key and inferred number."""
    ranked = final.select(
        source_key,
        normalised_text("name").alias("_name_norm"),
        "rarity",
        "affinity",
        "faction",
    )
    rep = representative(ranked, source_key, ["_name_norm", "rarity", "affinity", "faction"])
    return rep.select(
        content_key("_name_norm", "rarity", "affinity", "faction").alias("type_key"),
        inferred_number(source_key).alias("inferred_type_number"),
        F.col(source_key),
    )


def unseen(df: DataFrame, state: DataFrame | None, keys: Sequence[str]) -> DataFrame:
    """Rows whose key is not yet in ``state`` (all rows on a first run)."""
    if state is None:
        return df
    return df.join(state.select(*keys), on=list(keys), how="left_anti")


def incremental_id_map(final: DataFrame, state: DataFrame | None) -> DataFrame:
    """Append-only id map: only type ids not present in state are emitted."""
    return unseen(type_id_map(final), state, ["source_type_id"])


def attach_key(final: DataFrame, id_map: DataFrame, source_key: str = "source_type_id") -> DataFrame:
    """E5: every staged row with its type key (left join on the source type id).

    The id map has one row per type; AQE turns this into a broadcast join once
    the map's real size is known to be under the broadcast threshold.
    """
    m = id_map.select(source_key, "type_key")
    out = final.join(m, on=source_key, how="left")
    cols = [c for c in final.columns]
    pos = cols.index("entity_id") + 1 if "entity_id" in cols else 0
    ordered = cols[:pos] + ["type_key"] + cols[pos:]
    return out.select(*ordered)


def type_lookup(keyed: DataFrame, state: DataFrame | None = None, key: str = "type_key") -> DataFrame:
    """One row per key with its attributes — the earliest by normalised
    name, rarity, affinity, faction, then raw name (case variants of one name
    would otherwise give several rows per key)."""
    src = keyed.where(F.col(key).isNotNull()).select(
        key, normalised_text("name").alias("_name_norm"), "rarity", "affinity", "faction", "name"
    )
    rep = representative(src, key, ["_name_norm", "rarity", "affinity", "faction", "name"])
    out = rep.select(key, *TYPE_ATTRIBUTES)
    return unseen(out, state, [key])


def first_seen(
    keyed: DataFrame,
    registry: DataFrame,
    state: DataFrame | None = None,
    key: str = "type_key",
) -> DataFrame:
    """First in-order snapshot in which an account holds a type.

    Incremental runs read only snapshots above the account's own watermark
    (the highest order number already in state for that account) and skip
    (account, type) pairs already in state.  The winner per pair is the
    smallest (order number, ts, entity id) — a total order.
    """
    files = registry.where(~F.col("is_out_of_order")).select(
        "account", "source_file", "snapshot_order_no", "snapshot_ts"
    )
    if state is not None:
        marks = state.groupBy("account").agg(F.max("first_seen_snapshot_order_no").alias("_mark"))
        files = (
            files.join(marks, on="account", how="left")
            .where(F.col("snapshot_order_no") > F.coalesce(F.col("_mark"), F.lit(0)))
            .drop("_mark")
        )
    rows = keyed.select("account", "source_file", key, "entity_id").join(files, on=["account", "source_file"], how="inner")
    if state is not None:
        rows = rows.join(state.select("account", key), on=["account", key], how="left_anti")
    best = rows.groupBy("account", key).agg(
        F.min(F.struct("snapshot_order_no", "snapshot_ts", "entity_id", "source_file")).alias("_f")
    )
    return best.select(
        "account",
        key,
        F.col("_f.snapshot_ts").alias("first_seen_ts"),
        F.col("_f.entity_id").alias("first_entity_id"),
        F.col("_f.source_file").alias("first_seen_source_file"),
        F.col("_f.snapshot_order_no").alias("first_seen_snapshot_order_no"),
    )
