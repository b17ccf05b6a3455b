"""Incremental runs over stored state: bronze rows of new files in, one commit out.

``run_batch`` brings seven models up to date together: type id map, lookup,
registry, first seen, history, events (obtained, upgrades) and the roll-up.
Every model reads what its new rows touch and nothing else:

* id map and lookup append types that are not there yet;
* the registry skips files it has, and continues the accounts' order numbers;
* history continues from ``marks`` (each account's last in-order file) and from
  ``tail``, the latest version of each entity.  The new snapshots and the open
  versions of their accounts go through the one-pass history together; versions
  that are no longer the latest are appended to ``closed`` and never read again
  for history;
* events come from the new versions and their predecessors, which are in
  ``tail``;
* the roll-up is made anew for the accounts of the run.

All of it becomes visible with one commit of the store; a run that fails, or
that another run has overtaken, leaves nothing behind.  Running a batch again
changes nothing, since its files are registered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.operators import events, history, identity, registry, rollup
from tidemark.operators.history import HISTORY_COLUMNS
from tidemark.operators.store import Layout, Store
from tidemark.plans.silver import Silver
from tidemark.schema import ENTITY_KEYS
from tidemark.session import write_layer

#: Buckets of a table with a row per entity or type of an account: accounts' shares, and parts of each share.
COARSE, FINE = 64, 4


def layouts(coarse: int = COARSE, fine: int = FINE) -> dict[str, Layout]:
    """How the models are spread; small models in fewer buckets."""
    wide = lambda *by: Layout("account", by, coarse, fine)
    return {
        "id_map": Layout("source_type_id", coarse=1, fine=1),
        "lookup": Layout("type_key", coarse=1, fine=1),
        "registry": wide("source_file"),
        "marks": Layout("account", coarse=coarse, fine=1),
        "first_seen": wide("type_key"),
        "tail": wide("entity_id"),
        "closed": wide("entity_id"),
        "obtained": wide("entity_id"),
        "upgrades": wide("entity_id"),
        "gold": wide("type_key"),
    }


def open_store(spark: SparkSession, root: str, keep: int = 2, coarse: int = COARSE, fine: int = FINE) -> Store:
    """The store of ``run_batch``.  The numbers of buckets belong to the data: open it with the same ones."""
    return Store(spark, root, layouts(coarse, fine), keep)


def run_batch(store: Store, bronze: DataFrame, tiebreak: str | None = None) -> int:
    """One run over the bronze rows of a batch; returns the committed version."""
    spark, change = store.spark, store.begin()
    final = write_layer(spark, Silver(bronze, tiebreak).final, "run-final")

    held = change.read("id_map")
    ids = change.append("id_map", identity.incremental_id_map(final, held))
    keyed = identity.attach_key(final, ids if held is None else held.unionByName(ids))
    files = change.append("registry", registry.register_snapshots(keyed, change.rows_of("registry", final)))
    keyed = write_layer(spark, keyed.join(files.select("account", "source_file"), ["account", "source_file"], "left_semi").select(keyed.columns), "run-keyed")
    change.append("lookup", identity.type_lookup(keyed, change.read("lookup")))

    sequence = write_layer(spark, registry.in_order_sequence(files, change.rows_of("marks", files)), "run-sequence")
    last = sequence.groupBy("account").agg(F.max(F.struct("seq", "snapshot_ts")).alias("l"))
    seen = change.rows_of("first_seen", files)
    change.append("first_seen", identity.first_seen(keyed, registry.with_effect(files, sequence), seen))
    change.merge("marks", last.select("account", "l.seq", "l.snapshot_ts"), ["account"])

    tail = change.rows_of("tail", sequence)
    if tail is None:
        tail = spark.createDataFrame([], history.scd2_backfill(keyed, sequence).schema)
    tail = write_layer(spark, tail, "run-tail")
    versions = write_layer(spark, history.scd2_backfill(keyed, sequence, prior=tail.where("valid_to IS NULL")), "run-versions")
    back = tail.where("valid_to IS NOT NULL").join(versions.select(*ENTITY_KEYS).distinct(), ENTITY_KEYS, "left_semi")
    newest = Window.partitionBy(*ENTITY_KEYS).orderBy(F.col("seq").desc())
    ranked = versions.withColumn("_rn", F.row_number().over(newest))
    change.append("closed", ranked.where("_rn > 1").select(*HISTORY_COLUMNS).unionByName(back.select(*HISTORY_COLUMNS)))
    change.merge("tail", ranked.where("_rn = 1").select(*HISTORY_COLUMNS), ENTITY_KEYS)

    fresh = versions.join(tail.select(*ENTITY_KEYS), ENTITY_KEYS, "left_anti")
    change.append("obtained", events.first_version_events(fresh))
    compared = versions.withColumn("_new", ~F.col("_prior")).drop("_prior").unionByName(back.withColumn("_new", F.lit(False)).select(*HISTORY_COLUMNS, "_new"))
    change.append("upgrades", events.increases(compared))

    of = lambda table: change.rows_of(table, files)
    scd2 = history.scd2_view(of("closed").unionByName(of("tail")))
    change.merge("gold", rollup.account_type_state(scd2, of("obtained"), of("upgrades"), of("first_seen"), change.read("lookup")), ["account", "type_key"])
    return change.commit()


def stored_history(store: Store) -> DataFrame:
    """The history view over all versions."""
    return history.scd2_view(store.read("closed").unionByName(store.read("tail")))
