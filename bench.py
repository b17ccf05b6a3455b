"""Bench: headline stages on the lineitem-derived snapshot fixture.

Each stage reads the previous stage's written table (as the pipeline's layers
are materialised in production) and forces full output with the ``noop``
sink or a parquet write.  Prints one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from tidemark.operators import events, history, identity, quality, registry, rollup  # noqa: E402
from tidemark.session import get_session  # noqa: E402
from tidemark.sources.fixture import TIEBREAK, lineitem_snapshots  # noqa: E402
from tidemark.sources.tables import load_table  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
REPEAT = int(os.environ.get("BENCH_REPEAT", "3"))


def noop(df):
    df.write.format("noop").mode("overwrite").save()


def main():
    spark = get_session(master=f"local[{CPUS}]", shuffle_partitions=max(8, CPUS * 2), app="tidemark-bench")
    # classify writes with a deep CASE ladder, see session.write_layer
    spark.conf.set("spark.sql.constraintPropagation.enabled", "false")
    ckpt = spark.conf.get("spark.checkpoint.dir", None) or tempfile.mkdtemp(prefix="tidemark-bench-")
    work = tempfile.mkdtemp(prefix="bench-", dir=ckpt if ckpt.startswith("/") else None)
    sf = os.path.basename(SF_DIR.rstrip("/")).replace("sf", "")

    def table(name):
        return spark.read.parquet(f"{work}/{name}")

    def write(df, name):
        df.write.mode("overwrite").parquet(f"{work}/{name}")

    # setup (untimed): the bronze table.  The driver's parquet files hold one
    # row group each, which would put the whole map side in one task; a real
    # bronze table is many files, so it is written spread over files here.
    lineitem = load_table(spark, SF_DIR, "lineitem")
    bronze_src = lineitem_snapshots(lineitem.repartition(CPUS * 2, "l_orderkey"))
    write(bronze_src.withColumn(TIEBREAK, F.col(TIEBREAK)), "bronze")
    from tidemark.sources.fixture import events_snapshots
    from tidemark.sources.landing import write_landing
    from tidemark.streaming.ingest import run_ingest

    ev_bronze = events_snapshots(load_table(spark, SF_DIR, "events"))
    landing = f"{work}/landing"
    n_files = write_landing(ev_bronze, landing, partitions=CPUS * 2).count()
    ingest_runs = iter(range(1000))

    def stage_ingest():
        i = next(ingest_runs)
        run_ingest(spark, landing, f"{work}/ingest{i}/bronze", f"{work}/ingest{i}/ckpt", f"{work}/ingest{i}/log",
                   run_id=f"bench-{i}")

    def stage_classify_dedupe():
        bronze = table("bronze")
        staged = quality.stage(bronze, keep=[TIEBREAK])
        final = quality.dedupe_winners(quality.valid(quality.classify(staged)), order=quality.dedupe_order(TIEBREAK))
        write(final.drop(TIEBREAK), "final")

    def stage_registry():
        final = table("final")
        keyed = identity.attach_key(final, identity.type_id_map(final))
        write(keyed, "keyed")
        write(registry.register_snapshots(table("keyed")), "registry")

    def stage_scd2():
        seq = registry.in_order_sequence(table("registry"))
        write(history.scd2_backfill(table("keyed"), seq), "history")

    def stage_scd2_step():
        # history of every snapshot but each account's last, then one step with the last
        seq = registry.in_order_sequence(table("registry"))
        last = seq.groupBy("account").agg(F.max("seq").alias("_last"))
        rows = table("keyed").join(seq.select("account", "source_file", "seq"), ["account", "source_file"])
        rows = rows.join(last, "account")
        prev = history.scd2_backfill(rows.where(F.col("seq") < F.col("_last")).drop("seq", "_last"), seq)
        write(prev, "history_prev")
        cur = rows.where(F.col("seq") == F.col("_last")).drop("_last")
        write(cur, "current_last")
        t = time.time()
        noop(history.scd2_step(table("history_prev"), table("current_last")))
        return time.time() - t

    def stage_upgrades():
        noop(events.upgrade_events(history.scd2_view(table("history"))))

    def stage_rollup():
        scd2 = history.scd2_view(table("history"))
        keyed = table("keyed")
        reg = table("registry")
        gold = rollup.account_type_state(
            scd2,
            events.first_version_events(scd2),
            events.upgrade_events(scd2),
            identity.first_seen(keyed, reg),
            identity.type_lookup(keyed),
        )
        noop(gold)

    stages = [
        ("classify_dedupe", stage_classify_dedupe),
        ("snapshot_registry", stage_registry),
        ("scd2_backfill", stage_scd2),
        ("scd2_step", stage_scd2_step),
        ("upgrade_events", stage_upgrades),
        ("account_type_state", stage_rollup),
        ("available_now_ingest", stage_ingest),
    ]
    times: dict[str, list[float]] = {name: [] for name, _ in stages}
    for rep in range(REPEAT + 1):  # first pass is the warm-up
        for name, fn in stages:
            t = time.time()
            inner = fn()
            dt = inner if isinstance(inner, float) else time.time() - t
            if rep > 0:
                times[name].append(dt)
    med = {k: round(statistics.median(v), 3) for k, v in times.items()}
    out = {
        "metric": "snapshot_history_stages_total",
        "value": round(sum(med.values()), 3),
        "unit": "sec",
        "queries": med,
        "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
        "cpus": CPUS,
        "rows": spark.read.parquet(f"{SF_DIR}/lineitem.parquet").count(),
        "ingest_files": n_files,
    }
    print(json.dumps(out))


if __name__ == "__main__":
    main()
