"""Snapshot rows derived from the driver tables.

The reference ships no data, so bronze-shaped snapshot rows are derived from the
given tables; every derived row keeps flowing (bad rows are quarantined, not
dropped).  Both recipes exist once more as SQL text in ``plans.oracle`` so that
DuckDB can rebuild the same rows.

``events`` recipe (correctness):
  account  'acct' || lpad(user_id % accounts, 2, '0'); NULL where event_id % 97 = 0
  entity   k = digits of props as int, mod entities;   NULL where event_id % 101 = 0
  run_id   'run-' || snapshot_date;                     NULL where event_id % 103 = 0
  file     '<account text>/<snapshot_date>', one full snapshot per account and day
  rank     9 for every tenth error event (bad on purpose), else 1 + floor(value / 100)
  empower  event_id % 3; blessing grade floor(value) % 4; type id k * 10 + 1
  type     name 'type <k % 5>' (upper case for odd event ids), rarity 1 + k % 6,
           affinity 1 + k % 4, faction 1 + k % 18; other stats fixed per type
  ts       midnight after the snapshot date; version 0; tie-break event_id
  rescued  a JSON note on signup events with event_id % 7 = 0

``lineitem`` recipe (bench): account 'supp' || l_suppkey, entity l_partkey % 20,
one snapshot per (account, month of l_shipdate), rank from l_quantity, tie-break
(l_orderkey, l_linenumber, l_partkey).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.schema import BRONZE_COLUMNS, CONTRACT_VERSION

TIEBREAK = "record_id"


def _stats(k: Column) -> dict[str, Column]:
    """Stats held fixed per type (they are tracked, so only real changes show)."""
    i = lambda e: e.cast("int")
    d = lambda e: e.cast("double")
    return {
        "Level": i(F.lit(10) + k),
        "Rarity": i(F.lit(1) + k % 6),
        "Affinity": i(F.lit(1) + k % 4),
        "Faction": i(F.lit(1) + k % 18),
        "UsedT1MasScrolls": i(k % 4),
        "UnUsedT1MasScrolls": i(F.lit(3)),
        "UsedT2MasScrolls": i(k % 3),
        "UnUsedT2MasScrolls": i(F.lit(2)),
        "UsedT3MasScrolls": i(k % 2),
        "UnUsedT3MasScrolls": i(F.lit(1)),
        "HP": d(F.lit(1000) + k * 25),
        "ATK": d(F.lit(800) + k * 10),
        "DEF": d(F.lit(600) + k * 5),
        "CritRate": i(F.lit(15) + k),
        "CritDamage": i(F.lit(50) + k * 2),
        "SPD": d(F.lit(100.25) + k),
        "ACC": i(k * 5),
        "RES": i(F.lit(30) + k),
        "BlessingID": i(k % 7),
        "BooksMissing": i(k % 3),
    }


def events_snapshots(events: DataFrame, accounts: int = 20, entities: int = 10) -> DataFrame:
    """Bronze-shaped snapshot rows from ``events`` (see module doc)."""
    eid = F.col("event_id")
    k = (F.regexp_extract("props", r"(\d+)", 1).cast("int") % entities).alias("k")
    account_text = F.concat(F.lit("acct"), F.lpad((F.col("user_id") % accounts).cast("string"), 2, "0"))
    base = events.select(
        eid,
        F.col("event_type"),
        F.col("value"),
        k,
        account_text.alias("account_text"),
        F.to_date("ts").alias("snapshot_date"),
    )
    name = F.concat(F.lit("type "), (F.col("k") % 5).cast("string"))
    rank = F.when((F.col("event_type") == "error") & (eid % 10 == 0), F.lit(9)).otherwise(
        F.lit(1) + F.floor(F.col("value") / 100)
    )
    cols = {
        "AccountName": F.when(eid % 97 == 0, F.lit(None).cast("string")).otherwise(F.col("account_text")),
        "ID": F.when(eid % 101 == 0, F.lit(None).cast("int")).otherwise(F.col("k").cast("int")),
        "HeroID": (F.col("k") * 10 + 1).cast("int"),
        "Name": F.when(eid % 2 == 1, F.upper(name)).otherwise(name),
        "Rank": rank.cast("int"),
        "EmpowerLevel": (eid % 3).cast("int"),
        "BlessingGrade": (F.floor(F.col("value")) % 4).cast("int"),
        **_stats(F.col("k")),
        "_rescued_data": F.when(
            (F.col("event_type") == "signup") & (eid % 7 == 0),
            F.concat(F.lit('{"Note":"'), F.col("event_type"), F.lit('"}')),
        ),
        "run_id": F.when(eid % 103 == 0, F.lit(None).cast("string")).otherwise(
            F.concat(F.lit("run-"), F.col("snapshot_date").cast("string"))
        ),
        "source_file": F.concat(F.col("account_text"), F.lit("/"), F.col("snapshot_date").cast("string")),
        "snapshot_ts": F.date_add("snapshot_date", 1).cast("timestamp_ntz"),
        "snapshot_date": F.col("snapshot_date"),
        "schema_version": F.lit(CONTRACT_VERSION),
        "snapshot_version": F.lit(0).cast("int"),
    }
    return base.select(*[cols[c].alias(c) for c in BRONZE_COLUMNS], eid.alias(TIEBREAK))


def lineitem_snapshots(lineitem: DataFrame, entities: int = 20) -> DataFrame:
    """Bench-sized snapshot rows from ``lineitem``: one file per supplier and month."""
    k = (F.col("l_partkey") % entities).alias("k")
    month = F.trunc(F.to_date("l_shipdate"), "month")
    base = lineitem.select(
        F.col("l_orderkey"),
        F.col("l_linenumber"),
        F.col("l_partkey"),
        F.col("l_quantity"),
        F.col("l_discount"),
        F.col("l_tax"),
        k,
        F.concat(F.lit("supp"), F.col("l_suppkey").cast("string")).alias("account_text"),
        month.alias("snapshot_date"),
    )
    name = F.concat(F.lit("type "), (F.col("k") % 5).cast("string"))
    cols = {
        "AccountName": F.col("account_text"),
        "ID": F.col("k").cast("int"),
        "HeroID": (F.col("k") * 10 + 1).cast("int"),
        "Name": F.when(F.col("l_linenumber") % 2 == 1, F.upper(name)).otherwise(name),
        "Rank": (F.lit(1) + F.floor((F.col("l_quantity") - 1) / 10)).cast("int"),
        "EmpowerLevel": (F.round(F.col("l_discount") * 100) % 5).cast("int"),
        "BlessingGrade": (F.round(F.col("l_tax") * 100) % 4).cast("int"),
        **_stats(F.col("k")),
        "_rescued_data": F.lit(None).cast("string"),
        "run_id": F.concat(F.lit("run-"), F.col("snapshot_date").cast("string")),
        "source_file": F.concat(F.col("account_text"), F.lit("/"), F.col("snapshot_date").cast("string")),
        "snapshot_ts": F.date_add("snapshot_date", 1).cast("timestamp_ntz"),
        "snapshot_date": F.col("snapshot_date"),
        "schema_version": F.lit(CONTRACT_VERSION),
        "snapshot_version": F.lit(0).cast("int"),
    }
    tiebreak = F.struct("l_orderkey", "l_linenumber", "l_partkey")
    return base.select(*[cols[c].alias(c) for c in BRONZE_COLUMNS], tiebreak.alias(TIEBREAK))


#: one damage per quarantine rule, in the ladder's order: bronze column and its bad value as SQL
DAMAGE = (
    ("AccountName", "NULL"), ("ID", "NULL"), ("HeroID", "NULL"), ("source_file", "NULL"),
    ("run_id", "NULL"), ("snapshot_ts", "NULL"), ("snapshot_date", "NULL"), ("schema_version", "NULL"),
    ("Name", "NULL"), ("Rank", "7"), ("EmpowerLevel", "5"), ("Rarity", "0"), ("Affinity", "5"), ("BlessingID", "7"), ("schema_version", "'2.0'"),
    ("Faction", "19"), *((c, "-1") for c in (
        "Level", "UsedT1MasScrolls", "UnUsedT1MasScrolls", "UsedT2MasScrolls", "UnUsedT2MasScrolls", "UsedT3MasScrolls", "UnUsedT3MasScrolls",
        "HP", "ATK", "DEF", "CritRate", "CritDamage", "SPD", "ACC", "RES", "BlessingGrade", "BooksMissing", "snapshot_version")),
)
DAMAGE_CYCLE = 53  # a prime beyond the number of rules: most rows stay as they are


def damage_sql() -> dict[str, str]:
    """Per bronze column its damaged value: rule i is broken in rows whose ``record_id % DAMAGE_CYCLE`` is i, and a
    second, later rule in every third of those; clean rows get fractions that staging must round."""
    out: dict[str, str] = {}
    for i, (column, bad) in enumerate(DAMAGE):
        later = (i + 5) % len(DAMAGE)
        out.setdefault(column, "CASE ")
        out[column] += f"WHEN record_id % {DAMAGE_CYCLE} = {i} THEN {bad} "
        c2, b2 = DAMAGE[later]
        if later > i and c2 != column:
            out.setdefault(c2, "CASE ")
            out[c2] += f"WHEN record_id % {DAMAGE_CYCLE} = {i} AND record_id % 3 = 0 THEN {b2} "
    kept = {"HP": "HP + 0.5", "ATK": "ATK + 0.25", "DEF": "DEF + 0.75", "SPD": "SPD + 0.126"}
    return {c: f"{text}ELSE {kept.get(c, c)} END" for c, text in out.items()}


def damaged(bronze: DataFrame) -> DataFrame:
    """Bronze rows of which every quarantine rule rejects some."""
    types = dict(bronze.dtypes)
    return bronze.withColumns({c: F.expr(text).cast(types[c]) for c, text in damage_sql().items()})
