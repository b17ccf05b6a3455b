"""Staged rows that the tests build on."""

from __future__ import annotations

import datetime as dt

from tidemark.schema import STAGED_COLUMNS


def ts(day: int, hour: int = 0) -> dt.datetime:
    return dt.datetime(2024, 1, 1) + dt.timedelta(days=day - 1, hours=hour)


STAGED_DDL = (
    "account string, entity_id int, source_type_id int, name string, rank int, level int, empower_level int, "
    "rarity int, affinity int, faction int, used_t1_scrolls int, unused_t1_scrolls int, used_t2_scrolls int, "
    "unused_t2_scrolls int, used_t3_scrolls int, unused_t3_scrolls int, hp int, atk int, def int, crit_rate int, "
    "crit_damage int, spd double, acc int, res int, blessing_id int, blessing_grade int, books_missing int, "
    "run_id string, source_file string, snapshot_ts timestamp_ntz, snapshot_date date, snapshot_version int, "
    "schema_version string"
)


def staged_row(**over) -> dict:
    """A clean staged row; keyword arguments override fields."""
    base = dict(
        account="a1", entity_id=1, source_type_id=11, name="Alpha", rank=3, level=10, empower_level=0,
        rarity=2, affinity=1, faction=5, used_t1_scrolls=0, unused_t1_scrolls=0, used_t2_scrolls=0,
        unused_t2_scrolls=0, used_t3_scrolls=0, unused_t3_scrolls=0, hp=100, atk=50, def_=40, crit_rate=15,
        crit_damage=50, spd=100.0, acc=0, res=30, blessing_id=0, blessing_grade=0, books_missing=0,
        run_id="r1", source_file="a1/f1", snapshot_ts=ts(2), snapshot_date=dt.date(2024, 1, 1),
        snapshot_version=0, schema_version="1.1",
    )
    if "def" in over:
        over["def_"] = over.pop("def")
    base.update(over)
    base["def"] = base.pop("def_")
    return {c: base[c] for c in STAGED_COLUMNS}


def staged_df(spark, rows: list[dict], extra_ddl: str = ""):
    ddl = STAGED_DDL + (", " + extra_ddl if extra_ddl else "")
    names = [p.strip().split(" ")[0] for p in ddl.split(",")]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], ddl)
