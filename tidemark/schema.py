"""Contracts: the snapshot file schema, bronze lineage fields, staged names,
tracked columns, the operations-log schema, and helpers that conform a
DataFrame to a contract.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DataType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
)

# --- fixed values: snapshot file contract (header names and types of the CSV files) ---
SNAPSHOT_SCHEMA = StructType(
    [
        StructField("AccountName", StringType()),
        StructField("ID", IntegerType()),
        StructField("HeroID", IntegerType()),
        StructField("Name", StringType()),
        StructField("Rank", IntegerType()),
        StructField("Level", IntegerType()),
        StructField("EmpowerLevel", IntegerType()),
        StructField("Rarity", IntegerType()),
        StructField("Affinity", IntegerType()),
        StructField("Faction", IntegerType()),
        StructField("UsedT1MasScrolls", IntegerType()),
        StructField("UnUsedT1MasScrolls", IntegerType()),
        StructField("UsedT2MasScrolls", IntegerType()),
        StructField("UnUsedT2MasScrolls", IntegerType()),
        StructField("UsedT3MasScrolls", IntegerType()),
        StructField("UnUsedT3MasScrolls", IntegerType()),
        StructField("HP", DoubleType()),
        StructField("ATK", DoubleType()),
        StructField("DEF", DoubleType()),
        StructField("CritRate", IntegerType()),
        StructField("CritDamage", IntegerType()),
        StructField("SPD", DoubleType()),
        StructField("ACC", IntegerType()),
        StructField("RES", IntegerType()),
        StructField("BlessingID", IntegerType()),
        StructField("BlessingGrade", IntegerType()),
        StructField("BooksMissing", IntegerType()),
    ]
)
# contract version written by ingest, and the versions staging accepts
CONTRACT_VERSION = "1.1"
ACCEPTED_CONTRACT_VERSIONS = ("1.0", "1.1")

# lineage fields added at ingest
BRONZE_META_SCHEMA = StructType(
    [
        StructField("_rescued_data", StringType()),
        StructField("run_id", StringType()),
        StructField("source_file", StringType()),
        StructField("snapshot_ts", TimestampNTZType()),
        StructField("snapshot_date", DateType()),
        StructField("schema_version", StringType()),
        StructField("snapshot_version", IntegerType()),
    ]
)
BRONZE_SCHEMA = StructType(SNAPSHOT_SCHEMA.fields + BRONZE_META_SCHEMA.fields)
BRONZE_COLUMNS = [f.name for f in BRONZE_SCHEMA.fields]

# raw header -> staged name (our neutral vocabulary)
STAGED_NAMES = {
    "AccountName": "account",
    "ID": "entity_id",
    "HeroID": "source_type_id",
    "Name": "name",
    "Rank": "rank",
    "Level": "level",
    "EmpowerLevel": "empower_level",
    "Rarity": "rarity",
    "Affinity": "affinity",
    "Faction": "faction",
    "UsedT1MasScrolls": "used_t1_scrolls",
    "UnUsedT1MasScrolls": "unused_t1_scrolls",
    "UsedT2MasScrolls": "used_t2_scrolls",
    "UnUsedT2MasScrolls": "unused_t2_scrolls",
    "UsedT3MasScrolls": "used_t3_scrolls",
    "UnUsedT3MasScrolls": "unused_t3_scrolls",
    "HP": "hp",
    "ATK": "atk",
    "DEF": "def",
    "CritRate": "crit_rate",
    "CritDamage": "crit_damage",
    "SPD": "spd",
    "ACC": "acc",
    "RES": "res",
    "BlessingID": "blessing_id",
    "BlessingGrade": "blessing_grade",
    "BooksMissing": "books_missing",
}
LINEAGE_COLUMNS = ["run_id", "source_file", "snapshot_ts", "snapshot_date", "snapshot_version", "schema_version"]
STAGED_COLUMNS = list(STAGED_NAMES.values()) + LINEAGE_COLUMNS

# stats rounded to whole numbers, and the one rounded to two places
ROUND_TO_INT = ("hp", "atk", "def")
ROUND_TO_2 = ("spd",)

ENTITY_KEYS = ["account", "entity_id"]
TYPE_ATTRIBUTES = ["name", "rarity", "affinity", "faction"]

# columns whose change opens a new history version
TRACKED = [
    "rank",
    "level",
    "empower_level",
    "used_t1_scrolls",
    "unused_t1_scrolls",
    "used_t2_scrolls",
    "unused_t2_scrolls",
    "used_t3_scrolls",
    "unused_t3_scrolls",
    "hp",
    "atk",
    "def",
    "crit_rate",
    "crit_damage",
    "spd",
    "acc",
    "res",
    "blessing_id",
    "blessing_grade",
    "books_missing",
]
# history columns carried but not tracked
HISTORY_KEYS = ["account", "entity_id", "type_key", "source_type_id"]

# monitored measures for upgrade events: (event label, column)
UPGRADE_MEASURES = [("RANK", "rank"), ("EMPOWER", "empower_level"), ("BLESSING", "blessing_grade")]

# --- operations log contract ---
LOG_SCHEMA = StructType(
    [
        StructField("target_table_fqn", StringType()),
        StructField("layer", StringType()),
        StructField("pipeline_name", StringType()),
        StructField("event_level", StringType()),
        StructField("run_id", StringType()),
        StructField("pipeline_run_ts", TimestampType()),
        StructField("checkpoint_location", StringType()),
        StructField("schema_location", StringType()),
        StructField("batch_id", LongType()),
        StructField("source_file", StringType()),
        StructField("row_count", LongType()),
        StructField("rows_rescued", LongType()),
        StructField("started_ts", TimestampType()),
        StructField("finished_ts", TimestampType()),
        StructField("status", StringType()),
        StructField("message", StringType()),
        StructField("error_class", StringType()),
        StructField("context_json", StringType()),
    ]
)


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Select the contract's columns in order, casting present ones and adding
    missing ones as typed NULLs (every column is cast, so none stays VOID)."""
    present = set(df.columns)
    cols: list[Column] = []
    for field in schema.fields:
        src = F.col(field.name) if field.name in present else F.lit(None)
        cols.append(src.cast(field.dataType).alias(field.name))
    return df.select(*cols)


def sync_schema(target: DataFrame, source_schema: StructType) -> DataFrame:
    """Bring a stored table to a new source schema: new columns appear as typed
    NULLs, removed columns are dropped, kept columns keep their values."""
    return conform(target, source_schema)


def project_contract(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select(*columns)


def typed_null(data_type: DataType) -> Column:
    return F.lit(None).cast(data_type)
