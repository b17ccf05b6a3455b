"""The declared checks of all layers, as data, and their SQL."""

from __future__ import annotations

from collections.abc import Iterable

from tidemark.operators.expect import ERROR, FAIL, PASS, WARN, Declared

# fixed values: domains and texts of the contracts
BUCKETS = ("KEY", "LINEAGE", "MISSING_ATTR", "DOMAIN", "RANGE")
SORT_KEY_LIKE = "________-%"
FLAGS = ("is_quarantined", "is_quarantined_key", "is_quarantined_data", "is_quarantined_lineage")
COUNTED = (
    "level", "used_t1_scrolls", "unused_t1_scrolls", "used_t2_scrolls", "unused_t2_scrolls", "used_t3_scrolls", "unused_t3_scrolls",
    "hp", "atk", "def", "crit_rate", "crit_damage", "spd", "acc", "res", "blessing_grade", "books_missing", "snapshot_version",
)


def present(*columns: str, severity: str = ERROR) -> list[Declared]:
    return [Declared(f"{c}_present", severity, fails=f"{c} IS NULL") for c in columns]


def among(column: str, values: Iterable, severity: str = ERROR) -> Declared:
    listed = ", ".join(repr(v) if isinstance(v, str) else str(v) for v in values)
    return Declared(f"{column}_accepted", severity, fails=f"{column} IS NOT NULL AND {column} NOT IN ({listed})")


def holds(name: str, expression: str, severity: str = ERROR) -> Declared:
    return Declared(name, severity, fails=f"NOT ({expression})")


def counted(*columns: str, severity: str = ERROR) -> list[Declared]:
    return [holds(f"{c}_not_negative", f"{c} >= 0", severity) for c in columns]


def once(*keys: str, where: str | None = None, severity: str = ERROR) -> Declared:
    return Declared("_".join(keys) + ("_once_where" if where else "_once"), severity, keys=keys, where=where)


def refers(column: str, layer: str, field: str, severity: str = ERROR) -> Declared:
    return Declared(f"{column}_in_{layer}", severity, keys=(column,), parent=(layer, field))


ENTITY = ("account", "entity_id")

DECLARED: dict[str, list[Declared]] = {
    "classified": [
        holds("reason_if_quarantined", "quarantine_reason IS NOT NULL OR NOT is_quarantined", WARN),
        holds("bucket_if_quarantined", "quarantine_bucket IS NOT NULL OR NOT is_quarantined", WARN),
        among("quarantine_bucket", BUCKETS, WARN),
        *present(*FLAGS, severity=WARN),
        *present("account", "entity_id", "run_id", severity=WARN),
        among("rank", range(1, 7), WARN),
    ],
    "quarantine": [
        *present("failure_reason", "quarantine_bucket"),
        among("quarantine_bucket", BUCKETS),
        holds("only_quarantined", "is_quarantined"),
    ],
    "final": [
        once(*ENTITY, "source_file"),
        *present(*ENTITY, "source_type_id", "name", "run_id", "source_file", "snapshot_ts", "snapshot_date"),
        among("rank", range(1, 7)),
        among("empower_level", range(5)),
        among("rarity", range(1, 7)),
        among("affinity", range(1, 5)),
        among("blessing_id", range(7)),
        among("schema_version", ("1.0", "1.1")),
        holds("faction_in_range", "faction BETWEEN 1 AND 18"),
        holds("level_within_rank", "level <= rank * 10", WARN),
        *counted(*COUNTED),
    ],
    "id_map": [once("source_type_id"), *present("type_key", "source_type_id"), *counted("inferred_type_number")],
    "lookup": [once("type_key"), *present("type_key", "name", "rarity", "affinity", "faction"), among("rarity", range(1, 7)), among("affinity", range(1, 5))],
    "keyed": [*present(*ENTITY, "type_key", "source_file"), refers("type_key", "lookup", "type_key"), refers("source_type_id", "id_map", "source_type_id")],
    "registry": [
        once("account", "source_file"),
        once("account", "snapshot_order_no"),
        once("account", "event_sort_key", severity=WARN),
        *present("account", "source_file", "snapshot_ts", "snapshot_order_no", "event_sort_key", "is_out_of_order"),
        holds("order_from_one", "snapshot_order_no >= 1"),
        holds("version_not_negative", "snapshot_version IS NULL OR snapshot_version >= 0"),
        holds("sort_key_form", f"event_sort_key LIKE '{SORT_KEY_LIKE}'", WARN),
        refers("source_file", "current", "source_file", WARN),
    ],
    "current": [once(*ENTITY), *present(*ENTITY, "type_key", "source_file"), refers("source_file", "registry", "source_file")],
    "first_seen": [
        once("account", "type_key"),
        *present("account", "type_key", "first_seen_ts", "first_entity_id", "first_seen_source_file", "first_seen_snapshot_order_no"),
        holds("first_order_from_one", "first_seen_snapshot_order_no >= 1"),
        refers("type_key", "lookup", "type_key"),
    ],
    "scd2": [
        once(*ENTITY, "valid_from"),
        once(*ENTITY, where="is_current"),
        once("scd_id"),
        *present(*ENTITY, "type_key", "source_type_id", "valid_from", "is_current", "is_deleted", "scd_id"),
        holds("ends_after_start", "valid_to IS NULL OR valid_to > valid_from", WARN),
        holds("current_not_deleted", "NOT (is_current AND is_deleted)"),
    ],
    "obtained": [once("event_id"), once(*ENTITY), *present("event_id", "scd_id", *ENTITY, "type_key", "event_ts"), refers("scd_id", "scd2", "scd_id")],
    "upgrades": [
        once("event_id"),
        *present("event_id", "scd_id", *ENTITY, "type_key", "event_ts", "upgrade_type", "old_value", "new_value", "delta_value"),
        among("upgrade_type", ("RANK", "EMPOWER", "BLESSING")),
        holds("rises", "new_value > old_value"),
        holds("delta_is_difference", "delta_value = new_value - old_value"),
        refers("scd_id", "scd2", "scd_id"),
    ],
    "gold": [
        once("account", "type_key"),
        *present("account", "type_key", "name", "first_seen_ts", "total_owned", "total_deleted"),
        holds("owned_and_deleted_not_negative", "total_owned >= 0 AND total_deleted >= 0"),
        holds("obtained_is_owned_and_deleted", "coalesce(total_obtained, 0) = total_owned + total_deleted", WARN),
        holds("not_upgraded_without_owner", "NOT (total_owned = 0 AND last_upgraded_ts IS NOT NULL)", WARN),
        refers("type_key", "lookup", "type_key"),
    ],
}


def _failures(layer: str, c: Declared) -> str:
    if not c.keys:
        return f"SELECT count(*) FROM {layer} WHERE {c.fails}"
    complete = " AND ".join([*[f"{k} IS NOT NULL" for k in c.keys], *([f"({c.where})"] if c.where else [])])
    if c.parent:
        return f"SELECT count(*) FROM {layer} WHERE {complete} AND {c.keys[0]} NOT IN (SELECT {c.parent[1]} FROM {c.parent[0]} WHERE {c.parent[1]} IS NOT NULL)"
    return f"SELECT count(*) FROM (SELECT 1 FROM {layer} WHERE {complete} GROUP BY {', '.join(c.keys)} HAVING count(*) > 1)"


def summary_sql() -> str:
    """One counting query per check over relations named as the layers."""
    rows = " UNION ALL ".join(
        f"SELECT '{layer}' AS layer, '{c.name}' AS check_name, '{c.severity}' AS severity, ({_failures(layer, c)}) AS failures" for layer, checks in DECLARED.items() for c in checks
    )
    return f"SELECT *, CASE WHEN failures = 0 THEN '{PASS}' WHEN severity = '{WARN}' THEN '{WARN}' ELSE '{FAIL}' END AS status FROM ({rows})"
