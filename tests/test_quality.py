from __future__ import annotations

from staged import staged_df, staged_row, ts

from tidemark.functions.rules import DEFAULT_RULES
from tidemark.operators import quality


def _bad_value(rule):
    """A value that fails the rule (NULL fails every rule but the version one)."""
    from tidemark.functions.rules import DomainRule, RangeRule

    if isinstance(rule, DomainRule):
        return "9.9" if rule.column == "schema_version" else 99
    if isinstance(rule, RangeRule):
        return -1 if rule.lo == 0 else 19
    return None


def test_each_rule_fires_alone(spark):
    rows = []
    for i, rule in enumerate(DEFAULT_RULES):
        r = staged_row(entity_id=1000 + i)
        r[rule.column] = _bad_value(rule)
        if rule.column == "spd" and r["spd"] is not None:
            r["spd"] = -1.0
        rows.append(r)
    rows.append(staged_row(entity_id=1))  # clean
    out = quality.classify(staged_df(spark, rows)).collect()
    got = {r.entity_id: r.quarantine_reason for r in out if r.entity_id is not None}
    assert got[1] is None
    for i, rule in enumerate(DEFAULT_RULES):
        if rule.column == "entity_id":
            continue
        assert got[1000 + i] == rule.reason, rule
    assert len(DEFAULT_RULES) == 34
    assert sum(1 for r in out if r.entity_id is None and r.quarantine_reason == "KEY_NULL:entity_id") == 1


def test_first_rule_wins_and_flags(spark):
    rows = [staged_row(rank=9, faction=40), staged_row(entity_id=2, run_id=None, rank=9), staged_row(entity_id=3)]
    out = {r.entity_id: r for r in quality.classify(staged_df(spark, rows)).collect()}
    assert out[1].quarantine_reason == "DOMAIN:rank" and out[1].quarantine_bucket == "DOMAIN"
    assert out[1].is_quarantined and out[1].is_quarantined_data and not out[1].is_quarantined_key
    assert out[2].quarantine_bucket == "LINEAGE" and out[2].is_quarantined_lineage
    assert out[3].is_quarantined is False and out[3].is_quarantined_key is False


def test_null_version_is_range_but_null_schema_version_is_lineage(spark):
    rows = [staged_row(snapshot_version=None), staged_row(entity_id=2, schema_version=None)]
    out = {r.entity_id: r.quarantine_reason for r in quality.classify(staged_df(spark, rows)).collect()}
    assert out == {1: "RANGE:snapshot_version", 2: "LINEAGE_NULL:schema_version"}


def test_dedupe_full_tie_uses_tiebreak_and_reingest_takes_latest(spark):
    rows = [
        dict(staged_row(rank=1), rid=1),
        dict(staged_row(rank=2), rid=2),  # full tie with the first: tie-break picks rid 2
        dict(staged_row(entity_id=2, rank=1, snapshot_ts=ts(2)), rid=3),
        dict(staged_row(entity_id=2, rank=4, snapshot_ts=ts(5), run_id="r2"), rid=4),  # re-ingested file
    ]
    df = quality.classify(staged_df(spark, rows, "rid int"))
    order = quality.dedupe_order("rid")
    win = {r.entity_id: r.rank for r in quality.dedupe_winners(quality.valid(df), order=order).collect()}
    assert win == {1: 2, 2: 4}
    losers = quality.dedupe_losers(quality.rank_duplicates(quality.valid(df), order=order)).collect()
    assert sorted((r.entity_id, r.duplicate_group_count, r.duplicate_row_number) for r in losers) == [(1, 2, 2), (2, 2, 2)]
    assert {r.failure_reason for r in losers} == {quality.DUPLICATE_REASON}


def test_stage_rounds_half_up(spark):
    from tidemark.schema import BRONZE_SCHEMA

    vals = {f.name: None for f in BRONZE_SCHEMA.fields}
    vals.update(HP=10.5, ATK=10.49, DEF=0.5, SPD=1.005)
    b = spark.createDataFrame([tuple(vals[f.name] for f in BRONZE_SCHEMA.fields)], BRONZE_SCHEMA)
    r = quality.stage(b).collect()[0]
    assert (r.hp, r.atk, r["def"]) == (11, 10, 1)
    assert r.spd in (1.0, 1.01)  # binary 1.005 is just below; either way two places
