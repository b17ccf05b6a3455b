"""Upgrade and first-version events, incremental forms, and the roll-up."""

from __future__ import annotations

from staged import staged_df, staged_row, ts

from tidemark.operators import events, history, identity, registry, rollup, state


def _scd2(spark, snaps):
    rows = []
    for account, day, ents in snaps:
        for e, vals in ents.items():
            rank, emp, bg = vals
            rows.append(staged_row(account=account, entity_id=e, rank=rank, empower_level=emp, blessing_grade=bg,
                                   source_file=f"{account}/d{day:02d}", snapshot_ts=ts(day, 1),
                                   snapshot_date=ts(day).date()))
    final = staged_df(spark, rows)
    keyed = identity.attach_key(final, identity.type_id_map(final))
    reg = registry.register_snapshots(keyed)
    hist = history.scd2_backfill(keyed, registry.in_order_sequence(reg))
    return history.scd2_view(hist), keyed, reg


SNAPS = [
    ("a1", 1, {1: (1, 0, 0), 2: (2, 1, 0), 3: (1, 0, 0)}),
    ("a1", 2, {1: (2, 1, 0), 2: (1, 1, 0), 3: (1, 0, 0)}),  # 1: rank and empower rise; 2: rank falls
    ("a1", 3, {1: (2, 1, 0), 2: (1, 1, 0)}),                # 3 deleted
    ("a1", 4, {1: (2, 1, 0), 2: (1, 1, 0), 3: (2, 0, 0)}),  # 3 back with a higher rank (across the gap)
    ("a1", 5, {1: (3, 1, 1), 2: (1, 1, 0), 3: (2, 0, 0)}),
    ("a1", 6, {1: (4, 1, 1), 2: (1, 1, 0), 3: (2, 0, 0)}),  # two new versions of 1 after day 4
]


def test_upgrade_events(spark):
    scd2, _, _ = _scd2(spark, SNAPS)
    ev = {(r.entity_id, r.event_ts, r.upgrade_type): (r.old_value, r.new_value, r.delta_value)
          for r in events.upgrade_events(scd2).collect()}
    assert ev[(1, ts(2, 1), "RANK")] == (1, 2, 1)
    assert ev[(1, ts(2, 1), "EMPOWER")] == (0, 1, 1)
    assert (2, ts(2, 1), "RANK") not in ev  # a fall is no event
    assert ev[(3, ts(4, 1), "RANK")] == (1, 2, 1)  # compared across the delete gap
    assert ev[(1, ts(5, 1), "BLESSING")] == (0, 1, 1) and ev[(1, ts(6, 1), "RANK")] == (3, 4, 1)
    ids = [r.event_id for r in events.upgrade_events(scd2).collect()]
    assert len(ids) == len(set(ids)) and all(i.endswith(("::RANK", "::EMPOWER", "::BLESSING")) for i in ids)


def test_incremental_upgrades_see_every_new_version(spark):
    scd2, _, _ = _scd2(spark, SNAPS)
    full = {r.event_id for r in events.upgrade_events(scd2).collect()}
    prior_hist = scd2.where(f"valid_from <= timestamp_ntz'{ts(4, 1)}'")
    prior = events.upgrade_events(prior_hist)
    new = events.upgrade_events(scd2, cutoff=events.event_cutoff(prior))
    merged = {r.event_id for r in state.merge_by_key(prior, new, ["event_id"]).collect()}
    assert merged == full
    assert {r.event_ts for r in new.collect()} == {ts(5, 1), ts(6, 1)}


def test_first_version_events(spark):
    scd2, _, _ = _scd2(spark, SNAPS)
    ev = events.first_version_events(scd2).collect()
    assert sorted((r.entity_id, r.event_ts) for r in ev) == [(1, ts(1, 1)), (2, ts(1, 1)), (3, ts(1, 1))]
    later = events.first_version_events(scd2, cutoff=events.event_cutoff(events.first_version_events(scd2)))
    assert later.count() == 0


def test_rollup_counts_versions_of_deleted_entities(spark):
    snaps = [
        ("a1", 1, {1: (1, 0, 0), 2: (1, 0, 0)}),
        ("a1", 2, {1: (2, 0, 0), 2: (1, 0, 0)}),
        ("a1", 3, {1: (3, 0, 0), 2: (1, 0, 0)}),
        ("a1", 4, {2: (1, 0, 0)}),  # entity 1 deleted after three versions
    ]
    scd2, keyed, reg = _scd2(spark, snaps)
    gold = rollup.account_type_state(
        scd2, events.first_version_events(scd2), events.upgrade_events(scd2).where("false"),
        identity.first_seen(keyed, reg), identity.type_lookup(keyed),
    ).collect()
    assert len(gold) == 1
    g = gold[0]
    assert (g.total_owned, g.total_deleted, g.total_obtained, g.max_rank) == (1, 3, 2, 3)
    assert g.last_upgraded_ts is None  # a type with no upgrade events keeps its row


def test_lagging_account_loses_no_event(spark):
    rows = [("fast", 1, "k", ts(9), "i1"), ("slow", 2, "k", ts(3), "i2"), ("new", 3, "k", ts(1), "i3")]
    scd2 = spark.createDataFrame(rows, "account string, entity_id int, type_key string, valid_from timestamp_ntz, scd_id string")
    prior = events.first_version_events(scd2.where("account = 'fast'"))
    new = events.first_version_events(scd2, cutoff=events.event_cutoff(prior))
    assert sorted(r.account for r in new.collect()) == ["new", "slow"]
    assert events.event_cutoff(prior, scope=None).first().cutoff_ts == ts(9)
