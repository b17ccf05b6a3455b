"""SCD2: literal cases, and step fold = backfill = plain-Python replay."""

from __future__ import annotations

import random

from staged import staged_row, ts

from tidemark.operators import history, identity, registry
from tidemark.schema import TRACKED
from tidemark.session import checkpoint_dir


def _keyed(spark, rows):
    from staged import staged_df

    final = staged_df(spark, rows)
    return identity.attach_key(final, identity.type_id_map(final))


def _snap(account, day, entities):
    """One full snapshot of an account on a day: {entity: rank}."""
    return [
        staged_row(account=account, entity_id=e, rank=r, source_file=f"{account}/d{day:02d}", snapshot_ts=ts(day, 1),
                   snapshot_date=ts(day).date())
        for e, r in entities.items()
    ]


def _backfill(spark, rows):
    keyed = _keyed(spark, rows)
    reg = registry.register_snapshots(keyed)
    return history.scd2_backfill(keyed, registry.in_order_sequence(reg)), keyed, reg


def _fold(spark, keyed, reg):
    seq = registry.in_order_sequence(reg)
    rows = keyed.join(seq.select("account", "source_file", "seq"), ["account", "source_file"])
    checkpoint_dir(spark)
    hist = None
    n = rows.agg({"seq": "max"}).first()[0]
    for b in range(1, n + 1):
        hist = history.scd2_step(hist, rows.where(f"seq = {b}")).checkpoint()
    return hist


def _versions(df):
    return sorted((r.account, r.entity_id, r.rank, r.valid_from, r.valid_to) for r in df.collect())


def replay(snapshots):
    """Plain-Python replay: snapshots = [(account, day, {entity: rank})] in order."""
    open_, out = {}, []
    by_account = {}
    for account, day, ents in sorted(snapshots):
        by_account.setdefault(account, []).append((day, ents))
    for account, files in by_account.items():
        for day, ents in files:
            t = ts(day, 1)
            for e in list(open_):
                if e[0] != account:
                    continue
                if e[1] not in ents or ents[e[1]] != open_[e][0]:
                    out.append((account, e[1], open_[e][0], open_[e][1], t))
                    del open_[e]
            for e, r in ents.items():
                if (account, e) not in open_:
                    open_[(account, e)] = (r, t)
    out += [(a, e, r, f, None) for (a, e), (r, f) in open_.items()]
    return sorted(out)


def test_literal_cases(spark):
    snaps = [
        ("a1", 1, {1: 3, 2: 3, 3: 3, 4: 3}),
        ("a1", 2, {1: 3, 2: 4, 3: 3}),          # 1 unchanged, 2 changed, 4 deleted
        ("a2", 2, {7: 1}),
        ("a1", 3, {1: 3, 2: 4, 4: 3}),          # 3 deleted, 4 back with the same values
        ("a1", 4, {1: 3, 2: 4, 4: 3}),          # a2 absent from this batch: unaffected
    ]
    rows = [r for a, d, e in snaps for r in _snap(a, d, e)]
    hist, keyed, reg = _backfill(spark, rows)
    got = _versions(hist)
    assert got == replay(snaps)
    ent4 = [v for v in got if v[:2] == ("a1", 4)]
    assert len(ent4) == 2 and ent4[0][4] == ts(2, 1) and ent4[1][3] == ts(3, 1) and ent4[1][4] is None
    assert [v for v in got if v[0] == "a2"] == [("a2", 7, 1, ts(2, 1), None)]
    scd2 = history.scd2_view(hist)
    deleted = {(r.account, r.entity_id) for r in scd2.where("is_deleted").collect()}
    assert deleted == {("a1", 3)}


def test_null_to_value_is_a_change(spark):
    rows = _snap("a1", 1, {1: 3}) + [dict(staged_row(blessing_grade=None, source_file="a1/d02", snapshot_ts=ts(2, 1)))]
    rows[0]["blessing_grade"] = None
    rows[1]["blessing_grade"] = 2
    hist, _, _ = _backfill(spark, rows)
    assert hist.count() == 2


def test_fold_equals_backfill_equals_replay(spark):
    rnd = random.Random(7)
    snaps = []
    for account in ("a1", "a2", "a3"):
        for day in range(1, 9):
            if rnd.random() < 0.2:
                continue
            ents = {e: rnd.choice([1, 1, 2, 3]) for e in range(1, 6) if rnd.random() < 0.75}
            snaps.append((account, day, ents))
    rows = [r for a, d, e in snaps for r in _snap(a, d, e)]
    hist, keyed, reg = _backfill(spark, rows)
    expected = replay(snaps)
    assert _versions(hist) == expected
    assert _versions(_fold(spark, keyed, reg)) == expected
    assert set(TRACKED) <= set(hist.columns)
