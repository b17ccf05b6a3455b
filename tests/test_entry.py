from __future__ import annotations

import __spark_entry__ as entry

from tidemark.plans.catalog import ORACLE, QUERIES


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert {"account", "type_key", "total_owned", "total_deleted", "first_seen_ts"} <= set(df.columns)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


def test_entry_adds_to_the_base_queries_only():
    q, o = entry.queries(), entry.oracle_sql()
    assert {k: q[k] for k in QUERIES} == QUERIES and set(o) <= set(q)
    assert all(name.startswith("op") or name == "pipeline" for name in set(q) - set(QUERIES))
