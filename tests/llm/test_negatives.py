"""Hard negatives against brute force, and the bounds of segment summaries."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import negatives, queries

ROWS = "id bigint, label bigint, vector array<bigint>"


def brute(rows, every, positives, negatives_, low, high):
    out = []
    for a, own, v in rows:
        if a % every:
            continue
        scored = [(sum(x * y for x, y in zip(v, w, strict=True)), i, label) for i, label, w in rows if i != a and len(w) == len(v)]
        best = sorted(((s, i) for s, i, label in scored if label == own), key=lambda x: (-x[0], x[1]))[:positives]
        for p, i in best:
            band = sorted(((s, j) for s, j, label in scored if label != own and low * p <= 100 * s <= high * p), key=lambda x: (-x[0], x[1]))
            out += [(a, i, k + 1, j, p, s) for k, (s, j) in enumerate(band[:negatives_])]
    return sorted(out)


@pytest.mark.parametrize("spread,shift", [(40, 0), (40, 30), (2, 1), (3_000_000_000, 0)])
def test_mining_equals_brute_force(spark, work, spread, shift):
    r = np.random.default_rng(spread % 97 + shift)
    rows = []
    for i in range(400):
        dim = 7 if i % 40 == 3 else 0 if i % 97 == 5 else 24
        rows.append((i * 3, int(r.integers(0, 3)) if i % 50 else 99, [int(x) for x in r.integers(-spread, spread + 1, dim) // (1 if dim == 24 or spread < 100 else 1000) + shift]))
    if spread > 100:  # products stay inside 64 bits
        rows = [(i, label, [x // 8 for x in v]) for i, label, v in rows]
    df = spark.createDataFrame(rows, ROWS).repartition(4).withColumns({c: F.lit(1) for c in ("a", "kind", "block", "stripe", "score", "rank")})
    for blocks_of, stripes in ((8192, 3), (7, 2)):
        got = negatives.mine(spark, df, F.col("id") % 12 == 0, 5, 10, 30, 90, blocks_of, stripes)
        assert sorted(map(tuple, got.collect())) == brute(rows, 12, 5, 10, 30, 90)


def test_bounds_hold_and_filter():
    r = np.random.default_rng(4)
    pull = np.repeat(r.normal(0, 40, (6, 16)), 4, axis=1)  # vectors that are nearly constant inside segments
    vec = np.rint(pull[r.integers(0, 6, 300)] + r.normal(0, 3, (300, 64))).astype(np.int64)
    rows = negatives.Rows(np.arange(300), np.zeros(300, np.int64), vec, negatives.segment_summaries(vec.astype(float)).astype(float))
    a, b = rows.part(0, 40), rows.part(40, 300)
    exact = a.vec @ b.vec.T
    floor = np.sort(exact, axis=1)[:, -5]
    i, j, score = negatives.candidate_pairs(a, b, np.ones(exact.shape, bool), floor, np.full(40, 1 << 62))
    want = np.nonzero(exact >= floor[:, None])
    assert set(zip(i.tolist(), j.tolist(), strict=True)) == set(zip(*(x.tolist() for x in want), strict=True))
    assert (score == exact[i, j]).all()


def test_ties_go_by_smaller_id():
    best = negatives.Best(2, 2)
    best.add(np.array([0, 0, 1]), np.array([5, 5, 1]), np.array([9, 8, 7]))
    best.add(np.array([0, 0]), np.array([5, 4]), np.array([1, 0]))
    assert list(zip(best.slot.tolist(), best.score.tolist(), best.id.tolist(), strict=True)) == [(0, 5, 1), (0, 5, 8), (1, 1, 7)]


def test_unusable_rows_take_no_part(spark, work, tmp_path):
    good = [(100 * k + m, [1.0 - 0.3 * m, 0.5 + k / 100], (k + m) % 2) for k in range(8) for m in (0, 1)]
    bad = [(None, [9.0, 9.0], 0), (900, None, 0), (1000, [9.0, None], 1), (1100, [math.nan, 9.0], 0), (1200, [math.inf, 9.0], 1), (1300, [9.0, 9.0], None)]
    schema = "vec_id bigint, embedding array<float>, label int"
    for name, rows in (("good", good), ("all", good + bad), ("none", [])):
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}/embeddings.parquet")
    got = {name: sorted(map(tuple, queries.op13_hard_negatives(spark, f"{tmp_path}/{name}").collect())) for name in ("good", "all", "none")}
    assert got["good"] and got["all"] == got["good"] and got["none"] == []


def test_scores_beyond_64_bits_are_an_error():
    vec = np.full((2, 4), 1 << 31, np.int64)
    rows = negatives.Rows(np.arange(2), np.zeros(2, np.int64), vec, negatives.segment_summaries(vec.astype(float)).astype(float))
    with pytest.raises(OverflowError):
        negatives.candidate_pairs(rows, rows, np.ones((2, 2), bool), np.zeros(2, np.int64), np.full(2, 1 << 62))
