"""Operator 3: contexts that grow with the training texts."""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from corpus_rows import DOCUMENTS, rows_of
from pyspark.sql import functions as F

from tidemark.llm import mixing, partials


def buffers(texts):
    return np.frombuffer(b"".join(texts), dtype=np.uint8), np.cumsum([0, *map(len, texts)])


def test_keys_are_the_bytes_before():
    data, offsets = buffers([b"abcdefgh", b"", b"xy"])
    for order, row in zip(mixing.LONGER, mixing.context_keys(data, offsets).tolist(), strict=True):
        expected = []
        for text in (b"abcdefgh", b"xy"):
            for i, byte in enumerate(text):
                before = (b"\0" * order + text[:i])[-order:]
                expected.append(order << 56 | int.from_bytes(before, "big") << 8 | byte)
        assert row == expected
    keys = np.unique(mixing.context_keys(data, offsets))
    again, counts = mixing.unpacked(mixing.packed(keys, np.arange(len(keys))))
    assert (again == keys).all() and (counts == np.arange(len(keys))).all()


def test_paths_equal_counts_of_each_subtree():
    r = np.random.default_rng(3)
    model = mixing.Model(r.integers(0, 9, int(mixing._STARTS[-1])))
    contexts, symbols = r.integers(0, 40, 600), r.choice([65, 66, 67, 200, 255], 600)
    keys, counts = contexts << 8 | symbols, r.integers(0, 5, 600)
    pool, start, place = model.paths(keys, counts)
    total = Counter()
    for k, c in zip(keys.tolist(), counts.tolist(), strict=True):
        total[k] += c
    codes = [list(zip(model.node[a : a + n].tolist(), model.bit[a : a + n].tolist(), strict=True)) for a, n in zip(model.first, model.length, strict=True)]
    for k, p in zip(keys.tolist(), place.tolist(), strict=True):
        expected = []
        for node, _ in codes[k & 255]:
            sides = [sum(c for other, c in total.items() if other >> 8 == k >> 8 and (node, bit) in codes[other & 255]) for bit in (0, 1)]
            expected.append(round(max(-127, min(127, 16 * math.log((sides[1] + 0.05) / (sides[0] + 0.05))))))
        assert pool[start[p] : start[p + 1]].tolist() == expected


def test_longer_contexts_are_kept_apart(spark, work):
    """A passage that was trained on is known again among far more contexts than a small table has slots."""
    r = random.Random(8)
    train = ["".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(4000)) for _ in range(60)]
    rows = rows_of([*train, train[7][1000:3000], None, ""])
    docs = spark.createDataFrame(rows, DOCUMENTS).repartition(3)
    found = {x["doc_id"]: x["score"] for x in mixing.score_texts(spark, docs, F.col("doc_id") < len(train)).collect()}
    assert len(found) == len(rows)
    assert -found[60] / math.log10(2) / 2000 < 1.5
    assert found[61] == found[62]


def trained(train, texts):
    """A model of the texts ``train``, and the paths of all ``texts`` with the contexts that occur in them."""
    data, offsets = mixing.with_ends(*buffers(train))
    model = mixing.Model(np.bincount((mixing.contexts(data, offsets)[0] << 8) + data, minlength=1 << 16))
    known, found = mixing.context_keys(data, offsets).ravel(), buffers(texts)
    asked = mixing.context_keys(*found)
    keys = np.concatenate([known, asked.ravel()])
    pool, start, place = model.paths(keys, np.arange(len(keys)) < len(known))
    return model, (*found, (pool, start[place[len(known) :]].reshape(asked.shape)))


def test_gate_and_updates_reach_short_texts(monkeypatch):
    r = random.Random(4)
    words = ["".join(r.choice("abcdefgh") for _ in range(5)) for _ in range(30)]
    train = [" ".join(r.choices(words, k=200)).encode()]
    model, asked = trained(train, [b" ".join([train[0][:60], b"hgfhagbc gbha", train[0][300:340]])])
    score = model.score(*asked)[0]
    with monkeypatch.context() as m:
        m.setattr(mixing, "GATES", 2)
        assert not math.isclose(score, model.score(*asked)[0], rel_tol=1e-3)
    with monkeypatch.context() as m:
        m.setattr(mixing, "RATE", 0)
        m.setattr(mixing, "REFINE_RATE", 0)
        assert not math.isclose(score, model.score(*asked)[0], rel_tol=1e-3)


def test_scores_are_a_distribution_with_longer_contexts_and_gates():
    text = b"the cat sat on the mat and the cat sat down on the"
    model, asked = trained([b"the cat sat on the mat", b"a dog sat down on the rug"], [text, *(text + bytes([k]) for k in range(256))])
    scores = model.score(*asked)
    assert math.isclose((10 ** (scores[1:] - scores[0])).sum(), 1, rel_tol=1e-3)


def test_counts_beyond_32_bits(spark, work, monkeypatch):
    kinds, collect = [], partials.collect_table

    def seen(parts, size, kind, *add):
        kinds.append(kind)
        return collect(parts, size, kind, *add)

    monkeypatch.setattr(partials, "collect_table", seen)
    docs = spark.createDataFrame(rows_of(["a b", "a c"]), DOCUMENTS)
    assert mixing.score_texts(spark, docs, F.lit(True)).count() == 2
    assert kinds == [np.int64]
    large = np.array([2**31 - 1, 7])
    rows = spark.createDataFrame([(0, large.tobytes()), (0, large.tobytes())], partials.SCHEMA)
    assert collect(rows, 2, np.int64, partials.added).tolist() == [2**32 - 2, 14]
    with pytest.raises(OverflowError):
        partials.added(np.array([2**63 - 1]), np.array([1]))


def scored(docs):
    rows = mixing.score_texts(docs.sparkSession, docs, F.col("doc_id") % 7 != 2).collect()
    return sorted([tuple(x) for x in rows], key=lambda x: (x[0], x[2], x[5]))


def test_no_row_per_token_is_written(spark, work, folder):
    """Tokens and contexts travel packed, by block and bucket: no table of them, no join of rows."""
    path = Path(work.replace("file://", ""))
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    before = {x for x in path.rglob("*") if x.is_file()}
    found = mixing.score_texts(spark, docs, F.col("doc_id") % 7 != 2)
    assert found.count() == docs.count()
    assert {x for x in path.rglob("*") if x.is_file()} == before
    assert "Join" not in found._jdf.queryExecution().optimizedPlan().toString()


def test_base_scores_equal_counts(spark, docs, texts):
    words = [re.findall(rb"[^\x20\x09-\x0d]+", (t or "").encode().lower()) + [None] for t in texts]
    train = [zlib.crc32(str(k).encode()) % 3 != 0 for k in range(len(texts))]
    counts = Counter(w for own, learn in zip(words, train, strict=True) if learn for w in own)
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 != 0
    found = {x["doc_id"]: x for x in mixing.score_texts(spark, docs, chosen).collect()}
    total, kinds = sum(counts.values()), len(counts)
    for k, own in enumerate(words):
        base = sum(math.log10((counts[w] + 1) / (total + kinds + 1)) for w in own)
        x = found[k]
        assert (x["n_tokens"], x["n_known"], x["train_tokens"], x["held_out"]) == (len(own), sum(w in counts for w in own), total, not train[k])
        assert math.isclose(x["base_score"], base, rel_tol=1e-9)


def test_blocks_and_batches_change_nothing(spark, work, folder, monkeypatch):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    docs = docs.select("doc_id", F.when(F.col("doc_id") % 5 == 0, F.lit("a common text")).otherwise(F.col("text")).alias("text"))
    whole = scored(docs)
    monkeypatch.setattr(mixing, "BLOCK_ROWS", 7)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "5")
    try:
        parts = scored(docs)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert [x[:5] for x in parts] == [x[:5] for x in whole]
    for a, b in zip(parts, whole, strict=True):
        assert math.isclose(a[5], b[5], rel_tol=1e-9) and math.isclose(a[6], b[6], rel_tol=1e-5)


def plain_score(model, data, logits):
    """The mixing bit by bit in double precision; ``logits``: those of each byte's path, for every predictor."""
    weights = [[1 / max(gate, 1)] * len(logits) for gate in range(mixing.GATES)]
    bits = [(float(model.bit[model.first[byte] + k]), [float(row[i][k]) / 16 for row in logits]) for i, byte in enumerate(data) for k in range(model.length[byte])]
    slope, offset, score, edge = 1.0, 0.0, 0.0, 0
    while edge < len(bits):
        end = edge + (mixing.STRETCH if edge < mixing.LATER else mixing.LATER_STRETCH)
        pace = 1 / math.sqrt(edge / mixing.STRETCH + 1)
        moved, pull = [[0.0] * len(logits) for _ in weights], [0.0, 0.0]
        for bit, x in bits[edge:end]:
            gate = max([min(k + 1, mixing.GATES - 1) for k, v in enumerate(x) if v], default=0)
            mixed, sign = sum(v * w for v, w in zip(x, weights[gate], strict=True)), 2 * bit - 1
            margin = max(-30, min(30, (slope * mixed + offset) * sign))
            score -= math.log1p(math.exp(-margin))
            error = sign / (1 + math.exp(margin))
            for k, v in enumerate(x):
                moved[gate][k] += error * slope * mixing.RATE * pace * v
            pull = [pull[0] + error * mixed, pull[1] + error]
        weights = [[max(-1, min(2, w + m)) for w, m in zip(*both, strict=True)] for both in zip(weights, moved, strict=True)]
        step = [max(-0.1, min(0.1, p * mixing.REFINE_RATE / 8 * pace)) for p in pull]
        slope, offset, edge = max(0.5, min(1.5, slope + step[0])), max(-0.5, min(0.5, offset + step[1])), end
    return score / math.log(10)


def test_scores_equal_the_mixing_bit_by_bit():
    r = random.Random(6)
    train = ["".join(r.choice("etaoin shrdlu é漢") for _ in range(3000)).encode()]
    texts = [train[0][100:2500] + b"QZ\x7f~" * 9, b"", train[0][:40], "漢字 QJX".encode(), bytes(range(0x20, 0x7F))]
    model, (data, offsets, (pool, begins)) = trained(train, texts)
    assert model.length[data].max() > 8
    tables = [(model.near[0].reshape(256, -1), mixing.contexts(data, offsets)[0])]
    found = model.score(data, offsets, (pool, begins))
    for i, (a, b) in enumerate(zip(offsets[:-1], offsets[1:], strict=True)):
        logits = []
        for table, last in tables:
            paths = [np.arange(model.first[x], model.first[x] + model.length[x]) for x in data[a:b]]
            logits.append([table[c][p].astype(int) * model.side[p] for c, p in zip(last[a:b], paths, strict=True)])
        logits += [[pool[s : s + model.length[x]].astype(int) for s, x in zip(row[a:b], data[a:b], strict=True)] for row in begins]
        assert math.isclose(found[i], plain_score(model, data[a:b], logits), rel_tol=1e-5, abs_tol=1e-9)
