"""Repeated passages against a brute-force version."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import repeats
from corpus_rows import DOCUMENTS, rows_of

GAP = r"[\x20\x09-\x0D]+"


def words_of(text):
    return [w for w in re.split(GAP, text or "") if w]


def brute(rows, length):
    """(id, text) rows with distinct ids."""
    seen, out = set(), []
    for key, text in sorted(rows, key=lambda r: (r[0] is None, r[0])):
        words = words_of(text)
        gone = set()
        for i in range(len(words) - length + 1):
            window = tuple(words[i : i + length])
            if window in seen:
                gone.update(range(i, i + length))
            seen.add(window)
        kept = " ".join(w for i, w in enumerate(words) if i not in gone)
        out.append((key, len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def found(spark, df, **options):
    return sorted(map(tuple, repeats.digest_texts(repeats.without_repeats(spark, df, **options)).collect()), key=str)


@pytest.mark.parametrize("length,seed,words", [(20, 8, 400), (20, 8, 3), (6, 3, 4), (5, 5, 5), (4, 1, 6)])
def test_repeats_equal_brute_force(spark, work, length, seed, words):
    r = random.Random(length * words)
    vocabulary = [f"w{i}" for i in range(words)] + ["é", "Ab", "ab"]
    passages = [[r.choice(vocabulary) for _ in range(r.randint(length - 1, 4 * length))] for _ in range(8)]
    texts = [None, "", " \t ", "one", " ".join(passages[0])]
    for _ in range(60):
        parts = [[r.choice(vocabulary) for _ in range(r.randint(0, 2 * length))]]
        for _ in range(r.randint(0, 3)):
            p = r.choice(passages)
            parts += [p[r.randint(0, 3) : len(p) - r.randint(0, 3)], [r.choice(vocabulary) for _ in range(r.randint(0, length))]]
        texts.append(r.choice([" ", "\n", " \t"]).join(w for p in parts for w in p))
    texts += [texts[20], texts[20] + " end", "same " * 90, "same " * 50, " ".join(vocabulary[:2] * 60)]
    df = spark.createDataFrame(rows_of(texts), DOCUMENTS).repartition(5)
    assert found(spark, df, length=length, seed=seed) == brute(list(enumerate(texts)), length)


def test_anchors_cover_every_window_alike():
    """Equal windows have equal anchors at one place, wherever they lie."""
    import pyarrow as pa

    r = random.Random(2)
    words = [r.choice("abcd") for _ in range(3000)]
    data, starts, stops, rows = repeats.single_spaced(pa.array([" ".join(words), None, "a", " ".join(words[500:800])]))
    h, word, lo, hi = repeats.anchors_of(data, starts, stops, rows, 20, 8)
    place = {}
    for w, a, b in zip(word.tolist(), lo.tolist(), hi.tolist(), strict=True):
        assert w - 12 <= a <= b <= w
        for s in range(a, b + 1):
            place[s] = w - s
    text = words + ["a"] + words[500:800]
    whole = [s for s in range(len(text) - 19) if s + 20 <= 3000 or s >= 3001]
    assert sorted(place) == whole
    seen = {}
    for s in whole:
        assert seen.setdefault(tuple(text[s : s + 20]), place[s]) == place[s]


def test_null_and_repeated_ids_and_clashing_columns(spark, work):
    a, b = " ".join(f"a{i}" for i in range(30)), " ".join(f"b{i}" for i in range(25))
    rows = [(3, a), (3, a), (1, b), (None, a), (None, b + " x")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumns({c: F.lit(1) for c in ("doc", "version", "spans", "hash", "pos", "n_words", "kept")})
    got = {(r["doc_id"], r["n_words"], r["n_removed"]) for r in repeats.without_repeats(spark, df).collect()}
    assert got == {(3, 30, 0), (1, 25, 0), (None, 30, 30), (None, 26, 25)}
    same_id = spark.createDataFrame([(1, a), (1, a + " more")], "doc_id bigint, text string")
    assert sorted(r["n_removed"] for r in repeats.without_repeats(spark, same_id).collect()) == [0, 30]


def test_empty_table_and_long_text(spark, work, none):
    assert found(spark, none) == []
    words = np.random.default_rng(1).integers(0, 10**9, 120_000).astype(str).tolist()
    texts = [" ".join(words), " ".join(words[1000:3000])]
    df = spark.createDataFrame(rows_of(texts), DOCUMENTS)
    assert found(spark, df) == brute(list(enumerate(texts)), 20)
