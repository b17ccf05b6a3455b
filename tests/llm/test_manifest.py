"""The Merkle manifest against a plain tree."""

from __future__ import annotations

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from tidemark.llm import merkle
from corpus_rows import DOCUMENTS


def joined_hash(parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return joined_hash("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row)


def ascii_lower(text):
    return text and "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def tree(level, fanout):
    """The root, and for every leaf its (run, place) on each level."""
    paths, at = [[] for _ in level], list(range(len(level)))
    while len(level) > 1:
        for i, path in enumerate(paths):
            first = at[i] // fanout * fanout
            path.append((level[first : first + fanout], at[i] - first))
            at[i] //= fanout
        level = [joined_hash(level[k : k + fanout]) for k in range(0, len(level), fanout)]
    return level[0], paths


def brute(rows, fanout=16):
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append(r)
    for held in groups.values():
        held.sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
    trees = {g: tree([leaf(r) for r in held], fanout) for g, held in groups.items()}
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    root, above = tree([trees[g][0] for g in order], fanout) if order else (None, [])
    out = []
    for g, top in zip(order, above, strict=True):
        for r, path in zip(groups[g], trees[g][1], strict=True):
            changed = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0
            folded, siblings = leaf((*r[:4], ascii_lower(r[4])) if changed else r), []
            for run, i in path + top:
                siblings += run[:i] + run[i + 1 :]
                folded = joined_hash(run[:i] + [folded] + run[i + 1 :])
            out.append((r[0], leaf(r), trees[g][0], root, joined_hash(siblings), folded, folded == root))
    return sorted(out, key=str)


def mined(spark, df, fanout=16):
    proofs = merkle.manifest(spark, df, {"text": merkle.tampered_text(F.col("text"), F.col("doc_id"))}, fanout=fanout)
    return sorted(map(tuple, merkle.digest_rows(proofs).collect()), key=str)


def rows_in(sizes):
    """Documents of sources of the given sizes, a NULL and a non-ASCII source included."""
    out, k = [], 0
    for s, n in enumerate(sizes):
        source = None if s == 1 else f"é{s}" if s == 2 else f"src{s}"
        for _ in range(n):
            out.append((k * 7 % 1009, source, None if k % 5 == 0 else "en", None if k % 3 == 0 else k, None if k % 11 == 0 else f"Text Nummer {k} ÄÖ"))
            k += 1
    return out


@pytest.mark.parametrize("sizes,fanout", [([1], 16), ([17], 16), ([1, 1], 16), ([300, 16, 1, 17, 2], 16), ([60, 9, 4, 1] + [2] * 14, 3)])
def test_manifest_equals_a_plain_tree(spark, work, sizes, fanout):
    rows = rows_in(sizes)
    assert mined(spark, spark.createDataFrame(rows, "doc_id bigint, source string, lang string, n_chars bigint, text string").repartition(5), fanout) == brute(rows, fanout)


def test_manifest_with_null_repeated_and_long_rows(spark, work):
    rows = [(None, "a", "en", 1, "NULL id"), (5, "a", "en", 1, "Twice"), (5, "a", "en", 1, "Twice"), (5, "a", "en", 1, "Other"), (6, "a", None, None, ""), (7, None, None, None, None), (8, "", "x", 2, "Long " * 50_000)]
    df = spark.createDataFrame(rows, "doc_id bigint, source string, lang string, n_chars bigint, text string")
    extra = df.withColumns({c: F.lit("extra") for c in ("idx", "leaf", "m", "top", "row", "run", "digest", "siblings", "root", "id")})
    assert mined(spark, extra) == brute(rows)


def test_manifest_of_an_empty_table(spark, work):
    assert mined(spark, spark.createDataFrame([], DOCUMENTS)) == []


def test_row_limit_of_the_session_is_restored(spark, work):
    spark.conf.set(merkle.ROW_LIMIT, "77")
    try:
        mined(spark, spark.createDataFrame([(1, "a", "en", 1, "x")], "doc_id bigint, source string, lang string, n_chars bigint, text string"))
        assert spark.conf.get(merkle.ROW_LIMIT) == "77"
    finally:
        spark.conf.unset(merkle.ROW_LIMIT)
