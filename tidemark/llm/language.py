"""Operator 5: language identification with hyperdimensional profiles.

Every letter has a fixed random vector of +1 and -1.  A trigram's vector binds
(multiplies) its letters' vectors, rotated by two, one and no places; a text's
vector bundles (adds) those of its trigrams; a language's prototype adds the
unit vectors of its training texts.  A text gets the language of the greatest
cosine.  Letters outside a-z are told apart by a hash of their code point.

Prototypes are sums, so training adds up per task and then per language; what
reaches the driver is one vector per distinct language value.

Edge cases: NULL texts and texts without a letter are ``und`` with score 0;
equal cosines go to the language that comes first by name; without training
texts everything is ``und``; repeated rows count each; an empty table gives an
empty table.  Only text and the training rows' lang are read.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructType

from tidemark.llm import textkit as tk

DIMENSIONS, LETTERS, SEED = 512, 40, 20240501
UNDETERMINED = "und"


def letter_vectors(dimensions: int = DIMENSIONS, letters: int = LETTERS, seed: int = SEED) -> np.ndarray:
    return np.random.default_rng(seed).choice(np.array([-1, 1], dtype=np.int8), size=(letters, dimensions))


def letter_numbers(points: np.ndarray) -> np.ndarray:
    """0 for what is no letter, 1-26 for a-z, the rest by hash, of lower-cased code points."""
    other = 27 + (tk.splitmix(points.astype(np.uint64)) % np.uint64(LETTERS - 27)).astype(np.int64)
    plain = (points >= 97) & (points <= 122)
    return np.where(plain, points.astype(np.int64) - 96, np.where(tk.char_classes()[points] == tk.LETTER, other, 0))


def bundles(texts: list[str], letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Vector of each text, and whether it has a letter."""
    clean = [unicodedata.normalize("NFC", t).lower() for t in texts]
    lengths = np.fromiter(map(len, clean), np.int64, len(clean)) + 1
    points = tk.code_points("\0".join(clean) + "\0")
    number = letter_numbers(points)
    row = np.repeat(np.arange(len(texts)), lengths)
    has = np.zeros(len(texts), dtype=bool)
    has[row[number > 0]] = True
    # runs of non-letters count as one gap
    keep = np.ones(len(number), dtype=bool)
    keep[1:] = (number[1:] > 0) | (number[:-1] > 0) | (row[1:] != row[:-1])
    number, row = number[keep], row[keep]
    first = np.concatenate([[True], row[1:] != row[:-1]]) if len(row) else np.zeros(0, bool)
    padded = np.insert(number, np.flatnonzero(first), 0)  # a gap before each text
    row = np.insert(row, np.flatnonzero(first), row[first])
    gram = (padded[:-2] * LETTERS + padded[1:-1]) * LETTERS + padded[2:]
    own = (row[:-2] == row[2:]) & (padded[1:-1] > 0)
    gram, at = gram[own], row[:-2][own]
    out = np.zeros((len(texts), letters.shape[1]), dtype=np.float32)
    if not len(gram):
        return out, has
    kinds, which = np.unique(gram, return_inverse=True)
    bound = np.roll(letters, 2, axis=1)[kinds // LETTERS**2] * np.roll(letters, 1, axis=1)[kinds // LETTERS % LETTERS] * letters[kinds % LETTERS]
    size = max(1, (1 << 22) // len(kinds))  # counts of so many texts at once
    bound = bound.astype(np.float32)
    edges = np.searchsorted(at, np.arange(len(texts) + 1))
    for i in range(0, len(texts), size):
        j = min(i + size, len(texts))
        part = slice(edges[i], edges[j])
        counts = np.bincount((at[part] - i) * len(kinds) + which[part], minlength=(j - i) * len(kinds))
        out[i:j] = counts.reshape(j - i, len(kinds)).astype(np.float32) @ bound
    return out, has


def _each(batch: pa.RecordBatch, letters: np.ndarray) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    data, offsets = tk.text_buffers(batch.column("text"))
    for i, j in tk.slices(offsets, tk.SLICE_BYTES // 2):
        raw = data[offsets[i] : offsets[j]].tobytes()
        texts = [raw[a:b].decode("utf-8", "replace") for a, b in zip(offsets[i:j] - offsets[i], offsets[i + 1 : j + 1] - offsets[i], strict=True)]
        vectors, has = bundles(texts, letters)
        norms = np.linalg.norm(vectors.astype(np.float64), axis=1)
        yield slice(i, j), vectors / np.where(norms > 0, norms, 1)[:, None], has & (norms > 0)


def train(docs: DataFrame, lang_col: str = "lang", text_col: str = "text") -> dict[str, np.ndarray]:
    """Unit prototype of every language value of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters, sums = letter_vectors(), {}
        for batch in batches:
            langs = np.array(batch.column("lang").to_pylist(), dtype=object)
            for part, unit, has in _each(batch, letters):
                for lang in set(langs[part][has]):
                    sums[lang] = sums.get(lang, 0) + unit[has & (langs[part] == lang)].sum(axis=0, dtype=np.float64)
        if sums:
            yield pa.RecordBatch.from_arrays([pa.array(sums, pa.string()), pa.array([v.tolist() for v in sums.values()], pa.list_(pa.float64()))], names=["lang", "total"])

    labelled = docs.select(docs[lang_col].cast("string").alias("lang"), docs[text_col].alias("text")).where("lang is not null and text is not null")
    parts = labelled.mapInArrow(run, "lang string, total array<double>").select("lang", F.posexplode("total").alias("k", "x"))
    # rounded, so that the order of the tasks makes no difference to later comparisons
    sums = parts.groupBy("lang", "k").agg(F.sum(F.round(F.col("x") * 1e6).cast("bigint")).alias("x"))
    rows = sums.groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("k", "x"))).alias("v")).orderBy("lang").collect()
    found = {r["lang"]: np.array([v["x"] for v in r["v"]], dtype=np.float64) for r in rows}
    return {lang: v / np.linalg.norm(v) for lang, v in found.items() if np.linalg.norm(v) > 0}


def identify(docs: DataFrame, prototypes: dict[str, np.ndarray], text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (the greatest cosine, 0 to 1)."""
    if {"lang_pred", "score"} & set(docs.columns):
        raise ValueError("columns lang_pred and score are taken")
    names = sorted(prototypes)
    matrix = np.array([prototypes[n] for n in names], dtype=np.float64).reshape(len(names), DIMENSIONS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters = letter_vectors()
        for batch in batches:
            text = batch.column(batch.schema.get_field_index(text_col))
            pred, score = [UNDETERMINED] * batch.num_rows, np.zeros(batch.num_rows)
            for part, unit, has in _each(pa.RecordBatch.from_arrays([text], names=["text"]), letters):
                if not names:
                    continue
                cosine = unit @ matrix.T
                best = cosine.argmax(axis=1)
                for k in np.flatnonzero(has):
                    pred[part.start + k] = names[best[k]]
                score[part] = np.where(has, np.clip(cosine.max(axis=1), 0, 1), 0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(pred, pa.string()), pa.array(score, pa.float64())], names=[*batch.schema.names, "lang_pred", "score"])

    out = StructType(list(docs.schema.fields)).add("lang_pred", StringType()).add("score", DoubleType())
    return docs.mapInArrow(run, out)


def remainder(id_col: str, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % divisor
