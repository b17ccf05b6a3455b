"""Operator 12: repeated passages, found by seeds that are extended both ways.

A window is ``LENGTH`` consecutive words.  A window that also starts earlier (in
an earlier document, or earlier in its own) is a repeat, and the words under
such windows form the maximal repeats, which go.

1. Seeds.  Of the ``LENGTH - SEED + 1`` runs of ``SEED`` words in a window the
   one with the least hash (the rightmost of equals) is its anchor.  Equal
   windows have equal anchors at one place, so only anchors are compared.
2. Join.  Anchors that occur once go; every other occurrence meets the first
   one of its hash.  No pairs among the rest are made.
3. Extend.  Both bring the words on either side that their windows reach; these
   are compared word by word, to the left and to the right.  (Of occurrences with
   equal words around them, a task sends on the earliest that it reads.)  The windows inside
   the common stretch are repeats of the first occurrence.  Neighbouring anchors
   continue the stretch, so their union is the maximal repeat.
4. The rest.  A window beyond the common stretch differs from the first
   occurrence's, so its equals lie beyond their stretches too.  These windows
   are grouped by a 128-bit hash; all but the first of a group are repeats.

Scale.  About one word in seven is an anchor.  Hashes are grouped with partial
sums; joins on hot hashes are plain sort-merge joins, which Spark splits.  Word
contexts travel only for anchors that repeat.  Each step is a written table.

Edge cases: NULL text has no words; texts under ``LENGTH`` words keep all; a
NULL id ranks last; rows with one id and different texts are different
documents, ordered by a hash of the text; rows equal in id and text are one
document and each gets its result; an empty table gives no rows; other columns
are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import textkit as tk
from tidemark.llm.shared import write_table

LENGTH, SEED = 20, 8
LAST_ID = (1 << 63) - 1  # stands for NULL
_LOW = np.uint64(0xFFFFFFFF)

ANCHOR = "hash bigint, doc bigint, version bigint, pos int"
CONTEXT = "hash bigint, doc bigint, version bigint, pos int, first boolean, lo int, hi int, left binary, right binary"
CONTEXT_SLICE = 4 << 20  # bytes of text in which equal contexts meet before they travel
FOUND = "doc bigint, version bigint, start int, stop int, window binary"


def single_spaced(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes with one space after every word, word starts and ends in them, and n + 1 word offsets of the rows."""
    data, offsets = tk.text_buffers(column)
    starts, ends, counts = tk.byte_words(data, offsets)
    size = ends - starts
    out = np.append(data, np.uint8(0x20))[tk.ragged(starts, size + 1)]
    stops = np.cumsum(size + 1) - 1
    out[stops] = 0x20
    return out, stops - size, stops, np.concatenate([[0], np.cumsum(counts)])


def anchors_of(data: np.ndarray, starts: np.ndarray, stops: np.ndarray, rows: np.ndarray, length: int, seed: int) -> tuple[np.ndarray, ...]:
    """(hash, word, first window, last window) of the anchors, words counted through the slice."""
    n, reach = len(starts), length - seed + 1
    if n < length:
        none = np.zeros(0, np.int64)
        return none, none, none, none
    hashes = tk.span_hash(data, starts[: n - seed + 1], stops[seed - 1 :])
    least = (hashes >> np.uint64(32) << np.uint64(32)) | (_LOW - np.arange(len(hashes), dtype=np.uint64))
    span = 1
    while 2 * span <= reach:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if span < reach:
        least = np.minimum(least[: len(least) - (reach - span)], least[reach - span :])
    chosen = (_LOW - (least & _LOW)).astype(np.int64)  # by window, 0 .. n - length
    fits = np.zeros(n + 1, np.int64)  # windows that end in the row they begin in
    lengths = np.diff(rows)
    np.add.at(fits, rows[:-1][lengths >= length], 1)
    np.add.at(fits, (rows[1:] - length + 1)[lengths >= length], -1)
    windows = np.flatnonzero(np.cumsum(fits[: len(chosen)]) > 0)
    word = chosen[windows]
    if not len(word):
        return word, word, word, word
    new = np.ones(len(word), bool)
    new[1:] = word[1:] != word[:-1]
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(word)) - 1
    return hashes[word[first]].view(np.int64), word[first], windows[first], windows[last]


def _each_slice(batch: pa.RecordBatch, limit: int = tk.SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, tuple]]:
    _, offsets = tk.text_buffers(batch.column("text"))
    for i, j in tk.slices(offsets, limit):
        part = batch.slice(i, j - i)
        yield part, single_spaced(part.column("text"))


def _anchors(length: int, seed: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, (data, starts, stops, rows) in _each_slice(batch):
                h, word, _, _ = anchors_of(data, starts, stops, rows, length, seed)
                row = np.searchsorted(rows, word, "right") - 1
                doc, version = (part.column(c).to_numpy()[row] for c in ("doc", "version"))
                yield pa.RecordBatch.from_arrays([pa.array(h), pa.array(doc), pa.array(version), pa.array((word - rows[row]).astype(np.int32))], names=["hash", "doc", "version", "pos"])

    return run


def _spans(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> pa.Array:
    """Binary values data[begin:end]."""
    size = np.maximum(end - begin, 0)
    offsets = np.zeros(len(size) + 1, np.int32)
    np.cumsum(size, out=offsets[1:])
    return pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(offsets), pa.py_buffer(data[tk.ragged(begin, size)])])


def _list_field(column: pa.Array, name: str) -> tuple[np.ndarray, np.ndarray]:
    """A field of all structs in a list column, and the row of each."""
    flat = column.flatten().field(name).to_numpy(zero_copy_only=False)
    return flat, np.repeat(np.arange(len(column)), pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False))


def _contexts(length: int, seed: int) -> Callable:
    """The words that the windows of each repeated anchor reach on either side.

    Of equal anchors with equal words around them only the earliest goes on; the
    windows of the others are repeats of its windows, and are returned as such
    (no ``left``): what is frequent meets in the task that reads it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, (data, starts, stops, rows) in _each_slice(batch, CONTEXT_SLICE):
                h, word, lo, hi = anchors_of(data, starts, stops, rows, length, seed)
                at, owner = _list_field(part.column("hits"), "pos")
                first, _ = _list_field(part.column("hits"), "first")
                wanted = rows[owner] + at
                order = np.argsort(wanted)
                wanted, first = wanted[order], first[order].astype(bool)
                k = np.minimum(np.searchsorted(wanted, word), max(len(wanted) - 1, 0))
                hit = np.flatnonzero(wanted[k] == word) if len(wanted) else np.zeros(0, np.int64)
                if not len(hit):
                    continue
                h, word, lo, hi, first = h[hit], word[hit], lo[hit], hi[hit], first[k[hit]]
                row = np.searchsorted(rows, word, "right") - 1
                edge = np.append(starts, len(data))  # a word's stretch goes to the next one's start
                sides = (edge[lo], edge[word]), (edge[word + seed], edge[hi + length])
                doc, version = (part.column(c).to_numpy()[row] for c in ("doc", "version"))
                pos = word - rows[row]
                alike = [h.view(np.uint64), *(tk.span_hash(data, *x) for x in sides)]
                order = np.lexsort((pos, version, doc, *alike))
                new = np.ones(len(order), bool)
                new[1:] = np.any([x[order][1:] != x[order][:-1] for x in alike], axis=0)
                earliest = np.zeros(len(order), bool)
                earliest[order[new]] = True
                # an equal row of the table is the same document
                leader = order[np.flatnonzero(new)[np.cumsum(new) - 1]]
                same = np.empty(len(order), np.int64)
                same[order] = leader
                keep = earliest | ((doc == doc[same]) & (version == version[same]) & (pos == pos[same]))
                bare = pa.array(~keep)
                text = [pc.if_else(bare, pa.scalar(None, pa.binary()), _spans(data, np.where(keep, x, 0), np.where(keep, y, 0))) for x, y in sides]
                place = lambda x: pa.array((x - rows[row]).astype(np.int32))
                columns = [pa.array(h), pa.array(doc), pa.array(version), place(word), pa.array(first), place(lo), place(hi), *text]
                yield pa.RecordBatch.from_arrays(columns, names=[x.split()[0] for x in CONTEXT.split(", ")])

    return run


def common(a: list[bytes], b: list[bytes]) -> int:
    n = 0
    for x, y in zip(a, b, strict=False):
        if x != y:
            break
        n += 1
    return n


def _extend(length: int, seed: int) -> Callable:
    """Windows that both sides share as one stretch, and each other window with its hash."""
    reach = length - seed

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pos, lo, hi = (batch.column(c).to_numpy() for c in ("pos", "lo", "hi"))
            same = pc.and_(pc.equal(batch.column("left"), batch.column("f_left")), pc.equal(batch.column("right"), batch.column("f_right"))).to_numpy(zero_copy_only=False)
            whole = np.flatnonzero(same)
            rows, start, stop, window = whole.tolist(), lo[whole].tolist(), (hi[whole] + length).tolist(), [None] * len(whole)
            rest = np.flatnonzero(~same)
            part = batch.take(pa.array(rest))
            sides = [[x.split() for x in part.column(c).to_pylist()] for c in ("left", "f_left", "right", "f_right")]
            seeds = part.column("hash").to_numpy()
            for r, seed_hash, p, l, e, left, f_left, right, f_right in zip(rest.tolist(), seeds, pos[rest].tolist(), lo[rest].tolist(), hi[rest].tolist(), *sides, strict=True):
                back, on = common(left[::-1], f_left[::-1]), common(right, f_right)
                begin, end = max(l, p - back), min(e, p - reach + on)  # windows inside the common stretch
                if begin <= end:
                    rows.append(r), start.append(begin), stop.append(end + length), window.append(None)
                key = seed_hash.tobytes()
                for s in (*range(l, min(begin, e + 1)), *range(max(end + 1, begin), e + 1)) if begin <= end else range(l, e + 1):
                    text = b" ".join((key, *left[s - l :], b"", *right[: s + length - p - seed]))
                    rows.append(r), start.append(s), stop.append(s + length), window.append(xxhash.xxh3_128_digest(text))
            which = np.array(rows, np.int64)
            doc, version = (batch.column(c).to_numpy()[which] for c in ("doc", "version"))
            yield pa.RecordBatch.from_arrays([pa.array(doc), pa.array(version), pa.array(start, pa.int32()), pa.array(stop, pa.int32()), pa.array(window, pa.binary())], names=[x.split()[0] for x in FOUND.split(", ")])

    return run


def repeat_windows(spark: SparkSession, texts: DataFrame, length: int = LENGTH, seed: int = SEED) -> DataFrame:
    """Stretches of repeats (doc, version, start, stop) in words; ``texts``: doc, version, text."""
    # what a join meets is always a written table, so that Spark can split hot keys of the other side
    found = texts.mapInArrow(_anchors(length, seed), ANCHOR)
    place = F.struct("doc", "version", "pos")
    firsts = found.groupBy("hash").agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("f")).where("n > 1").select("hash", "f")
    firsts = write_table(spark, firsts, "repeats-firsts")
    hits = found.join(firsts, "hash").select("doc", "version", "pos", (F.col("f") == place).alias("first"))
    hits = hits.groupBy("doc", "version").agg(F.collect_set(F.struct("pos", "first")).alias("hits"))
    hits = write_table(spark, hits, "repeats-hits")

    contexts = write_table(spark, texts.join(hits, ["doc", "version"]).mapInArrow(_contexts(length, seed), CONTEXT), "repeats-contexts")
    # rows that are copies of a document bring its first occurrences once each
    first = contexts.where("first AND left IS NOT NULL").groupBy("hash").agg(F.min(F.struct("left", "right")).alias("f"))
    first = write_table(spark, first.select("hash", F.col("f.left").alias("f_left"), F.col("f.right").alias("f_right")), "repeats-first")
    extended = contexts.where("NOT first AND left IS NOT NULL").join(first, "hash").mapInArrow(_extend(length, seed), FOUND)
    extended = write_table(spark, extended, "repeats-extended")

    rest = extended.where("window IS NOT NULL")
    at = F.struct("doc", "version", "start")
    earliest = rest.groupBy("window").agg(F.count(F.lit(1)).alias("n"), F.min(at).alias("f")).where("n > 1").select("window", "f")
    later = rest.join(write_table(spark, earliest, "repeats-earliest"), "window").where(F.col("f") != at)
    spans = ["doc", "version", "start", "stop"]
    met = contexts.where("left IS NULL").select("doc", "version", F.col("lo").alias("start"), (F.col("hi") + length).alias("stop"))
    return met.union(extended.where("window IS NULL").select(*spans)).union(later.select(*spans))


def _removed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, (data, starts, stops, rows) in _each_slice(batch):
            begin, owner = _list_field(part.column("spans"), "start")
            end, _ = _list_field(part.column("spans"), "stop")
            steps = np.zeros(len(starts) + 1, np.int64)
            np.add.at(steps, rows[owner] + begin, 1)
            np.add.at(steps, rows[owner] + end, -1)
            gone = np.cumsum(steps[:-1]) > 0
            mask = np.ones(len(data), bool)
            mask[tk.ragged(starts[gone], stops[gone] - starts[gone] + 1)] = False
            kept = data[mask]
            edges = np.concatenate([[0], np.cumsum(mask)])[np.append(starts, len(data))[rows]]
            before = np.concatenate([[0], np.cumsum(gone)])
            texts = [kept[a : max(a, b - 1)].tobytes() for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)]
            columns = [part.column("doc_id"), pa.array(np.diff(rows)), pa.array(np.diff(before[rows])), pa.array(texts, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "n_removed", "kept"])


def without_repeats(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, seed: int = SEED) -> DataFrame:
    """doc_id, n_words, n_removed and ``kept``: the words that stay, joined by one space, as UTF-8."""
    if not 1 <= seed <= length:
        raise ValueError("a seed has at least one word and at most those of a window")
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), text.alias("text")).select("doc_id", F.coalesce("doc_id", F.lit(LAST_ID)).alias("doc"), F.xxhash64("text").alias("version"), "text")
    spans = repeat_windows(spark, rows.select("doc", "version", "text"), length, seed)
    spans = write_table(spark, spans.groupBy("doc", "version").agg(F.collect_set(F.struct("start", "stop")).alias("spans")), "repeats-spans")
    return rows.join(spans, ["doc", "version"], "left").select("doc_id", "text", "spans").mapInArrow(_removed, "doc_id bigint, n_words bigint, n_removed bigint, kept binary")


def digest_texts(found: DataFrame) -> DataFrame:
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def oracle(length: int = LENGTH) -> str:
    """DuckDB SQL for the digests over ``documents``."""
    return f"""
    WITH d AS (SELECT row_number() OVER () AS k, doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
    g AS (SELECT k, doc_id, unnest(list_transform(range(1, len(w) - {length - 2}), lambda i: {{'s': i, 'g': w[i : i + {length - 1}]}})) AS x FROM d WHERE len(w) >= {length}),
    r AS (SELECT k, x.s AS s, row_number() OVER (PARTITION BY x.g ORDER BY doc_id, x.s) AS n FROM g),
    c AS (SELECT k, list(DISTINCT s + o) AS gone FROM r, range({length}) v(o) WHERE n > 1 GROUP BY k),
    f AS (SELECT doc_id, w, coalesce(gone, []) AS gone, list_filter(w, lambda x, i: NOT list_contains(coalesce(gone, []), i)) AS kept FROM d LEFT JOIN c USING (k))
    SELECT doc_id, len(w) AS n_words, len(gone) AS n_removed, sha256(array_to_string(kept, ' ')) AS kept_sha256 FROM f"""
