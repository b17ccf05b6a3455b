"""Operator 13: hard negatives by segment summaries.

A row's score for an anchor is the integer inner product of their vectors.  An
anchor's positives are its best rows of the same label; for each of them, its
hard negatives are the best rows of other labels whose score lies between two
percentages of the positive's score.

Every vector is stored with the mean and the deviation of its segments, at
three levels (``SEGMENTS``).  For two vectors the sum over segments of the
means' product, plus or minus the product of the deviations, bounds the score:
by Cauchy and Schwarz on what remains when the means are taken off.  A pair
whose bounds miss what its anchor still looks for goes; the rest meet the next,
finer level, and at last the exact score.  While most pairs of a block stay,
a level is one matrix product; afterwards only the remaining pairs are worked.

Scale.  Anchors are a stated query set.  They form blocks of about
``BLOCK_ROWS``, every row goes to one stripe of each block, and a cell (block,
stripe) is one group of a task: it holds its anchors and the lists of the best
so far, and the rows stream past.  For positives the cells are per label as well.
A label with a third of the rows is thus spread over all stripes.  The cells'
lists (never more than asked for) are ranked with a window per anchor.

Edge cases: rows with a NULL id, label or vector, or a NULL or non-finite
component, take no part; vectors are compared only with vectors of their
length, empty ones included; equal scores go by smaller id; rows that share an
anchor's id are never its positives or negatives; a repeated anchor row mines
again; a positive without negatives gives no row; an empty table gives no rows;
other columns are ignored; a score beyond 64 bits is an error.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.shared import write_table

SEGMENTS = (1, 4, 16)
BLOCK_ROWS = 8192
STRIPES = 32
CHUNK_CELLS = 1 << 22  # pairs worked on at once
FEW = 0.125  # below this share of pairs, single pairs instead of matrix products
LEAST = np.iinfo(np.int64).min
STORED = "id bigint, label bigint, dim int, vec binary, summary binary"


def quantised(vector: Column, scale: int = 256) -> Column:
    """floor(scale * x) of every component, x as double."""
    return F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("bigint"))


def usable(vector: Column) -> Column:
    """Neither NULL nor with a NULL or non-finite component."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(False))


def segment_summaries(vectors: np.ndarray) -> np.ndarray:
    """For each level its segments' means, times the root of their length, then their deviations' norms."""
    n, dim = vectors.shape
    out = []
    for count in SEGMENTS:
        edges = [dim * k // count for k in range(count + 1)]
        means, rest = np.zeros((n, count)), np.zeros((n, count))
        for k in range(count):
            part = vectors[:, edges[k] : edges[k + 1]]
            if part.shape[1]:
                mean = part.mean(axis=1)
                means[:, k] = mean * np.sqrt(part.shape[1])
                rest[:, k] = np.sqrt(((part - mean[:, None]) ** 2).sum(axis=1))
        out += [means, rest]
    return np.concatenate(out, axis=1).astype(np.float32)


def _store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Vectors as the narrowest integers that hold them, with their summaries."""
    for batch in batches:
        lists = batch.column("vector")
        dims = np.diff(np.frombuffer(lists.buffers()[1], np.int32)[lists.offset : lists.offset + len(lists) + 1])
        values = lists.flatten().to_numpy(zero_copy_only=False)
        ends = np.cumsum(dims)
        vec, summary = [None] * len(dims), [None] * len(dims)
        for dim in np.unique(dims).tolist():
            rows = np.flatnonzero(dims == dim)
            block = values[(ends[rows] - dim)[:, None] + np.arange(dim)] if dim else np.zeros((len(rows), 0), np.int64)
            sums = segment_summaries(block.astype(np.float64))
            peak = np.abs(block.astype(np.float64)).max(axis=1, initial=0.0)
            for r, row, top, s in zip(rows.tolist(), block, peak.tolist(), sums, strict=True):
                kind = np.int16 if top < 1 << 15 else np.int32 if top < 1 << 31 else np.int64
                vec[r], summary[r] = row.astype(kind).tobytes(), s.tobytes()
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), batch.column("label"), pa.array(dims, pa.int32()), pa.array(vec, pa.binary()), pa.array(summary, pa.binary())], names=["id", "label", "dim", "vec", "summary"]
        )


@dataclass
class Rows:
    """Vectors of one length: ids, labels, components, summaries."""

    ids: np.ndarray
    labels: np.ndarray
    vec: np.ndarray
    summary: np.ndarray

    @classmethod
    def read(cls, batch: pa.RecordBatch, dim: int) -> Rows:
        raw = batch.column("vec").to_pylist()
        widths = {len(b) // dim for b in raw} if dim else set()
        if len(widths) == 1:
            vec = np.frombuffer(b"".join(raw), dtype=f"i{widths.pop()}").reshape(len(raw), dim)
        else:
            vec = np.array([np.frombuffer(b, dtype=f"i{len(b) // dim}") for b in raw], dtype=np.int64).reshape(len(raw), dim) if dim else np.zeros((len(raw), 0), np.int64)
        summary = np.frombuffer(b"".join(batch.column("summary").to_pylist()), np.float32).reshape(len(raw), 2 * sum(SEGMENTS))
        return cls(batch.column("id").to_numpy(), batch.column("label").to_numpy(), vec.astype(np.int64), summary.astype(np.float64))

    def part(self, i: int, j: int) -> Rows:
        return Rows(self.ids[i:j], self.labels[i:j], self.vec[i:j], self.summary[i:j])

    @staticmethod
    def joined(parts: list[Rows]) -> Rows:
        return Rows(*(np.concatenate([getattr(p, f) for p in parts]) for f in ("ids", "labels", "vec", "summary")))


def candidate_pairs(a: Rows, b: Rows, allowed: np.ndarray, floor: np.ndarray, ceiling: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs (i, j, score) that are allowed and have floor[i] <= score <= ceiling[i]; no others are scored."""
    alive, pairs, at = allowed, None, 0
    # summaries are kept in single precision
    slack = 1e-5 * np.outer(np.hypot(a.summary[:, 0], a.summary[:, 1]), np.hypot(b.summary[:, 0], b.summary[:, 1])) + 1e-3
    low, high = floor.astype(np.float64), ceiling.astype(np.float64)
    for count in SEGMENTS:
        mean, rest = slice(at, at + count), slice(at + count, at + 2 * count)
        at += 2 * count
        if pairs is None:
            centre, spread = a.summary[:, mean] @ b.summary[:, mean].T, a.summary[:, rest] @ b.summary[:, rest].T + slack
            alive = alive & (centre + spread >= low[:, None]) & (centre - spread <= high[:, None])
            if np.count_nonzero(alive) < FEW * alive.size:
                pairs = np.nonzero(alive)
        else:
            i, j = pairs
            centre = np.einsum("nk,nk->n", a.summary[i, mean], b.summary[j, mean])
            spread = np.einsum("nk,nk->n", a.summary[i, rest], b.summary[j, rest]) + slack[i, j]
            stay = (centre + spread >= low[i]) & (centre - spread <= high[i])
            pairs = i[stay], j[stay]
    greatest = float(np.abs(a.vec).max(initial=0)) * float(np.abs(b.vec).max(initial=0)) * a.vec.shape[1]
    if greatest >= 2.0**63:
        raise OverflowError("an inner product may not fit in 64 bits")
    if pairs is None:  # doubles add whole numbers exactly up to 2 ** 53
        kind = np.float64 if greatest < 2.0**53 else np.int64
        scores = a.vec.astype(kind) @ b.vec.astype(kind).T
        i, j = np.nonzero(alive & (scores >= floor[:, None]) & (scores <= ceiling[:, None]))
        return i, j, scores[i, j].astype(np.int64)
    i, j = pairs
    scores = np.einsum("nk,nk->n", a.vec[i], b.vec[j])
    stay = (scores >= floor[i]) & (scores <= ceiling[i])
    return i[stay], j[stay], scores[stay]


class Best:
    """The best ``k`` (score, id) of every slot: higher scores first, then smaller ids."""

    def __init__(self, slots: int, k: int):
        self.k = k
        self.slot = np.zeros(0, np.int64)
        self.score, self.id = self.slot.copy(), self.slot.copy()
        self.worst = np.full(slots, LEAST)  # the score of the last place, once all are taken

    def add(self, slot: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        keep = score >= self.worst[slot]
        slot, score, ids = (np.concatenate(x) for x in ((self.slot, slot[keep]), (self.score, score[keep]), (self.id, ids[keep])))
        order = np.lexsort((ids, -score, slot))
        slot, score, ids = slot[order], score[order], ids[order]
        rank = np.arange(len(slot)) - np.searchsorted(slot, slot)
        self.worst[slot[rank == self.k - 1]] = score[rank == self.k - 1]
        stay = rank < self.k
        self.slot, self.score, self.id = slot[stay], score[stay], ids[stay]


def _cells(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.RecordBatch, bool]]:
    """Pieces of the sorted batches that lie in one cell and are of one kind, and whether a cell begins."""
    before = None
    for batch in batches:
        marks = np.stack([batch.column(k).to_numpy() for k in [*keys, "kind"]], axis=1)
        cuts = [0, *(np.flatnonzero((marks[1:] != marks[:-1]).any(axis=1)) + 1).tolist(), len(marks)]
        for i, j in zip(cuts[:-1], cuts[1:], strict=True):
            if j > i:
                cell = tuple(marks[i][:-1])
                yield batch.slice(i, j - i), cell != before
                before = cell


def _sweep(keys: list[str], work: type):
    """A function for mapInArrow: anchors of a cell (kind 0), then its rows in chunks, then the cell's lists."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, task, dim = [], None, 0
        for piece, fresh in _cells(batches, keys):
            if fresh:
                if task is not None:
                    yield from task.results()
                held, task, dim = [], None, piece.column("dim")[0].as_py()
            if piece.column("kind")[0].as_py() == 0:
                held.append(piece)
                continue
            if not held and task is None:
                continue  # a cell without anchors
            if task is None:
                task, held = work(held, dim), []
            rows = Rows.read(piece, dim)
            step = max(1, CHUNK_CELLS // len(task.anchors.ids))
            for i in range(0, len(rows.ids), step):
                task.see(rows.part(i, i + step))
        if task is not None:
            yield from task.results()

    return run


class Positives:
    """Each anchor's best rows of its own label (the cell's)."""

    schema = "a bigint, id bigint, score bigint"
    wanted = 5

    def __init__(self, pieces: list[pa.RecordBatch], dim: int):
        self.anchors = Rows.joined([Rows.read(p, dim) for p in pieces])
        self.a = np.concatenate([p.column("a").to_numpy() for p in pieces])
        self.best = Best(len(self.a), self.wanted)

    def see(self, rows: Rows) -> None:
        other = self.anchors.ids[:, None] != rows.ids
        i, j, score = candidate_pairs(self.anchors, rows, other, self.best.worst, np.full(len(self.a), np.iinfo(np.int64).max))
        self.best.add(i, score, rows.ids[j])

    def results(self) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_arrays([pa.array(self.a[self.best.slot]), pa.array(self.best.id), pa.array(self.best.score)], names=["a", "id", "score"])


class Negatives:
    """The best rows of other labels for each of an anchor's positives, within its band of scores."""

    schema = "a bigint, slot int, id bigint, score bigint"
    wanted, low, high = 10, 30, 90

    def __init__(self, pieces: list[pa.RecordBatch], dim: int):
        self.anchors = Rows.joined([Rows.read(p, dim) for p in pieces])
        self.a = np.concatenate([p.column("a").to_numpy() for p in pieces])
        scores = [s for p in pieces for s in p.column("scores").to_pylist()]
        self.slots = max(map(len, scores))
        band = lambda s: (-(-self.low * s // 100), self.high * s // 100)
        bands = np.array([[band(x) for x in s] + [(1, 0)] * (self.slots - len(s)) for s in scores], np.int64).reshape(len(scores), self.slots, 2)
        self.floor, self.ceiling = bands[:, :, 0], bands[:, :, 1]
        self.best = Best(len(self.a) * self.slots, self.wanted)

    def see(self, rows: Rows) -> None:
        other = (self.anchors.labels[:, None] != rows.labels) & (self.anchors.ids[:, None] != rows.ids)
        floor = np.maximum(self.floor, self.best.worst.reshape(self.floor.shape))
        open_ = floor <= self.ceiling
        least = np.where(open_, floor, np.iinfo(np.int64).max).min(axis=1)
        most = np.where(open_, self.ceiling, LEAST).max(axis=1)
        i, j, score = candidate_pairs(self.anchors, rows, other, least, most)
        for k in range(self.slots):
            inside = (score >= floor[i, k]) & (score <= self.ceiling[i, k])
            self.best.add(i[inside] * self.slots + k, score[inside], rows.ids[j[inside]])

    def results(self) -> Iterator[pa.RecordBatch]:
        anchor, slot = np.divmod(self.best.slot, self.slots)
        yield pa.RecordBatch.from_arrays([pa.array(self.a[anchor]), pa.array(slot.astype(np.int32)), pa.array(self.best.id), pa.array(self.best.score)], names=["a", "slot", "id", "score"])


def _meet(anchors: DataFrame, rows: DataFrame, blocks: int, stripes: int, keys: list[str], work: type) -> DataFrame:
    """Anchors in every stripe of their block, rows in one stripe of every block."""
    first = anchors.withColumns({"kind": F.lit(0), "block": F.pmod(F.xxhash64("a"), F.lit(blocks)).cast("int"), "stripe": F.explode(F.sequence(F.lit(0), F.lit(stripes - 1)))})
    then = rows.withColumns({"kind": F.lit(1), "stripe": F.pmod(F.xxhash64("id", "vec"), F.lit(stripes)).cast("int"), "block": F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))})
    both = first.unionByName(then, allowMissingColumns=True)
    return both.repartition(*keys).sortWithinPartitions(*keys, "kind").mapInArrow(_sweep(keys, work), work.schema)


def mine(spark: SparkSession, rows: DataFrame, anchor: Column, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90, blocks_of: int = BLOCK_ROWS, stripes: int = STRIPES) -> DataFrame:
    """Hard negatives of the rows for which ``anchor`` holds.

    ``rows``: id, label, vector (array of bigint), all usable.  Returns
    anchor_id, positive_id, rank, negative_id, positive_score, negative_score.
    """
    near = type("Positives", (Positives,), {"wanted": positives})
    far = type("Negatives", (Negatives,), {"wanted": negatives, "low": low, "high": high})
    stored = write_table(spark, rows.select(F.col("id").cast("bigint"), F.col("label").cast("bigint"), "vector").mapInArrow(_store, STORED), "negatives-vectors")
    anchors = write_table(spark, stored.where(anchor).withColumn("a", F.monotonically_increasing_id()), "negatives-anchors")
    blocks = max(1, -(-anchors.count() // blocks_of))

    ranked = lambda df, by, k: df.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(F.col("score").desc(), "id"))).where(F.col("rank") <= k)
    found = ranked(_meet(anchors, stored, blocks, stripes, ["label", "block", "stripe", "dim"], near), ["a"], positives)
    found = found.groupBy("a").agg(F.sort_array(F.collect_list(F.struct("rank", "id", "score"))).alias("found"))
    with_positives = anchors.join(found, "a").withColumns({"positive_ids": F.col("found.id"), "scores": F.col("found.score")}).drop("found")
    with_positives = write_table(spark, with_positives, "negatives-positives")

    mined = ranked(_meet(with_positives.drop("positive_ids"), stored, blocks, stripes, ["block", "stripe", "dim"], far), ["a", "slot"], negatives)
    named = with_positives.select("a", F.col("id").alias("anchor_id"), "positive_ids", "scores")
    return mined.join(named, "a").select(
        "anchor_id", F.expr("positive_ids[slot]").alias("positive_id"), F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"),
        F.expr("scores[slot]").alias("positive_score"), F.col("score").alias("negative_score"),
    )


def oracle() -> str:
    """DuckDB SQL for the query over ``embeddings``."""
    return """
    WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
               FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
               AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x::DOUBLE))) = 0),
    s AS (SELECT a.vec_id AS anchor_id, a.label AS own, b.vec_id, b.label, list_inner_product(a.q, b.q)::BIGINT AS score
          FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id AND len(a.q) = len(b.q)),
    p AS (SELECT * FROM s WHERE label = own QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
    n AS (SELECT p.anchor_id, p.vec_id AS positive_id, row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY s.score DESC, s.vec_id)::INT AS rank,
                 s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score
          FROM p JOIN s ON s.anchor_id = p.anchor_id AND s.label <> s.own AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score)
    SELECT * FROM n WHERE rank <= 10"""
