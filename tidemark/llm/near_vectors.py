"""Operator 7: embedding near-duplicates by Euclidean p-stable hashing.

Normalised vectors are projected on random directions; each projection, shifted
and divided by a width, is rounded down.  A table's bucket is the label with the
values of several projections; a pair meets if any of many tables puts both in
one bucket, and is then tested exactly, in double precision.  Equal vectors of
one label go on as one class with its number of rows.

The number of projections grows with the logarithm of the rows, so buckets stay
small, and the number of tables follows from it, so that a pair right at the
threshold is found with the stated recall.  Buckets are divided into blocks and
each pair of blocks is a cell of its own; a cell compares its vectors as one
matrix product and returns, per vector, how many it links and one link towards
the smallest of its group, never the pairs.  A pair is counted only in the
first table where it meets.

Edge cases: vectors that are NULL, empty, zero or hold NULL or non-finite
components, and rows without a label, link with nothing; vectors of different
lengths do not link; repeated rows link as equal vectors; an empty table gives
an empty table.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import textkit as tk
from tidemark.llm.shared import connected_components, write_table

THRESHOLD, RECALL, WIDTH, SEED = 0.98, 0.999, 0.8, 7
#: Distance at which unrelated unit vectors are taken to lie, for the number of projections.
UNRELATED = 1.2
#: Vectors of one block.
BLOCK = 512


def meet(distance: float, width: float = WIDTH) -> float:
    """Chance that one projection rounds two points at a distance to the same value."""
    r = width / distance
    return math.erf(r / math.sqrt(2)) - 2 / (math.sqrt(2 * math.pi) * r) * (1 - math.exp(-r * r / 2))


def table_sizes(rows: int, threshold: float = THRESHOLD, recall: float = RECALL) -> tuple[int, int]:
    """(projections of a table, tables) for so many rows."""
    projections = max(4, math.ceil(0.75 * math.log(max(rows, 2)) / -math.log(meet(UNRELATED))))
    near = meet(math.sqrt(2 - 2 * threshold)) ** projections
    return projections, math.ceil(math.log(1 - recall) / math.log(1 - near))


def buckets(unit: np.ndarray, projections: int, tables: int, seed: int = SEED) -> np.ndarray:
    """64-bit bucket of every unit vector in every table."""
    rng = np.random.default_rng([seed, unit.shape[1]])
    directions = rng.standard_normal((unit.shape[1], tables * projections))
    shifts = rng.uniform(0, WIDTH, tables * projections)
    cells = np.floor((unit @ directions + shifts) / WIDTH).astype(np.int64).astype(np.uint64).reshape(len(unit), tables, projections)
    out = np.zeros((len(unit), tables), dtype=np.uint64)
    for k in range(projections):
        out = tk.splitmix(out ^ cells[:, :, k])
    return out.astype(np.int64)


def _unit(raw: list[bytes]) -> np.ndarray:
    values = np.frombuffer(b"".join(raw), dtype=np.float64).reshape(len(raw), -1)
    return values / np.linalg.norm(values, axis=1)[:, None]


def near_vectors(spark: SparkSession, vectors: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(id, n_links, component_id, kept) of every row."""
    src = vectors.select(vectors[id_col].cast("bigint").alias("id"), vectors[vector_col].cast("array<double>").alias("v"), vectors[label_col].cast("string").alias("label"))

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw: list[bytes | None] = []
            for v, label in zip(batch.column("v"), batch.column("label"), strict=True):
                values = None
                if v.is_valid and label.is_valid and len(v.values) and not v.values.null_count:
                    values = v.values.to_numpy(zero_copy_only=False) + 0.0  # no negative zeros
                    if not np.isfinite(values).all() or not 0 < np.linalg.norm(values) < np.inf:
                        values = None
                raw.append(None if values is None else values.tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("label"), pa.array(raw, pa.binary())], names=["id", "label", "raw"])

    rows = write_table(spark, src.mapInArrow(clean, "id bigint, label string, raw binary"), "vectors")
    classes = rows.where("raw is not null").groupBy("label", "raw").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("copies"))
    classes = write_table(spark, classes, "classes")
    projections, tables = table_sizes(classes.count(), threshold, recall)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = batch.column("raw").to_pylist()
            found = np.zeros((len(raw), tables), dtype=np.int64)
            sizes = np.array([len(r) for r in raw])
            for size in set(sizes.tolist()):
                same = np.flatnonzero(sizes == size)
                found[same] = buckets(_unit([raw[k] for k in same]), projections, tables)
            at = pa.array(np.repeat(np.arange(len(raw)), tables))
            size_of = pa.array(np.repeat(sizes, tables).astype(np.int32))
            table_of = pa.array(np.tile(np.arange(tables, dtype=np.int32), len(raw)))
            yield pa.RecordBatch.from_arrays([batch.column("rep").take(at), batch.column("label").take(at), size_of, table_of, pa.array(found.ravel())], names=["rep", "label", "size", "tab", "bucket"])

    where = ["label", "size", "tab", "bucket"]
    placed = classes.select("rep", "label", "raw").mapInArrow(hashed, "rep bigint, label string, size int, tab int, bucket bigint")
    placed = write_table(spark, placed, "buckets")
    full = placed.groupBy(*where).agg(F.count(F.lit(1)).alias("n")).where("n > 1").withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int"))
    member = placed.join(full.drop("n"), where).withColumn("own", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    cells = member.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    cells = cells.withColumns({"p": F.least("own", "other"), "q": F.greatest("own", "other")})
    cells = cells.join(classes.select("rep", "copies", "raw"), "rep").select(*where, "p", "q", "own", "rep", "copies", "raw")
    key = [*where, "p", "q"]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: tuple | None = None
        held: list[tuple[int, int, int, bytes]] = []
        for batch in batches:
            keys = zip(*[batch.column(c).to_pylist() for c in key], strict=True)
            values = zip(*[batch.column(c).to_pylist() for c in ("own", "rep", "copies", "raw")], strict=True)
            out: list[tuple[int, int, int]] = []
            for k, row in zip(keys, values, strict=True):
                if k != now:
                    if now is not None:
                        out += cell_links(now[2], now[4] == now[5], held, threshold, projections, tables)
                    now, held = k, []
                held.append(row)
            if out:
                yield _links(out)
        if now is not None and (out := cell_links(now[2], now[4] == now[5], held, threshold, projections, tables)):
            yield _links(out)

    links = cells.repartition(*key).sortWithinPartitions(*key).mapInArrow(compare, "rep bigint, towards bigint, n bigint")
    links = write_table(spark, links, "links")
    counts = links.groupBy("rep").agg(F.sum("n").alias("n"))
    comp = connected_components(spark, links, "rep", "towards").select(F.col("node").alias("rep"), "component")
    named = classes.join(counts, "rep", "left").join(comp, "rep", "left")
    named = named.select("label", "raw", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id"))
    out = rows.join(named, ["label", "raw"], "left").select("id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), F.coalesce("component_id", "id").alias("component_id"))
    return out.select(F.col("id").alias(id_col), "n_links", "component_id", (F.col("id") == F.col("component_id")).alias("kept"))


def _links(rows: list[tuple[int, int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], names=["rep", "towards", "n"])


def cell_links(table: int, alone: bool, held: list[tuple[int, int, int, bytes]], threshold: float, projections: int, tables: int) -> list[tuple[int, int, int]]:
    """(vector, a linked vector, rows that it links) of a cell: counts once per vector, links of a
    spanning forest; ``alone``: one block with itself."""
    own, reps, copies = (np.array(c, dtype=np.int64) for c in zip(*[h[:3] for h in held], strict=True))
    unit = _unit([h[3] for h in held])
    seen = buckets(unit, projections, tables)[:, : table + 1]
    cosine = unit @ unit.T
    near = cosine >= threshold
    np.fill_diagonal(near, False)
    if not alone:
        near &= own[:, None] != own[None, :]
    # an earlier table has counted the pair
    for t in range(table):
        if not near.any():
            return []
        near &= seen[:, t][:, None] != seen[:, t][None, :]
    linked = np.flatnonzero(near.any(axis=1))
    out = []
    # a spanning forest of the links
    parent = {int(i): int(i) for i in linked}

    def find(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i in linked.tolist():
        n = int(copies[near[i]].sum())
        first = True
        for j in np.flatnonzero(near[i]).tolist():
            a, b = find(i), find(j)
            if a != b:
                parent[max(a, b)] = min(a, b)
                out.append((int(reps[i]), int(reps[j]), n if first else 0))
                first = False
        if first:
            out.append((int(reps[i]), int(reps[i]), n))
    return out
