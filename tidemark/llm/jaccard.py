"""Operator 8: n-gram Jaccard join with rare-first prefix filtering.

A text's set is its distinct five-word shingles (64-bit hashes of lower-cased
words).  Texts with equal sets form a class and go on as one.  All shingles
are put in one order, rare first; two sets that are similar enough share a
shingle within their first ``n - ceil(t * n) + 1`` (the prefix).  So prefixes
are joined by shingle: rows without another class of their shingle that passes the
length filter are dropped, the others make candidate pairs, subject to the
length filter, the positional filter and a suffix filter.  That one bounds the difference of two sets from
their parts: each row carries, for 1,024 parts of the hash range, whether its
set has an odd number of shingles there, and where two sets disagree at least
one shingle differs.  Pairs that pass are filtered once more by sketches with
several parts for each shingle.  Every pair that is left is verified once,
exactly, from the whole sets.

Rarity comes from a table of counts of a fixed size (hashed, so a count may be
too high).  Any common order gives right results; the table only makes
prefixes rare, and its size does not grow with the corpus.

Linked classes are wanted as components, so a group of many near copies is not
expanded into all its pairs: first the rows of some shingles of a class meet
their next ``NEAR`` neighbours in one of ``ORDERS`` random orders, then
components are formed, and last all rows of a shingle meet the rows of other
components; a common shingle's rows are divided into blocks, and each pair of
blocks is a cell of its own.  No pair that could join two components is left
out.

Edge cases: NULL, empty and wordless texts have an empty set and link with
nothing; texts of one to four words have one shingle, the whole sequence;
repeated rows are one class; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm import partials
from tidemark.llm import textkit as tk
from tidemark.llm.shared import connected_components, write_table

WORDS = 5
#: Size of the table of shingle counts, and of the bitmap of wanted classes (bits).
COUNT_BITS, WANTED_BITS = 21, 24
#: Neighbours that a row meets in the first round, orders in which it meets them (each for a part of the
#: shingles, so that classes with many common shingles have the same few neighbours in all of them), shared
#: shingles of a class that take part in it (the first ones, and one in ``EVERY`` of the others, chosen by
#: hash), and rows of one shingle that stay in one task.  The last round
#: makes up for whatever the first one leaves.
NEAR, ORDERS, FIRST, EVERY, TOGETHER = 4, 2, 8, 16, 100_000
#: Rows of a common shingle that form one block when all of them meet, and rows of a part of it when pairs are verified.
BLOCK, VERIFIED = 4_000, 512
#: Parts of the hash range whose parities a set's sketch holds; parts for each shingle in its fine sketch, at least.
PARITY_BITS, FINE = 1024, 4


def shingle_sets(data: np.ndarray, offsets: np.ndarray, words: int = WORDS) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each row."""
    low = tk.lower_ascii(data)
    starts, ends, counts = tk.byte_words(low, offsets)
    hashes = tk.span_hash(low, starts, ends)
    n = len(hashes)
    grams = np.zeros(n, dtype=np.uint64)
    for k in range(words):
        if k < n:
            grams[: n - k] += tk.splitmix(hashes[k:] ^ np.uint64(k * 0x9E3779B97F4A7C15 & (2**64 - 1)))
    grams = tk.splitmix(grams)
    out, at = [], 0
    for c in counts.tolist():
        if c >= words:
            out.append(np.unique(grams[at : at + c - words + 1]))
        elif c:
            own = sum(int(x) for x in tk.splitmix(hashes[at : at + c] ^ (np.arange(c, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))))
            out.append(tk.splitmix(np.array([(own + (c << 56)) & (2**64 - 1)], dtype=np.uint64)))
        else:
            out.append(np.zeros(0, dtype=np.uint64))
        at += c
    return out


def parity_sketch(grams: np.ndarray, bits: int = PARITY_BITS) -> bytes:
    """One bit for each of ``bits`` (a power of two) parts of the hash range: whether the set has an odd number of shingles there."""
    counts = np.bincount((grams >> np.uint64(65 - bits.bit_length())).astype(np.int64), minlength=bits)
    return np.packbits((counts & 1).astype(np.uint8)).tobytes()


def fine_bits(n: int) -> int:
    """Parts of a set's fine sketch: a power of two, ``FINE`` to twice as many for each shingle."""
    return max(PARITY_BITS, 1 << (FINE * n - 1).bit_length())


def least_difference(x: bytes, y: bytes) -> int:
    """Lower bound of the symmetric difference of two sets from their fine sketches; the finer one is folded."""
    p, q = sorted((np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)), key=len)
    if len(q) > len(p):
        q = np.packbits(np.bitwise_xor.reduce(np.unpackbits(q).reshape(8 * len(p), -1), axis=1))
    return int(np.bitwise_count(p ^ q).sum(dtype=np.int64))


def set_key(grams: np.ndarray) -> int:
    """64-bit key of a whole set (signed)."""
    mixed = tk.splitmix(grams ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64) ^ np.uint64(len(grams) << 40)
    return int(tk.splitmix(np.array([mixed]))[0].astype(np.int64))


def _each_set(batch: pa.RecordBatch, words: int) -> Iterator[tuple[pa.Array, list[np.ndarray]]]:
    data, offsets = tk.text_buffers(batch.column("text"))
    for i, j in tk.slices(offsets):
        yield batch.column("key").slice(i, j - i), shingle_sets(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], words)


def need(share: int, n):
    """Least overlap with some partner, ceil(share * n / 100)."""
    return -(-share * n // 100)


class Join:
    """One run of the operator over ``docs`` (``id_col`` long, ``text_col`` string)."""

    def __init__(self, spark: SparkSession, docs: DataFrame, share: int = 80, words: int = WORDS, id_col: str = "doc_id", text_col: str = "text"):
        self.spark, self.share, self.words = spark, share, words
        self.src = docs.select(docs[id_col].cast("bigint").alias("key"), docs[text_col].alias("text"))

    # -- sets, classes, counts

    def scan(self) -> None:
        words = self.words

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            table = np.zeros(1 << COUNT_BITS, dtype=np.int32)
            for batch in batches:
                for key, sets in _each_set(batch, words):
                    grams = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
                    table += np.bincount((grams & np.uint64(len(table) - 1)).astype(np.int64), minlength=len(table)).astype(np.int32)
                    n = pa.array([len(s) for s in sets], pa.int64())
                    cls = pa.array([set_key(s) if len(s) else None for s in sets], pa.int64())
                    sketch = pa.array([parity_sketch(s) if len(s) else None for s in sets], pa.binary())
                    fine = pa.array([parity_sketch(s, fine_bits(len(s))) if len(s) else None for s in sets], pa.binary())
                    nothing = pa.nulls(len(sets), pa.int32()), pa.nulls(len(sets), pa.binary())
                    yield pa.RecordBatch.from_arrays([key, n, cls, sketch, fine, *nothing], names=names)
            empty = [pa.nulls(1, pa.int64())] * 3 + [pa.nulls(1, pa.binary())] * 2
            for chunk, part in partials.parts_of(table, packed=True):
                yield pa.RecordBatch.from_arrays([*empty, pa.array([chunk], pa.int32()), pa.array([part], pa.binary())], names=names)

        names = ["key", "n", "cls", "sketch", "fine", "chunk", "part"]
        rows = write_table(self.spark, self.src.mapInArrow(run, "key bigint, n bigint, cls bigint, sketch binary, fine binary, " + partials.SCHEMA), "shingles")
        self.docs = rows.where("chunk is null").select("key", "n", "cls")
        self.fine = rows.where("cls is not null").select("cls", "n", "fine")
        self.sketches = rows.where("cls is not null").groupBy("cls").agg(F.min("sketch").alias("sketch"))
        counts = partials.collect_table(rows.where("chunk is not null").select("chunk", "part"), 1 << COUNT_BITS, np.int32, packed=True)
        # 2 MB whatever the corpus
        self.level = self.spark.sparkContext.broadcast(_levels(counts.clip(0)))

    # -- prefixes that several classes share

    def prefixes(self) -> None:
        words, share, level = self.words, self.share, self.level

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            rank = level.value
            done: set[int] = set()  # classes of this task whose rows are out
            for batch in batches:
                for _, sets in _each_set(batch, words):
                    columns: list[list[np.ndarray]] = [[], [], [], []]
                    for grams in sets:
                        n = len(grams)
                        if not n:
                            continue
                        cls = set_key(grams)
                        if cls in done:
                            continue
                        if len(done) > 1_000_000:
                            done.clear()
                        done.add(cls)
                        take = n - need(share, n) + 1
                        levels = rank[(grams & np.uint64(len(rank) - 1)).astype(np.int64)]
                        order = np.argsort(levels, kind="stable")[:take]  # sets are sorted: ties by hash
                        # 56 bits of the shingle and its level: enough to make candidates
                        packed = (grams[order] & ~np.uint64(255) | levels[order]).astype(np.int64)
                        for c, v in zip(columns, (packed, np.full(take, cls), np.full(take, n, np.int32), np.arange(take, dtype=np.int32)), strict=True):
                            c.append(v)
                    if columns[0]:
                        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in columns], names=_COLUMNS)

        schema = "gram bigint, cls bigint, n int, pos int"
        rows = self.src.mapInArrow(run, schema)
        sized = Window.partitionBy("gram").orderBy("n", "cls")
        # copies of a text in several tasks gave the same row
        rows = rows.withColumn("twin", F.lag("cls").over(sized)).where("twin is null or twin != cls")
        every = sized.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        around = {"less": F.lag("n").over(sized), "more": F.lead("n").over(sized), "classes": F.count(F.lit(1)).over(every)}
        # sizes ascend, so the nearest size is next to a row
        partner = (100 * F.col("less").cast("bigint") >= share * F.col("n").cast("bigint")) | (100 * F.col("n").cast("bigint") >= share * F.col("more").cast("bigint"))
        # from here on the low byte tells how many classes share the shingle
        shared = F.least(F.lit(255), F.floor(8 * F.log2(1.0 + F.col("classes")))).cast("bigint")
        rows = rows.withColumns(around).where(partner).withColumn("gram", F.col("gram").bitwiseAND(~255).bitwiseOR(shared)).select(*_COLUMNS)
        by_class = Window.partitionBy("cls").orderBy("pos")
        places = {"before": F.coalesce(F.lag("gram").over(by_class), F.col("cls")), "turn": F.row_number().over(by_class)}
        self.rows = write_table(self.spark, rows.withColumns(places), "prefixes")

    # -- candidates and their verification

    def candidates(self, comp: DataFrame | None) -> DataFrame:
        """Distinct pairs (a < b, with a shingle that both prefixes have and a place among its rows) that pass the
        length, positional and suffix filters: rows of a shingle with their next ``NEAR`` rows, for some shared
        shingles of a class, or, where components are given, with all its rows of other components."""
        share, near = self.share, NEAR if comp is None else None
        rows = self.rows
        if comp is None:
            # a very common shingle's rows are split: neighbours are met, not all
            rows = rows.where((F.col("turn") <= FIRST) | (F.pmod(F.xxhash64("gram"), F.lit(EVERY)) == 0)).join(self.sketches, "cls")
            rows = rows.withColumns({"comp": F.col("cls"), "p": F.lit(0).cast("bigint"), "cell": F.pmod(F.xxhash64("cls"), _blocks("gram", TOGETHER))})
            order = F.xxhash64("cls", F.pmod(F.shiftright("gram", 8), F.lit(ORDERS)))
        else:
            rows = rows.join(comp.select(F.col("node").alias("cls"), F.col("component").alias("comp")), "cls", "left")
            rows = self.apart(rows).join(self.sketches, "cls")
            blocks = _blocks("gram", BLOCK)
            rows = rows.withColumn("p", F.pmod(F.xxhash64("cls"), blocks)).withColumn("q", F.explode(F.sequence(F.lit(0).cast("bigint"), blocks - 1)))
            rows = rows.withColumn("cell", F.greatest("p", "q") * (1 << 31) + F.least("p", "q")).drop("q")
            order = F.col("n")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for r in _runs(batches, near):
                across = (r["cell"] >> 31) != (r["cell"] & ((1 << 31) - 1))
                for d in range(1, len(r["gram"])):
                    if near is not None and d > near:
                        break
                    same = (r["gram"][d:] == r["gram"][:-d]) & (r["cell"][d:] == r["cell"][:-d])
                    if not same.any():
                        break
                    same &= (r["comp"][d:] != r["comp"][:-d]) & r["fresh"][d:]
                    if near is None:
                        # a pair that shares the shared shingle before, too, is made there; one of a single block in that block's cell
                        same &= (r["before"][d:] != r["before"][:-d]) & ~(across[d:] & (r["p"][d:] == r["p"][:-d]))
                    i = np.flatnonzero(same)
                    j = i + d
                    nx, ny = r["n"][i].astype(np.int64), r["n"][j].astype(np.int64)
                    least = -(-share * (nx + ny) // (100 + share))
                    # positional: what follows this shingle in the shorter rest, and what precedes it in both prefixes
                    most = np.minimum(nx - r["pos"][i], ny - r["pos"][j]) + np.minimum(r["pos"][i], r["pos"][j])
                    ok = (100 * np.minimum(nx, ny) >= share * np.maximum(nx, ny)) & (most >= least)
                    i, j, room = i[ok], j[ok], (nx + ny - 2 * least)[ok]
                    # suffix: parts of the hash range whose parities differ
                    ok = np.bitwise_count(r["sketch"][i] ^ r["sketch"][j]).sum(axis=1, dtype=np.int64) <= room
                    i, j = i[ok], j[ok]
                    if len(i):
                        x, y, gram = r["cls"][i], r["cls"][j], r["gram"][i]
                        # neighbours lie in one stretch of the order, or in two that follow each other
                        place = _stretch(gram, r["mix"][i]) if near is not None else r["cell"][i]
                        yield pa.RecordBatch.from_arrays([pa.array(v) for v in (np.minimum(x, y), np.maximum(x, y), gram, place)], names=["a", "b", "gram", "place"])

        placed = rows.withColumn("mix", order).repartition("gram", "cell").sortWithinPartitions("gram", "cell", "mix", "cls")
        pairs = placed.mapInArrow(run, "a bigint, b bigint, gram bigint, place bigint")
        # a shingle makes a pair in one cell only, so there is one place for the least one
        pairs = pairs.groupBy("a", "b").agg(F.min_by("place", "gram").alias("place"), F.min("gram").alias("gram"))
        if comp is not None:
            # all may meet all here: places by the parts of both classes
            parts = _blocks("gram", VERIFIED)
            pairs = pairs.withColumn("place", F.pmod(F.xxhash64("a"), parts) * (1 << 31) + F.pmod(F.xxhash64("b"), parts))
        return pairs

    def apart(self, rows: DataFrame) -> DataFrame:
        """Rows of the shingles that several components have, before sketches join them.  A shingle so
        common that its rows are split keeps them all: no task sees them together."""
        parts = _blocks("gram", TOGETHER)
        rows = rows.withColumns({"cell": F.pmod(F.xxhash64("cls"), parts), "split": parts > 1})

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for r in _runs(batches, None):
                own = np.where(r["alone"], r["cls"], r["comp"])
                keep = r["split"] | _run_differs(r["gram"], own)
                if keep.any():
                    yield pa.RecordBatch.from_arrays([pa.array((own if c == "comp" else r[c])[keep]) for c in names], names=names)

        names = [*_COLUMNS, "before", "comp"]
        # most classes are alone, and zeros take no room in a shuffle
        rows = rows.withColumns({"alone": F.col("comp").isNull(), "comp": F.coalesce("comp", F.lit(0).cast("bigint"))})
        placed = rows.select(*names, "cell", "split", "alone").repartition("gram", "cell").sortWithinPartitions("gram", "cell")
        return placed.mapInArrow(run, "gram bigint, cls bigint, n int, pos int, before bigint, comp bigint")

    def sets_of(self, wanted: DataFrame) -> DataFrame:
        """(cls, grams): whole sets of the wanted classes, from another pass over the texts."""
        words = self.words

        def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            bits = np.zeros(1 << (WANTED_BITS - 3), dtype=np.uint8)
            for batch in batches:
                at = _wanted_bit(np.asarray(batch.column("cls")))
                np.bitwise_or.at(bits, at >> 3, (1 << (at & 7)).astype(np.uint8))
            for chunk, part in partials.parts_of(bits, packed=True):
                yield pa.RecordBatch.from_arrays([pa.array([chunk], pa.int32()), pa.array([part], pa.binary())], names=["chunk", "part"])

        bitmap = partials.collect_table(wanted.mapInArrow(mark, partials.SCHEMA), 1 << (WANTED_BITS - 3), np.uint8, np.bitwise_or, packed=True)
        shared_bits = self.spark.sparkContext.broadcast(bitmap)  # 2 MB, a parameter

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            bits = shared_bits.value
            done: set[int] = set()
            for batch in batches:
                for _, sets in _each_set(batch, words):
                    keys, values = [], []
                    for grams in sets:
                        if not len(grams):
                            continue
                        cls = set_key(grams)
                        at = int(_wanted_bit(np.array([cls]))[0])
                        if cls in done or not bits[at >> 3] >> (at & 7) & 1:
                            continue
                        if len(done) > 1_000_000:
                            done.clear()
                        done.add(cls)
                        keys.append(cls)
                        values.append(pack_set(grams))
                    if keys:
                        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(values, pa.binary())], names=["cls", "grams"])

        return self.src.mapInArrow(run, "cls bigint, grams binary")

    def verify(self, pairs: DataFrame) -> DataFrame:
        """Pairs whose whole sets are similar enough; of a cell's pairs those that its earlier ones do not join.

        Pairs of one shingle and place are verified together, so a set travels
        once per place and not once per pair.
        """
        share = self.share
        both = pairs.select("gram", "place", F.col("a").alias("cls")).union(pairs.select("gram", "place", F.col("b").alias("cls")))
        wanted = write_table(self.spark, both.distinct(), "cells")
        # a class with copies may come from several tasks: the same set each time
        sets = wanted.join(self.sets_of(wanted), "cls").select("gram", "place", F.col("cls").alias("a"), F.lit(0).cast("bigint").alias("b"), F.lit(0).alias("kind"), "grams")
        rows = sets.union(pairs.select("gram", "place", "a", "b", F.lit(1), F.lit(None).cast("binary")))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            cell, held, root = None, {}, {}

            def find(x: int) -> int:
                while (up := root.setdefault(x, x)) != x:
                    root[x] = x = root.setdefault(up, up)
                return x

            for batch in batches:
                keep_a, keep_b = [], []
                columns = [batch.column(c).to_pylist() for c in ("gram", "place", "a", "b", "kind")]
                for k, (g, p, a, b, kind) in enumerate(zip(*columns, strict=True)):
                    if (g, p) != cell:
                        cell, held = (g, p), {}
                        root.clear()
                    if not kind:
                        held[a] = unpack_set(batch.column("grams")[k].as_buffer())
                        continue
                    if find(a) == find(b):
                        continue
                    x, y = held[a], held[b]
                    least = -(-share * (len(x) + len(y)) // (100 + share))
                    if _suffix_bound(x, y) >= least and _overlap(x, y) >= least:
                        root[find(a)] = find(b)
                        keep_a.append(a)
                        keep_b.append(b)
                if keep_a:
                    yield pa.RecordBatch.from_arrays([pa.array(keep_a, pa.int64()), pa.array(keep_b, pa.int64())], names=["a", "b"])

        return rows.repartition("gram", "place").sortWithinPartitions("gram", "place", "kind").mapInArrow(run, "a bigint, b bigint")

    def close(self, pairs: DataFrame) -> DataFrame:
        """Pairs whose fine sketches allow enough overlap.  Sketches, not whole sets, travel to each pair."""
        share = self.share
        ends = write_table(self.spark, pairs.select(F.col("a").alias("cls")).union(pairs.select("b")).distinct(), "ends")
        # copies of a text have one sketch
        fine = write_table(self.spark, self.fine.join(ends, "cls", "left_semi").dropDuplicates(["cls"]), "fine")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                na, nb = (batch.column(c).to_numpy() for c in ("na", "nb"))
                room = na + nb - 2 * -(-share * (na + nb) // (100 + share))
                x, y = batch.column("fa"), batch.column("fb")
                keep = pa.array([least_difference(x[k].as_py(), y[k].as_py()) <= r for k, r in enumerate(room.tolist())], pa.bool_())
                yield batch.select(["a", "b", "gram", "place"]).filter(keep)

        both = pairs.join(fine.toDF("a", "na", "fa"), "a").join(fine.toDF("b", "nb", "fb"), "b")
        return both.mapInArrow(run, "a bigint, b bigint, gram bigint, place bigint")

    def links(self) -> DataFrame:
        """Components (node, component) of linked classes."""
        near = write_table(self.spark, self.candidates(None), "pairs")
        linked = write_table(self.spark, self.verify(write_table(self.spark, self.close(near), "close")), "links")
        comp = connected_components(self.spark, linked)
        rest = write_table(self.spark, self.candidates(comp).join(near.select("a", "b"), ["a", "b"], "left_anti"), "pairs")
        linked = linked.union(write_table(self.spark, self.verify(write_table(self.spark, self.close(rest), "close")), "links"))
        return connected_components(self.spark, linked)

    def run(self) -> DataFrame:
        """(id, n, component): every row with its set's size and the smallest id reachable by links."""
        self.scan()
        self.prefixes()
        comp = self.links()
        classes = self.docs.where("cls is not null").groupBy("cls").agg(F.min("key").alias("first"))
        of_class = classes.join(comp.withColumnRenamed("node", "cls"), "cls", "left").withColumn("component", F.coalesce("component", "cls"))
        # classes of one component: the smallest id of all of them
        least = of_class.groupBy("component").agg(F.min("first").alias("smallest"))
        named = write_table(self.spark, of_class.join(least, "component").select("cls", "smallest"), "classes")
        return self.docs.join(named, "cls", "left").select("key", "n", F.coalesce("smallest", "key").alias("component"))


_COLUMNS = ["gram", "cls", "n", "pos"]


def _levels(counts: np.ndarray) -> np.ndarray:
    """Counts on a scale of one byte, an eighth of a doubling per level."""
    return np.minimum(255, 8 * np.log2(1.0 + counts)).astype(np.uint8)


def _run_differs(gram: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Rows whose shingle has more than one value; rows of a shingle are neighbours."""
    start = np.flatnonzero(np.concatenate([[True], gram[1:] != gram[:-1]]))
    low, high = np.minimum.reduceat(value, start), np.maximum.reduceat(value, start)
    return np.repeat(low != high, np.diff(np.append(start, len(gram))))


def _columns(batch: pa.RecordBatch) -> dict[str, np.ndarray]:
    out = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in batch.schema.names if c != "sketch"}
    if "sketch" in batch.schema.names:
        out["sketch"] = np.frombuffer(b"".join(batch.column("sketch").to_pylist()), dtype=np.uint64).reshape(batch.num_rows, -1)
    return out


def _runs(batches: Iterator[pa.RecordBatch], near: int | None) -> Iterator[dict[str, np.ndarray]]:
    """Sorted rows in pieces: with ``near``, each piece begins with the last ``near`` rows of the one
    before (not ``fresh``); without it, pieces end where a shingle (or its cell) ends."""
    held: dict[str, np.ndarray] | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        new = _columns(batch)
        new["fresh"] = np.ones(batch.num_rows, dtype=bool)
        rows = new if held is None else {c: np.concatenate([held[c], new[c]]) for c in new}
        if near is not None:
            yield rows
            held = {c: v[-near:] for c, v in rows.items()}
            held["fresh"] = np.zeros(len(held["fresh"]), dtype=bool)
        else:
            other = rows["gram"] != rows["gram"][-1]
            if "cell" in rows:
                other |= rows["cell"] != rows["cell"][-1]
            cut = int(np.flatnonzero(other)[-1]) + 1 if other.any() else 0
            if cut:
                yield {c: v[:cut] for c, v in rows.items()}
            held = {c: v[cut:] for c, v in rows.items()}
    if near is None and held is not None and len(held["gram"]):
        yield held


def _blocks(gram: str, rows: int) -> Column:
    """Into how many parts the rows of a shingle go, by the level of its classes in its low byte."""
    estimate = F.pow(F.lit(2.0), F.col(gram).bitwiseAND(255) / 8)
    return (1 + F.floor(estimate / rows)).cast("bigint")


def _stretch(gram: np.ndarray, mix: np.ndarray) -> np.ndarray:
    """Which of the equal stretches of a shingle's order a row is in, with about ``VERIFIED`` rows in each."""
    stretches = 1 + np.floor(np.exp2((gram & 255) / 8) / VERIFIED)
    return np.floor((mix.astype(np.float64) / 2.0**64 + 0.5) * stretches).astype(np.int64)


def _wanted_bit(cls: np.ndarray) -> np.ndarray:
    return (tk.splitmix(cls.astype(np.int64).view(np.uint64)) & np.uint64((1 << WANTED_BITS) - 1)).astype(np.int64)


def pack_set(grams: np.ndarray) -> bytes:
    """A sorted set as the upper 48 bits of each hash; within two texts no two of them meet by chance."""
    return (grams >> np.uint64(16)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def unpack_set(raw: bytes) -> np.ndarray:
    packed = np.frombuffer(raw, dtype=np.uint8).reshape(-1, 6)
    wide = np.zeros((len(packed), 8), dtype=np.uint8)
    wide[:, :6] = packed
    return wide.view("<u8").ravel()


def _overlap(p: np.ndarray, q: np.ndarray) -> int:
    at = np.searchsorted(p, q)
    at[at == len(p)] = 0
    return int((p[at] == q).sum())


def _suffix_bound(p: np.ndarray, q: np.ndarray) -> int:
    """Upper bound of the overlap: both sets are cut at fifteen common points of the hash range."""
    cuts = np.arange(1, 16, dtype=np.uint64) << np.uint64(44)
    a = np.diff(np.concatenate([[0], np.searchsorted(p, cuts), [len(p)]]))
    b = np.diff(np.concatenate([[0], np.searchsorted(q, cuts), [len(q)]]))
    return int(np.minimum(a, b).sum())


def jaccard_components(spark: SparkSession, docs: DataFrame, share: int = 80, words: int = WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, n_shingles, component_id) of every row; sets link from ``share`` percent Jaccard on."""
    out = Join(spark, docs, share, words, id_col, text_col).run()
    return out.select(F.col("key").alias(id_col), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"))
