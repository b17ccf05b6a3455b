"""Operator 2: packing documents into sequences by cutting-stock column generation.

A document's ids and one closing id are cut into pieces of a whole sequence and
one remainder.  Remainders are counted in length classes of ``WIDTH`` ids.  A
linear program chooses how often to use each pattern (a multiset of classes
that fits a sequence) at least total sequences; a knapsack dynamic program over
the classes prices new patterns until none helps.  Pattern counts are rounded
down, then up while their items last, and what is left is packed best fit.

The histogram, and so the program and its patterns, have a size fixed by the
number of classes, whatever the corpus is; only they pass through the driver.
Documents are ranked inside their class (in salted buckets, so a class with a
third of all rows is spread) and look up the pattern slot of their rank.

Edge cases: NULL or empty text has only the closing id; repeated rows are
packed each; equal lengths are ranked by the row's number in the written
table; an empty table gives an empty table.  No id is dropped.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions.sequence import sequence_within
from tidemark.llm import textkit as tk
from tidemark.llm.shared import write_table

CAPACITY = 2048
#: Ids per length class; a sequence's padding is at most WIDTH - 1 ids per remainder in it, besides the pattern's own.
WIDTH = 8
#: Rows of one ranking bucket, about.
BUCKET_ROWS = 100_000
#: The program stops when no solution can use this share of sequences less.
GAP = 1e-3
#: Steps of the program per class at most; it is near its best long before, and rounding is right from any step.
MOST_STEPS = 25
#: Pre-tokens whose ids a Python worker keeps; the memo starts anew beyond it.
MEMO_WORDS = 3_000_000


# ---- tokens to pieces -------------------------------------------------------


class WordIds:
    """Ids of texts from the tokenizers library, asked once per distinct pre-token.

    The tokenizer drops white space and encodes every pre-token alone, so new
    pre-tokens go to the library many at a time, with spaces between them; an
    id whose token closes a word ends one pre-token's share.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        spec = json.loads(self.library.to_str())
        suffix = spec["model"]["end_of_word_suffix"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        vocab = self.library.get_vocab()
        self.closes = np.zeros(max(vocab.values()) + 1, dtype=bool)
        self.closes[[i for token, i in vocab.items() if token.endswith(suffix)]] = True
        self.memo = tk.SpanMemo(self._ask, MEMO_WORDS)

    def _ask(self, words: list[bytes]) -> list[list[int]]:
        out: list[list[int]] = []
        for i in range(0, len(words), 50):
            part = [w.decode("utf-8", "surrogatepass") for w in words[i : i + 50]]
            ids = self.library.encode(" ".join(part), add_special_tokens=False).ids
            ends = np.flatnonzero(self.closes[ids]) + 1
            if len(ends) == len(part):
                out += [ids[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)]
            else:  # a pre-token that the library divides further when it stands alone
                out += [e.ids for e in self.library.encode_batch(part, add_special_tokens=False)]
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        if any("<|" in t and any(s in t for s in self.special) for t in texts):
            return [np.array(e.ids, dtype="<u4").tobytes() for e in self.library.encode_batch(texts, add_special_tokens=False)]
        data, final, bounds = tk.word_pretokens(texts)
        ends = np.flatnonzero(final) + 1
        starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
        start, length = self.memo.locate(tk.span_hash(data, starts, ends), starts, ends, data)
        raw = self.memo.pool[tk.ragged(start, length)].astype("<u4").tobytes()
        at = 4 * np.concatenate([[0], np.cumsum(length)])[np.searchsorted(ends, bounds, "right")]
        return [raw[a:b] for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]


_loaded: dict[str, WordIds] = {}


def cut_documents(docs: DataFrame, tokenizer_path: str, closing_id: int, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of every document: whole sequences, then the remainder (id, start, length, ids_crc32, doc_tokens)."""
    closing = np.array([closing_id], dtype="<u4").tobytes()
    size = 4 * capacity

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if tokenizer_path not in _loaded:
            _loaded[tokenizer_path] = WordIds(tokenizer_path)
        for batch in batches:
            for i in range(0, batch.num_rows, 500):
                part = batch.slice(i, 500)
                rows: list[tuple[int, int, int, int, int]] = []
                for k, ids in enumerate(_loaded[tokenizer_path].encode([t or "" for t in part.column("text").to_pylist()])):
                    ids += closing
                    for at in range(0, len(ids), size):
                        piece = ids[at : at + size]
                        rows.append((k, at // 4, len(piece) // 4, zlib.crc32(piece), len(ids) // 4))
                which, *columns = (pa.array(c, pa.int64()) for c in zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays([part.column("key").take(which), *columns], names=["key", "start", "length", "ids_crc32", "doc_tokens"])

    kind = docs.schema[id_col].dataType.simpleString()
    src = docs.select(docs[id_col].alias("key"), docs[text_col].alias("text"))
    out = src.mapInArrow(run, f"key {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint")
    return out.withColumnRenamed("key", id_col)


# ---- the program over the histogram ------------------------------------------


def best_pattern(prices: np.ndarray, sizes: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The pattern of greatest total price that fits: a knapsack over capacities 0..capacity."""
    worth = np.full(capacity + 1, -1.0)
    worth[sizes] = prices
    best = np.zeros(capacity + 1)
    take = np.zeros(capacity + 1, dtype=np.int64)
    for c in range(1, capacity + 1):
        gain = best[c - 1 :: -1] if c else best[:0]
        gain = gain + worth[1 : c + 1]
        k = int(gain.argmax())
        if gain[k] > best[c - 1]:
            best[c], take[c] = gain[k], k + 1
        else:
            best[c] = best[c - 1]
    counts, index, c = np.zeros(len(sizes)), {int(s): i for i, s in enumerate(sizes)}, capacity
    while c > 0:
        if take[c]:
            counts[index[int(take[c])]] += 1
            c -= int(take[c])
        else:
            c -= 1
    return float(best[capacity]), counts


def solve_patterns(sizes: np.ndarray, demand: np.ndarray, capacity: int, gap: float = GAP) -> tuple[np.ndarray, np.ndarray]:
    """Columns (patterns) and amounts of a near-optimal fractional solution.

    Revised simplex over a basis of as many patterns as classes; a new pattern
    enters while it is priced above one sequence and the bound allows a gain.
    """
    m = len(sizes)
    basis = np.diag((capacity // sizes).astype(float))
    inverse = np.diag(1.0 / np.diag(basis))
    demand = demand + 1e-7 * np.arange(1, m + 1)  # no ties between rows, so no cycling
    amount = inverse @ demand
    for step in range(MOST_STEPS * m):
        prices = np.maximum(inverse.sum(axis=0), 0)
        value, pattern = best_pattern(prices, sizes, capacity)
        if not value > 1 + gap:  # the amounts used are then within that share of the least
            break
        direction = inverse @ pattern
        positive = direction > 1e-7
        if not positive.any():
            break
        ratio = np.full(m, np.inf)
        ratio[positive] = np.maximum(amount[positive], 0) / direction[positive]
        out = int(ratio.argmin())
        basis[:, out] = pattern
        if step % 50 == 49:  # rounding errors gather in the updates
            inverse = np.linalg.inv(basis)
        else:
            row = inverse[out] / direction[out]
            inverse -= np.outer(direction, row)
            inverse[out] = row
        amount = inverse @ demand
    return basis, np.maximum(np.nan_to_num(amount), 0)


def plan_patterns(histogram: dict[int, int], capacity: int, gap: float = GAP) -> list[tuple[dict[int, int], int]]:
    """(pattern as class -> items, times used) that packs the whole histogram of class sizes."""
    if not histogram:
        return []
    sizes = np.array(sorted(histogram), dtype=np.int64)
    left = np.array([histogram[int(s)] for s in sizes], dtype=np.int64)
    basis, amount = solve_patterns(sizes, left.astype(float), capacity, gap)
    used: dict[tuple[int, ...], int] = {}

    def use(pattern: np.ndarray, times: int) -> None:
        nonlocal left
        if times > 0:
            left = left - pattern * times
            key = tuple(pattern.tolist())
            used[key] = used.get(key, 0) + times

    columns = basis.T.astype(np.int64)
    floor = np.floor(amount + 1e-9).astype(np.int64)
    for pattern, times in zip(columns, floor, strict=True):
        fits = int((left[pattern > 0] // pattern[pattern > 0]).min())
        use(pattern, min(int(times), fits))
    for j in np.argsort(-(amount - floor), kind="stable"):
        pattern = columns[j]
        if amount[j] > floor[j] and (left >= pattern).all():
            use(pattern, 1)
    # best fit, largest first, for what is left: at most a few sequences per pattern
    bins: list[tuple[int, np.ndarray]] = []
    free = np.zeros(0, dtype=np.int64)
    for k in np.flatnonzero(left)[::-1]:
        for _ in range(int(left[k])):
            room = np.where(free >= sizes[k], free, capacity + 1)
            b = int(room.argmin()) if len(room) else -1
            if b < 0 or room[b] > capacity:
                bins.append((0, np.zeros(len(sizes), dtype=np.int64)))
                free = np.append(free, capacity)
                b = len(bins) - 1
            bins[b][1][k] += 1
            free[b] -= sizes[k]
    for _, pattern in bins:
        use(pattern, 1)
    return [({int(sizes[k]): int(c) for k, c in enumerate(key) if c}, times) for key, times in used.items()]


def slot_table(plan: list[tuple[dict[int, int], int]]) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """Slots (class, first rank, end rank, first sequence, items per sequence), and the number of sequences."""
    taken: dict[int, int] = {}
    rows, sequences = [], 0
    for pattern, times in plan:
        for k, items in pattern.items():
            first = taken.get(k, 0)
            rows.append((k, first, first + items * times, sequences, items))
            taken[k] = first + items * times
        sequences += times
    return rows, sequences


# ---- pieces to sequences ------------------------------------------------------


def pack(spark: SparkSession, pieces: DataFrame, capacity: int = CAPACITY, width: int = WIDTH) -> DataFrame:
    """Pieces (``length`` up to ``capacity``, other columns kept) with ``sequence_id`` and ``offset``."""
    if {"_piece", "_class", "_bucket", "_rank"} & set(pieces.columns):
        raise ValueError("columns that begin with _ are taken")
    pieces = write_table(spark, pieces.withColumn("_piece", F.monotonically_increasing_id()), "pieces")
    units = capacity // width
    size = F.ceil(F.col("length") / width).cast("int")
    classed = pieces.withColumn("_class", size)
    # at most ``units`` rows
    histogram = {r["_class"]: r["n"] for r in classed.where(F.col("length") < capacity).groupBy("_class").agg(F.count(F.lit(1)).alias("n")).collect()}
    slots, sequences = slot_table(plan_patterns(histogram, units))
    salts = 1 + max(histogram.values(), default=0) // BUCKET_ROWS
    salted = F.pmod(F.xxhash64("_piece"), F.lit(salts)) - F.col("length") * salts  # longest first
    ranked = sequence_within(classed.where(F.col("length") < capacity).withColumn("_bucket", salted), ["_class"], "_bucket", ["_piece"], out="_rank")
    # a few thousand rows at most, by the number of classes and patterns: safe to broadcast at any corpus size
    table = spark.createDataFrame(slots, "_k int, _lo bigint, _hi bigint, _seq bigint, _items bigint")
    rank = F.col("_rank") - 1
    placed = ranked.join(F.broadcast(table), (F.col("_class") == F.col("_k")) & (rank >= F.col("_lo")) & (rank < F.col("_hi")))
    placed = placed.withColumn("sequence_id", F.col("_seq") + F.floor((rank - F.col("_lo")) / F.col("_items")).cast("bigint"))
    inside = Window.partitionBy("sequence_id").orderBy(F.desc("length"), "_piece").rowsBetween(Window.unboundedPreceding, -1)
    placed = placed.withColumn("offset", F.coalesce(F.sum("length").over(inside), F.lit(0)).cast("bigint"))
    whole = classed.where(F.col("length") >= capacity).withColumns({"sequence_id": F.lit(sequences) + F.col("_piece"), "offset": F.lit(0).cast("bigint")})
    keep = [c for c in pieces.columns if c != "_piece"] + ["sequence_id", "offset"]
    return placed.select(keep).unionByName(whole.select(keep))
