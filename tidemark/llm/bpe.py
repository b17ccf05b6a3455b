"""Operator 1: byte-level BPE encoding and decoding over rank files.

Two tiers resolve a pre-token.  A minimal perfect hash over the vocabulary
answers every pre-token that is a vocabulary entry as a whole, for a slice of
text at once.  The distinct misses of the slice are merged one by one: a heap
of candidate merges over linked bytes always takes the lowest rank, leftmost
first.  A bounded memo keeps merged misses between slices.

Edge cases: NULL text counts as empty and has no ids (the digest of nothing);
repeated rows give repeated results; an empty table gives an empty table.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm import textkit as tk

#: Merged misses that one Python worker keeps; the memo starts anew beyond it.
MEMO_ENTRIES = 3_000_000


class MinimalPerfectHash:
    """Keys (64-bit hashes) to 0..n-1 by levels of collision-free bits.

    On each level every remaining key takes a position in a table of twice as
    many bits; positions that only one key takes are that key's, the others
    go on to the next level.  The index is the rank of the bit over all levels.
    """

    def __init__(self, keys: np.ndarray):
        self.levels: list[np.ndarray] = []
        index = np.zeros(len(keys), dtype=np.int64)
        left, rank = np.arange(len(keys)), 0
        while len(left):
            size = max(2 * len(left), 8)
            position = self._position(keys[left], len(self.levels), size)
            alone = np.bincount(position, minlength=size) == 1
            ranks = np.where(alone, rank + np.cumsum(alone) - 1, -1).astype(np.int32)
            settled = alone[position]
            index[left[settled]] = ranks[position[settled]]
            rank += int(alone.sum())
            self.levels.append(ranks)
            left = left[~settled]
        self.index_of_build_keys = index

    @staticmethod
    def _position(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        return (tk.splitmix(keys + np.uint64(level * 0x632BE59BD9B4E019 & (2**64 - 1))) % np.uint64(size)).astype(np.int64)

    def lookup(self, keys: np.ndarray) -> np.ndarray:
        """Index of each key that was built in; any index or -1 for others."""
        out = np.full(len(keys), -1, dtype=np.int64)
        left = np.arange(len(keys))
        for level, ranks in enumerate(self.levels):
            found = ranks[self._position(keys[left], level, len(ranks))]
            out[left] = found
            left = left[found < 0]
            if not len(left):
                break
        return out


class ByteBpe:
    """Encoder and decoder for one rank file."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.token_bytes = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.token_bytes[rank] = token
        self.id_text = [str(i) for i in range(len(self.token_bytes))]
        tokens = list(ranks)
        ends = np.cumsum([len(t) for t in tokens])
        starts = ends - np.array([len(t) for t in tokens])
        joined = np.frombuffer(b"".join(tokens), dtype=np.uint8)
        keys = tk.span_hash(joined, starts, ends)
        self.hash = MinimalPerfectHash(keys)
        order = self.hash.index_of_build_keys
        self.key_at = np.zeros(len(tokens), dtype=np.uint64)
        self.id_at = np.zeros(len(tokens), dtype=np.int64)
        self.key_at[order] = keys
        self.id_at[order] = np.fromiter(ranks.values(), np.int64, len(tokens))
        self.memo = tk.SpanMemo(lambda pieces: [self.merge(p) for p in pieces], MEMO_ENTRIES)

    @classmethod
    def from_file(cls, path: str) -> ByteBpe:
        with open(path, "rb") as lines:
            return cls({base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)})

    def merge(self, piece: bytes) -> list[int]:
        """Ids of one pre-token: a heap of merges over linked bytes.

        A heap entry packs (rank, begin, end) of the merged part into one
        integer, so entries compare by rank and then leftmost first.
        """
        n, rank_of = len(piece), self.ranks.get
        bits = n.bit_length()
        low = (1 << bits) - 1
        following = list(range(1, n + 1))  # end of the part that begins at i; 0: no part begins there
        before = list(range(-1, n - 1))
        heap = []
        for i in range(n - 1):
            rank = rank_of(piece[i : i + 2])
            if rank is not None:
                heap.append((rank << bits | i) << bits | i + 2)
        heapify(heap)
        while heap:
            entry = heappop(heap)
            end, i = entry & low, entry >> bits & low
            middle = following[i]
            if not middle or middle >= end or following[middle] != end:
                continue  # one of the two parts has been merged since
            following[i], following[middle] = end, 0
            if end < n:
                before[end] = i
                right = following[end]
                rank = rank_of(piece[i:right])
                if rank is not None:
                    heappush(heap, (rank << bits | i) << bits | right)
            left = before[i]
            if left >= 0:
                rank = rank_of(piece[left:end])
                if rank is not None:
                    heappush(heap, (rank << bits | left) << bits | end)
        out, i, ranks = [], 0, self.ranks
        while i < n:
            out.append(ranks[piece[i : following[i]]])
            i = following[i]
        return out

    def pieces(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Byte spans of all pre-tokens of the rows, and how many each row has.

        The spans are those of the published pattern (contractions; an optional
        space with a run of letters, numbers or others; white space), found from
        runs of character classes of the whole slice.
        """
        points = tk.code_points(data.tobytes().decode("utf-8", "replace"))
        ends_in_bytes = tk.byte_ends(points)
        rows = np.searchsorted(ends_in_bytes, offsets)
        n = len(points)
        if not n:
            z = np.zeros(0, np.int64)
            return z, z, np.zeros(len(offsets) - 1, np.int64)
        kind = tk.char_classes()[points]
        row_start = np.zeros(n + 1, dtype=bool)
        row_start[rows] = True
        begin = row_start[:n].copy()
        begin[1:] |= kind[1:] != kind[:-1]
        space = kind == tk.SPACE
        # white space before text leaves its last character for the next token
        last_space = np.zeros(n, dtype=bool)
        last_space[:-1] = space[:-1] & ~space[1:] & ~row_start[1:n]
        begin |= last_space
        # that character joins the text when it is a plain space
        joined = np.flatnonzero(last_space & (points == 0x20))
        begin[joined + 1] = False
        # contractions: an apostrophe that is a whole token, before its letters
        at = np.flatnonzero((points == 0x27) & begin)
        at = at[at + 1 < n]
        at = at[begin[at + 1] & ~row_start[at + 1]]
        more = tk.contraction_lengths(points, at)
        at, more = at[more > 0], more[more > 0]
        if len(at):
            # a two-letter ending must lie in the same row, as its letters do
            fits = ~((more == 2) & row_start[np.minimum(at + 2, n)])
            at, more = at[fits], more[fits]
            begin[at + 1] = False
            after = at + 1 + more
            begin[after[after < n]] = True
        first = np.flatnonzero(begin)
        counts = np.diff(np.searchsorted(first, rows))
        last = np.append(first[1:], n)
        return ends_in_bytes[first], ends_in_bytes[last], counts

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows one after the other, and how many each row has."""
        starts, ends, counts = self.pieces(data, offsets)
        if not len(starts):
            return np.zeros(0, np.int64), counts
        keys = tk.span_hash(data, starts, ends)
        slot = self.hash.lookup(keys)
        whole = (slot >= 0) & (self.key_at[slot] == keys)
        # entry i of the pool, for i below the size of the vocabulary, is id i; merged misses follow
        pool_start = np.where(whole, self.id_at[slot], 0)
        pool_len = np.ones(len(keys), dtype=np.int64)
        missed = np.flatnonzero(~whole)
        if len(missed):
            start, length = self.memo.locate(keys[missed], starts[missed], ends[missed], data)
            pool_start[missed], pool_len[missed] = len(self.token_bytes) + start, length
        at = tk.ragged(pool_start, pool_len)
        merged = at - len(self.token_bytes)
        ids = at
        if len(missed):
            ids = np.where(merged >= 0, self.memo.pool[np.maximum(merged, 0)], at)
        ends_of_rows = np.concatenate([[0], np.cumsum(pool_len)])[np.concatenate([[0], np.cumsum(counts)])]
        return ids, np.diff(ends_of_rows)

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.token_bytes.__getitem__, ids))


_loaded: dict[str, ByteBpe] = {}


def load(path: str) -> ByteBpe:
    """The encoder of a rank file, built once per Python worker."""
    if path not in _loaded:
        _loaded[path] = ByteBpe.from_file(path)
    return _loaded[path]


def encode_texts(docs: DataFrame, ranks_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: the id column, ``ids`` (array<int>) and ``decoded`` (binary)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load(ranks_path)
        for batch in batches:
            for key, ids in _rows(model, batch):
                arrays = [key, pa.array([i.tolist() for i in ids], pa.list_(pa.int32())), pa.array([model.decode(i.tolist()) for i in ids], pa.binary())]
                yield pa.RecordBatch.from_arrays(arrays, names=["key", "ids", "decoded"])

    kind = docs.schema[id_col].dataType.simpleString()
    src = docs.select(docs[id_col].alias("key"), docs[text_col].alias("text"))
    return src.mapInArrow(run, f"key {kind}, ids array<int>, decoded binary").withColumnRenamed("key", id_col)


def digest_texts(docs: DataFrame, ranks_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """As ``encode_texts``, with the number of ids and the digests of ids and decoded bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load(ranks_path)
        text_of = model.id_text.__getitem__
        for batch in batches:
            for key, ids in _rows(model, batch):
                n, of_ids, of_bytes = [], [], []
                for row in ids:
                    row = row.tolist()
                    n.append(len(row))
                    of_ids.append(hashlib.sha256(" ".join(map(text_of, row)).encode()).hexdigest())
                    of_bytes.append(hashlib.sha256(model.decode(row)).hexdigest())
                yield pa.RecordBatch.from_arrays([key, pa.array(n, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_bytes, pa.string())], names=["key", "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = docs.schema[id_col].dataType.simpleString()
    src = docs.select(docs[id_col].alias("key"), docs[text_col].alias("text"))
    return src.mapInArrow(run, f"key {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string").withColumnRenamed("key", id_col)


def _rows(model: ByteBpe, batch: pa.RecordBatch) -> Iterator[tuple[pa.Array, list[np.ndarray]]]:
    data, offsets = tk.text_buffers(batch.column("text"))
    for i, j in tk.slices(offsets):
        ids, counts = model.encode(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
        yield batch.column("key").slice(i, j - i), np.split(ids, np.cumsum(counts)[:-1])
