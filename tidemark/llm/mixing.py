"""Operator 3: language-model scores by logistic context mixing over bits.

Bytes are coded by a binary tree of frequent and rare bytes; every decision in
the tree is one bit.  Predictors give a chance of that bit, from counts of the
bytes that followed the last byte and the last two, three, four and six bytes
in all training texts.  No context is hashed or left out: the contexts of one
byte are a table of 256 x 256, and the longer ones are counted under their own
bytes, so what is gathered grows with the texts.  Their logits are mixed
by one of several weight sets; a gate picks it anew for every bit, by the
longest predictor that has counts for this decision, which depends on past
bytes and the tables only.  A set begins with the mean of the predictors up to
its own.  After each stretch of ``STRETCH`` bits of a text (``LATER_STRETCH`` further on) the sets that its
bits used take a gradient step.  A slope and an offset per text refine the
mixed logit in the same way.  Every text begins with the same weights, so its
score depends on nothing but the text and the tables.

The base score needs the training count of every token of a text, the longer
contexts the counts of all bytes that followed them.  Texts are taken in blocks
of neighbouring rows.  A block sends each bucket of tokens (64-bit hashes) and
of contexts one row: its sorted keys with their training counts, packed.  The
bucket adds up all blocks' counts and answers every block with one row: the
counts of its tokens, the logits on the path of each context's next byte
through the tree, and the bucket's part of the figures of all training tokens.
Both sides know the order of the keys, so answers carry none.  Neither the
vocabulary nor the texts pass through the driver; texts travel packed, a row
for each block.  The number of buckets follows the blocks.

Edge cases: NULL and empty texts are the end token alone; without training
texts all counts are 0 and every bit has even chances; repeated rows are
counted and scored each; an empty table gives an empty table.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import partials
from tidemark.llm import textkit as tk
from tidemark.llm.shared import write_table

#: Bytes that the predictors look back: in the table of a fixed size, and in the keys that grow with the texts.
ORDERS, LONGER = (1,), (2, 3, 4, 6)
#: Blocks whose keys one bucket of contexts holds on average, the least number of buckets.
BUCKET_BLOCKS, LEAST_BUCKETS = 2, 16
#: Bits between two updates, at first and from the bit ``LATER`` of a text on.
LATER, LATER_STRETCH = 4096, 512
#: The former, weight sets (one for each longest predictor with counts, and one for none), steps.
STRETCH, GATES, RATE, REFINE_RATE = 64, len(ORDERS) + len(LONGER) + 1, 0.02, 0.01
#: Rows of one block; an end symbol that never occurs in UTF-8.
BLOCK_ROWS, END_BYTE = 2048, 0xFF
END_TOKEN = np.uint64(0x8E5D3C2B1A097F6E)
_SIZES = [1 << (8 * order + 8) for order in ORDERS]
_STARTS = np.concatenate([[0], np.cumsum(_SIZES)])
_KEYS = pa.Codec("zstd", 3)
#: The longest order; the bits of a byte with so many before it.
DEPTH, TOP = LONGER[-1], (1 << 56) - 1
#: Bytes of text whose bits are looked up at once, so that they stay in a processor's cache.
LOOKED_UP = 1 << 15


def with_ends(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts with the end symbol after each."""
    out = np.insert(data, offsets[1:], END_BYTE)
    return out, offsets + np.arange(len(offsets))


def contexts(data: np.ndarray, offsets: np.ndarray, orders: tuple[int, ...] = ORDERS) -> list[np.ndarray]:
    """The bytes before every byte as one number, for each order; what precedes a text counts as zeros."""
    starts, many = offsets[:-1], np.diff(offsets)
    word, out = np.zeros(len(data), dtype=np.int64), []
    for k in range(max(orders)):
        back = np.zeros(len(data), dtype=np.int64)
        back[k + 1 :] = data[: max(len(data) - k - 1, 0)]
        for j in range(k + 1):
            back[starts[many > j] + j] = 0
        word |= back << (8 * k)
        if k + 1 in orders:
            out.append(word.copy())
    return out


def recent(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Every byte and the ``DEPTH`` before it, the latest at the top, as one number of 56 bits: its upper bytes are the key of a shorter order."""
    n = len(data)
    padded = np.concatenate([np.zeros(DEPTH + 1, dtype=np.uint8), data])
    keys = np.ndarray(n, "<u8", padded, strides=(1,)).astype(np.int64) if n else np.zeros(0, np.int64)
    keys = keys >> 8 & TOP
    starts, many = offsets[:-1], np.diff(offsets)
    for k in range(DEPTH):
        keys[starts[many > k] + k] &= -1 << (8 * (DEPTH - k))
    return keys


def plain_keys(keys: np.ndarray) -> np.ndarray:
    """(order, context, next byte) from keys with the next byte at the top, and back to the context in the order of the text."""
    return (keys & ~TOP) | (keys << 8).byteswap()


def context_keys(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """(order, context, next byte) of every byte as one number without a hash, a row for each longer order."""
    keys = recent(data, offsets)
    return np.stack([plain_keys(of_order(keys, order)) for order in LONGER])


def of_order(keys: np.ndarray, order: int) -> np.ndarray:
    shift = 8 * (DEPTH - order)
    return keys >> shift << shift | np.int64(order << 56)


def runs(keys: np.ndarray) -> np.ndarray:
    """Where runs of equal keys begin."""
    return np.flatnonzero(np.concatenate([np.ones(min(len(keys), 1), bool), keys[1:] != keys[:-1]]))


def added_up(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct keys, the place of each key among them, and the sums of the counts."""
    order = np.argsort(keys)
    ordered = keys[order]
    first = runs(ordered)
    place = np.empty(len(keys), dtype=np.int64)
    place[order] = np.repeat(np.arange(len(first)), np.diff(first, append=len(keys)))
    return ordered[first], place, np.add.reduceat(counts[order].astype(np.int64), first) if len(first) else np.zeros(0, np.int64)


def distinct_contexts(keys: np.ndarray, counts: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Distinct keys of each longer order, sorted, with the sums of the counts; ``keys``: sorted results of ``recent``."""
    first = runs(keys)
    keys, counts = keys[first], np.add.reduceat(counts, first, dtype=np.int64) if len(first) else counts.astype(np.int64)
    out = []
    for order in LONGER[::-1]:
        keys = of_order(keys & TOP, order)
        first = runs(keys)
        keys, counts = keys[first], np.add.reduceat(counts, first) if len(first) else counts
        out.append((keys, counts))
    return out[::-1]


def by_bucket(hashes: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The order of hashes by bucket, and where each bucket begins in it."""
    bucket = (hashes % np.uint64(buckets)).astype(np.uint16 if buckets <= 1 << 16 else np.int64)
    return np.argsort(bucket, kind="stable"), np.concatenate([[0], np.cumsum(np.bincount(bucket, minlength=buckets))])


def context_hashes(keys: np.ndarray) -> np.ndarray:
    """A hash of the order and context of plain keys: all next bytes of a context share it."""
    return tk.splitmix((keys >> 8).astype(np.uint64))


def packed(keys: np.ndarray, counts: np.ndarray) -> bytes:
    """Sorted keys and their counts, as compressed byte planes."""
    both = np.stack([keys, counts.astype(np.int64)])
    planes = np.ascontiguousarray(both.view(np.uint8).reshape(-1, 8).T)
    return len(keys).to_bytes(8, "little") + _KEYS.compress(planes.tobytes(), asbytes=True)


def unpacked(part: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = int.from_bytes(part[:8], "little")
    planes = np.frombuffer(_KEYS.decompress(part[8:], n * 16, asbytes=True), dtype=np.uint8)
    both = np.ascontiguousarray(planes.reshape(8, -1).T).view(np.int64).reshape(2, n)
    return both[0], both[1]


def tokens_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of all rows with an end token after each row's, and tokens per row."""
    low = tk.lower_ascii(data)
    starts, ends, counts = tk.byte_words(low, offsets)
    hashes = tk.span_hash(low, starts, ends)
    return np.insert(hashes, np.cumsum(counts), END_TOKEN), counts + 1


def squeezed(part: np.ndarray) -> bytes:
    return part.nbytes.to_bytes(8, "little") + _KEYS.compress(part.tobytes(), asbytes=True)


def expanded(part: bytes, kind: type = np.int8) -> np.ndarray:
    return np.frombuffer(_KEYS.decompress(part[8:], int.from_bytes(part[:8], "little"), asbytes=True), dtype=kind)


def planes(numbers: np.ndarray) -> np.ndarray:
    """The bytes of 64-bit numbers, lowest bytes first, which compress where most numbers are small."""
    return numbers.astype("<i8").view(np.uint8).reshape(-1, 8).T.ravel()


def unplaned(part: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(part.reshape(8, -1).T).view("<i8").ravel()


def runs_of(blocks: np.ndarray) -> list[tuple[int, int]]:
    """Ranges of rows [i, j) of one block each."""
    first = runs(blocks).tolist()
    return list(zip(first, [*first[1:], len(blocks)], strict=True))


def block_keys(data: np.ndarray, offsets: np.ndarray, train: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray], list[np.ndarray]]:
    """Sorted distinct tokens of a block and their training counts, and the same for the contexts of each longer order."""
    tokens, counts, keys = [], [], []
    for i, j in tk.slices(offsets):
        part, off = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        found, n = tokens_of(part, off)
        learn = np.repeat(train[i:j], n)
        # learned and other tokens apart: sorting values is far faster than an order of them
        for own, one in ((np.sort(found[learn]), 1), (np.sort(found[~learn]), 0)):
            first = runs(own)
            tokens.append(own[first].view(np.int64))
            counts.append(np.diff(first, append=len(own)) * one)
        text, ends = with_ends(part, off)
        keys.append(recent(text, ends) << 1 | np.repeat(train[i:j], np.diff(ends)))
    found, c = np.concatenate(tokens), np.concatenate(counts)
    tokens, _, learned = added_up(found, c)
    ordered = np.concatenate(keys)
    del keys
    ordered.sort()
    learn = (ordered & 1).astype(np.int8)
    ordered >>= 1
    each = distinct_contexts(ordered, learn)
    return tokens, learned, [k for k, _ in each], [c for _, c in each]


def asked_of(block: int, tokens: np.ndarray, learned: np.ndarray, keys: list[np.ndarray], counts: list[np.ndarray], buckets: int) -> pa.RecordBatch:
    """A row for every bucket, though it has nothing of the block: its tokens and contexts, packed."""
    order, cut = by_bucket(tokens.view(np.uint64), buckets)
    words = [packed(tokens[order[x:y]], learned[order[x:y]]) for x, y in zip(cut[:-1], cut[1:], strict=True)]
    found, c = plain_keys(np.concatenate(keys)), np.concatenate(counts)
    order = np.argsort(found)
    found, c = found[order], c[order]
    order, cut = by_bucket(context_hashes(found), buckets)
    parts = [packed(found[order[x:y]], c[order[x:y]]) for x, y in zip(cut[:-1], cut[1:], strict=True)]
    arrays = [pa.array(np.full(buckets, block)), pa.array(np.arange(buckets, dtype=np.int32)), pa.array(words, pa.binary()), pa.array(parts, pa.binary())]
    return pa.RecordBatch.from_arrays(arrays, names=["block", "chunk", "words", "part"])


def together(parts: pa.ChunkedArray) -> tuple[tuple[np.ndarray, np.ndarray], np.ndarray]:
    """Keys and counts of all parts one after the other, and where each part begins."""
    keys, counts = zip(*(unpacked(p.as_py()) for p in parts), strict=True)
    return (np.concatenate(keys), np.concatenate(counts)), np.cumsum([0, *map(len, keys)])


def own_part(keys: np.ndarray, cut: np.ndarray, parts: np.ndarray) -> np.ndarray:
    """Places of the keys of one block, which has more than one part if it lies in several batches."""
    own = tk.ragged(cut[parts], cut[parts + 1] - cut[parts])
    return own if len(parts) == 1 else own[np.unique(keys[own], return_index=True)[1]]


def ranked(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct results of ``recent``, and the place of every byte's among them."""
    keys = recent(data, offsets)
    at = np.argsort(keys)
    keys = keys[at]
    first = runs(keys)
    place = np.empty(len(keys), dtype=np.int32)
    place[at] = np.repeat(np.arange(len(first), dtype=np.int32), np.diff(first, append=len(keys)))
    return keys[first], place


def each_order(kinds: np.ndarray, values: list[np.ndarray]) -> np.ndarray:
    """Values of the distinct keys of each longer order, a column each, for every one of ``kinds``: sorted distinct results of ``recent``."""
    out = np.empty((len(kinds), len(LONGER)), dtype=values[0].dtype)
    for k, (order, value) in enumerate(zip(LONGER, values, strict=True)):
        out[:, k] = np.repeat(value, np.diff(runs(of_order(kinds, order)), append=len(kinds)))
    return out


def eights(pool: np.ndarray) -> np.ndarray:
    """The eight bytes from every place of a pool on, as one number; zeros follow its end."""
    return np.ndarray(len(pool) + 1, "<u8", np.concatenate([pool, np.zeros(8, np.int8)]), strides=(1,))


def _logits(zero: np.ndarray, one: np.ndarray) -> np.ndarray:
    return np.clip(np.round(np.log((one + 0.05) / (zero + 0.05)) * 16), -127, 127).astype(np.int8)


class Model:
    """Tree of byte codes and quantised logits, from the counts of all training texts."""

    def __init__(self, counts: np.ndarray):
        tables = [counts[a:b].reshape(-1, 256).astype(np.float64) for a, b in zip(_STARTS[:-1], _STARTS[1:], strict=True)]
        heap = [(c + 0.01, i, (i,)) for i, c in enumerate(tables[0].sum(axis=0))]
        heapq.heapify(heap)
        codes: list[list[tuple[int, int]]] = [[] for _ in range(256)]
        left, right = np.zeros((256, 255)), np.zeros((256, 255))
        parts: dict[int, tuple[int, int, int]] = {}
        node = 255
        while len(heap) > 1:
            a, b = heapq.heappop(heap), heapq.heappop(heap)
            node -= 1
            for bit, (_, _, symbols) in enumerate((a, b)):
                for s in symbols:
                    codes[s].insert(0, (node, bit))
                    (right if bit else left)[s, node] = 1
            parts[node] = a[2][0], b[2][0], len(b[2])
            heapq.heappush(heap, (a[0] + b[0], min(a[1], b[1]) + 256, a[2] + b[2]))
        # in the order of the leaves the bytes of every node are neighbours
        self.leaf = np.empty(256, dtype=np.int64)
        self.leaf[list(heap[0][2])] = np.arange(256)
        self.middle = np.array([self.leaf[parts[k][1]] for k in range(255)], dtype=np.int64)
        self.length = np.array([len(c) for c in codes], dtype=np.int64)
        self.first = np.concatenate([[0], np.cumsum(self.length)])[:-1]
        self.node = np.array([n for c in codes for n, _ in c], dtype=np.int32)
        self.bit = np.array([b for c in codes for _, b in c], dtype=np.float32)
        self.side = (2 * self.bit - 1).astype(np.int8)
        # logits in favour of the path of each (last byte, byte), for each order of a fixed size
        self.near = [(_logits(table @ left, table @ right)[:, self.node] * self.side).ravel() for table in tables]
        # the first eight of each path at once
        self.sides = eights(self.side)[self.first]
        self.nears = [eights(near)[(np.arange(len(near) // len(self.side))[:, None] * len(self.side) + self.first).ravel()] for near in self.near]

    def paths(self, keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Logits on the path of every distinct key's byte, one after the other, where each begins, and the keys' places.

        ``keys`` may repeat; the counts of equal keys are added, and the keys must hold all next bytes of their contexts.
        """
        pool, start, place, symbol = self.favours(keys, counts)
        return pool * self.side[tk.ragged(self.first[symbol], self.length[symbol])], start, place

    def favours(self, keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """``paths`` with logits in favour of each bit of the byte, and the byte of every distinct key."""
        byte = keys & 255
        leaves, place, total = added_up(keys - byte + self.leaf[byte], counts)
        if counts.sum(dtype=np.float64) >= 2.0**62:
            raise OverflowError("a count does not fit in 64 bits")
        upto = np.concatenate([[0], np.cumsum(total)])
        symbol = np.argsort(self.leaf)[leaves & 255]
        length = self.length[symbol]
        start = np.concatenate([[0], np.cumsum(length)])
        base = leaves >> 8 << 8
        edge = np.append(runs(base), len(base))
        many = np.diff(edge)
        low, high = np.repeat(edge[:-1], many), np.repeat(edge[1:], many)
        # once a byte is left alone, every further bit favours it by its whole count
        pool = np.repeat(_logits(np.zeros(len(total)), total), length)
        live = np.flatnonzero(high - low > 1)
        level = 0
        while len(live):
            code = self.first[symbol[live]] + level
            one = self.bit[code] > 0
            a, b = low[live], high[live]
            cut = np.searchsorted(leaves, base[live] + self.middle[self.node[code]])
            zeros, ones = upto[cut] - upto[a], upto[b] - upto[cut]
            pool[start[live] + level] = _logits(np.where(one, zeros, ones), np.where(one, ones, zeros))
            a, b = np.where(one, cut, a), np.where(one, b, cut)
            low[live], high[live] = a, b
            level += 1
            live = live[(b - a > 1) & (length[live] > level)]
        return pool, start, place, symbol

    def places(self, keys: list[np.ndarray], buckets: int) -> tuple[list[np.ndarray], int]:
        """Where the paths of the keys of each order begin in the answers of all buckets, and the length of these."""
        plain = plain_keys(np.concatenate(keys))
        order = np.argsort(plain)
        order = order[by_bucket(context_hashes(plain[order]), buckets)[0]]
        length = self.length[plain[order] & 255]
        begins = np.empty(len(plain), dtype=np.int64)
        begins[order] = np.cumsum(length) - length
        return np.split(begins, np.cumsum([len(k) for k in keys])[:-1]), int(length.sum())

    def score(self, data: np.ndarray, offsets: np.ndarray, longer: tuple[np.ndarray, ...] | None = None, favours: bool = False) -> np.ndarray:
        """log10 probability of every text (with end symbols).

        ``longer``: logits of paths (in favour of each bit, if so said), where paths begin in them, a row for each longer order; if bytes
        share columns there, every byte's column, and the first eight logits of all these paths.
        """
        rows = len(offsets) - 1
        if not rows:
            return np.zeros(0)
        many_bits = self.length[data]
        upto = np.concatenate([[0], np.cumsum(many_bits)])
        bits = upto[offsets]
        many = np.diff(bits)
        order = np.argsort(-many, kind="stable")
        many, starts = many[order], bits[:-1][order]
        edges = np.concatenate([np.arange(0, LATER, STRETCH), np.arange(LATER, max(LATER, int(many[0])) + LATER_STRETCH, LATER_STRETCH)])
        edges = edges[: int(np.searchsorted(edges, many[0])) + 1]
        inputs = len(self.near) + (len(longer[1]) if longer else 0)
        # rows: logits of the predictors, sign of the bit, gate; beyond the end, room for a last stretch
        laid = np.zeros((inputs + 2, int(upto[-1]) + max(STRETCH, LATER_STRETCH)), dtype=np.int8)
        last = contexts(data, offsets)
        pool, begins, *known = longer or (self.side, np.zeros((0, len(data)), np.int64))
        # the first eight bits of all orders' paths lie together
        place, eight = known or (np.arange(len(data)), np.ascontiguousarray(eights(pool)[begins].T))
        lines = [inputs, *range(inputs)]
        views = [np.ndarray(laid.shape[1] - 7, "<u8", laid[k], strides=(1,)) for k in lines]
        for a in range(0, len(data), LOOKED_UP):
            b = min(a + LOOKED_UP, len(data))
            byte, at, near = data[a:b], upto[a:b], [c[a:b] for c in last]
            found = eight.take(place[a:b], axis=0)
            paths = [self.sides.take(byte), *(table.take((c << 8) + byte) for table, c in zip(self.nears, near, strict=True)), *found.T]
            # in the order of the text: what is written beyond a byte's last bit, the next byte overwrites
            for view, path in zip(views, paths, strict=True):
                view[at] = path
            more = np.flatnonzero(many_bits[a:b] > 8)
            length, first = many_bits[a:b][more] - 8, self.first[byte[more]]
            where = tk.ragged(at[more] + 8, length)
            rest = [(self.side, first), *((table, c[more] * len(self.side) + first) for table, c in zip(self.near, near, strict=True))]
            rest += [(pool, x) for x in begins[:, place[a:b][more]]]
            for line, (table, begin) in zip(lines, rest, strict=True):
                laid[line, where] = table[tk.ragged(begin + 8, length)]
            own = laid[:, upto[a] : upto[b]]
            if not favours:
                own[len(self.near) : inputs] *= own[-2]
            # the longest context with counts for this decision: known before the bit is
            for k in range(inputs):
                np.maximum(own[-1], (own[k] != 0).view(np.int8) * np.int8(min(k + 1, GATES - 1)), out=own[-1])
        mean = (1 / np.maximum(np.arange(GATES), 1)).astype(np.float32)
        weights = np.tile(np.repeat(mean, inputs).reshape(GATES, inputs), (rows, 1, 1))
        refine = np.tile(np.array([1, 0], dtype=np.float32), (rows, 1))
        cells = {long: np.arange(rows)[:, None] * (GATES * long) + np.arange(long) for long in {STRETCH, LATER_STRETCH}}
        out = np.zeros(rows)
        for edge, long in zip(edges[:-1].tolist(), np.diff(edges).tolist(), strict=True):
            n = int(np.searchsorted(-many, -edge, "left"))
            at = starts[:n] + edge
            now = np.stack([np.ndarray(len(line) - long + 1, f"V{long}", line, strides=(1,))[at].view(np.int8).reshape(n, long) for line in laid])
            # texts that end in this stretch: nothing beyond their ends counts
            whole = int(np.searchsorted(-many, -(edge + long), "right"))
            beyond = np.arange(long) >= (many[whole:n] - edge)[:, None]
            now[:, whole:n][:, beyond] = 0
            x = now[:inputs].astype(np.float32).transpose(1, 0, 2)
            which = now[-1] * np.int64(long) + cells[long][:n]
            fit = refine[:n]
            # both sides are powers of two apart from the logits: 1 / 16
            mixed = (weights[:n] * np.float32(1 / 16) @ x).ravel().take(which)
            # odds against the bit that came
            sign = now[-2].astype(np.float32)
            against = -fit[:, :1] * mixed
            against -= fit[:, 1:] * sign
            np.exp(np.clip(against, -30, 30, out=against), out=against)
            against[whole:][beyond] = 0
            lost = np.add(against, 1, dtype=np.float64)
            for _ in range(4):  # sixteen factors of at most exp(30) fit
                half = lost.shape[1] // 2
                lost = lost[:, :half] * lost[:, half:]
            out[:n] -= np.log(lost).sum(axis=1)
            error = against / (against + np.float32(1))
            pace = np.float32(1 / np.sqrt(edge / STRETCH + 1.0))
            pushed = np.zeros((n, GATES, long), dtype=np.float32)
            pushed.ravel()[which] = error * (fit[:, :1] * (np.float32(RATE / 16) * pace))
            weights[:n] = np.clip(weights[:n] + pushed @ x.transpose(0, 2, 1), -1, 2)
            pull = np.stack([np.einsum("ij,ij->i", error, x) for x in (mixed, sign)], axis=1) * (np.float32(REFINE_RATE / 8) * pace)
            refine[:n] = np.clip(fit + np.clip(pull, -0.1, 0.1), [0.5, -0.5], [1.5, 0.5])
        scores = np.empty(rows)
        scores[order] = out / np.log(10)
        return scores


def score_texts(spark: SparkSession, docs: DataFrame, training: Any, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score); ``training``: a boolean column of ``docs``."""
    chosen = [docs[id_col].alias("key"), docs[text_col].alias("text"), F.coalesce(training, F.lit(False)).alias("train")]
    try:
        src = docs.select(*chosen, F.xxhash64("_metadata.file_path", F.floor(F.col("_metadata.row_index") / BLOCK_ROWS)).alias("block"))
        src.schema  # noqa: B018  resolved here, for frames that are no files
    except AnalysisException:
        kept = write_table(spark, docs.select(*chosen), "texts")
        src = kept.select("key", "text", "train", F.xxhash64("_metadata.file_path", F.floor(F.col("_metadata.row_index") / BLOCK_ROWS)).alias("block"))
    buckets = max(LEAST_BUCKETS, src.select("block").distinct().count() // BUCKET_BLOCKS)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(int(_STARTS[-1]), dtype=np.int64)
        for batch in batches:
            data, offsets = tk.text_buffers(batch.column("text"))
            for i, j in tk.slices(offsets):
                text, ends = with_ends(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                for start, size, c in zip(_STARTS.tolist(), _SIZES, contexts(text, ends), strict=False):
                    table[start : start + size] += np.bincount((c << 8) + text, minlength=size)
        for chunk, part in partials.parts_of(table):
            yield partials.chunk_row(chunk, np.frombuffer(part, np.int64))

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blocks = batch.column("block").to_numpy()
            train = np.asarray(batch.column("train").to_pylist(), dtype=bool)
            data, offsets = tk.text_buffers(batch.column("text"))
            for i, j in runs_of(blocks):
                part, off = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
                yield asked_of(blocks[i], *block_keys(part, off, train[i:j]), buckets)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blocks = batch.column("block").to_numpy()
            data, offsets = tk.text_buffers(batch.column("text"))
            for i, j in runs_of(blocks):
                # by length, so that texts scored together end together
                lengths = np.diff(offsets[i : j + 1])
                order = np.argsort(lengths, kind="stable")
                text = data[tk.ragged(offsets[i:j][order], lengths[order])]
                lists = [pa.ListArray.from_arrays(pa.array([0, j - i], pa.int32()), batch.column(x).slice(i, j - i).take(pa.array(order))) for x in ("key", "train")]
                body = [squeezed(lengths[order]), squeezed(text)]
                yield pa.RecordBatch.from_arrays([pa.array(blocks[i : i + 1]), *lists, *(pa.array([x], pa.binary()) for x in body)], names=["block", "key", "train", "lengths", "text"])

    # this table has a size fixed by ORDERS, 1 MB as logits of paths
    model = Model(partials.collect_table(src.where("train").select("text").mapInArrow(count, partials.SCHEMA), int(_STARTS[-1]), np.int64, partials.added))
    shared = spark.sparkContext.broadcast(model)

    def answer(sent: pa.Table) -> pa.Table:
        chunk, blocks = sent.column("chunk")[0].as_py(), sent.column("block").to_numpy()
        order = np.argsort(blocks, kind="stable")
        edges = runs_of(blocks[order])
        # the same for words and contexts: parts of equal keys are added up, then each block gets its own
        (tokens, c), cut = together(sent.column("words"))
        _, place, total = added_up(tokens, c)
        words = [squeezed(planes(total[place[own_part(tokens, cut, order[x:y])]])) for x, y in edges]
        (keys, c), cut = together(sent.column("part"))
        pool, start, place, symbol = shared.value.favours(keys, c)
        length = shared.value.length[symbol]
        out = []
        for x, y in edges:
            at = place[own_part(keys, cut, order[x:y])]
            out.append(squeezed(pool[tk.ragged(start[at], length[at])]))
        k = len(out)
        return pa.table({
            "block": pa.array(blocks[order][[x for x, _ in edges]]), "chunk": pa.array(np.full(k, chunk, np.int32)), "words": pa.array(words, pa.binary()),
            "part": pa.array(out, pa.binary()), "n": pa.array(np.full(k, total.sum())), "v": pa.array(np.full(k, (total > 0).sum())),
        })

    asked = src.mapInArrow(ask, "block bigint, chunk int, words binary, part binary")
    answers = asked.groupBy("chunk").applyInArrow(answer, "block bigint, chunk int, words binary, part binary, n bigint, v bigint")

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        data = np.concatenate([expanded(x.as_py(), np.uint8) for x in left.column("text")])
        offsets = np.concatenate([[0], np.cumsum(np.concatenate([expanded(x.as_py(), np.int64) for x in left.column("lengths")]))])
        right = right.sort_by("chunk")
        # every bucket answers every block, so these are the figures of all training tokens
        if right.column("chunk").to_pylist() != list(range(buckets)):
            raise ValueError("a block's parts are not all answered")
        n, v = (sum(right.column(x).to_pylist()) for x in ("n", "v"))
        words, contexts_of = [], []
        cuts = list(tk.slices(offsets))
        for i, j in cuts:
            part, off = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
            words.append(tokens_of(part, off))
            contexts_of.append(ranked(*with_ends(part, off)))
        tokens, at, _ = added_up(np.concatenate([x for x, _ in words]).view(np.int64), np.zeros(sum(len(x) for x, _ in words), np.int64))
        ends = np.cumsum([len(x) for x, _ in words])
        kinds, own, _ = added_up(np.concatenate([k for k, _ in contexts_of]), np.zeros(sum(len(k) for k, _ in contexts_of), np.int64))
        keys = [k for k, _ in distinct_contexts(kinds, np.zeros(len(kinds), np.int64))]
        order, _ = by_bucket(tokens.view(np.uint64), buckets)
        total = np.empty(len(tokens), dtype=np.int64)
        total[order] = np.concatenate([unplaned(expanded(x.as_py(), np.uint8)) for x in right.column("words")])
        begins, size = shared.value.places(keys, buckets)
        pool = np.concatenate([expanded(x.as_py()) for x in right.column("part")])
        if len(pool) != size:
            raise ValueError("a block's contexts are not all answered")
        eight = eights(pool)
        begins = [b.astype(np.int32 if size < 1 << 31 else np.int64) for b in begins]
        begins, eight = each_order(kinds, begins), each_order(kinds, [eight[b] for b in begins])
        per_row, hits, base, fine, done = [], [], [], [], 0
        for (i, j), (found, many), (kinds, place), end in zip(cuts, words, contexts_of, ends.tolist(), strict=True):
            part, off = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
            c = total[at[end - len(found) : end]]
            first = np.cumsum(many) - many
            per_row.append(many)
            hits.append(np.add.reduceat((c > 0).astype(np.int64), first))
            base.append(np.add.reduceat(np.log10(c + 1.0), first))
            rows = own[done : done + len(kinds)]
            done += len(kinds)
            fine.append(shared.value.score(*with_ends(part, off), (pool, begins.take(rows, axis=0).T, place, eight.take(rows, axis=0)), favours=True))
        cat = [np.concatenate(x) for x in (per_row, hits, base, fine)]
        return pa.table({
            "key": pc.list_flatten(left.column("key")), "train": pc.list_flatten(left.column("train")), "n": pa.array(cat[0], pa.int64()), "hits": pa.array(cat[1], pa.int64()), "train_tokens": pa.array(np.full(len(cat[0]), n)),
            "base": pa.array(cat[2] - cat[0] * float(np.log10(n + v + 1)), pa.float64()), "fine": pa.array(cat[3], pa.float64()),
        })

    kind = src.schema["key"].dataType.simpleString()
    texts = src.mapInArrow(pack, f"block bigint, key array<{kind}>, train array<boolean>, lengths binary, text binary")
    scored = texts.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(score, f"key {kind}, train boolean, n bigint, hits bigint, train_tokens bigint, base double, fine double")
    return scored.select(
        F.col("key").alias(id_col), (~F.col("train")).alias("held_out"), F.col("n").alias("n_tokens"), F.col("hits").alias("n_known"),
        "train_tokens", F.col("base").alias("base_score"), F.col("fine").alias("score"),
    )
