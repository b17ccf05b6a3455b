"""Operator 9: token counts by a compiled finite-state tokenizer.

The merges of a word-level BPE file are compiled to a deterministic transducer
over the bytes of pre-tokens.  Two facts make that possible: a sequence of
tokens is the BPE encoding of a text exactly if every two neighbours are the
encoding of their own concatenation, and each prefix has one encoding.  So
after a prefix it is enough to know, for each suffix of it that may still grow
into a token, the last token before that suffix and the token count there.
Prefixes that agree in this are one state.  A transition carries the change of
the token count; the byte that ends a pre-token leads back to the start.
States and transitions are made when a text first needs them.  Few of the 256
bytes lead on from a state, so transitions lie in one table of hashed (state,
byte, end or not) numbers, whose size follows the transitions made so far.

A slice of text becomes one stream of symbols that is cut into chunks.  All
chunks run side by side.  The map of a chunk from entering state to leaving
state and count is constant after the first end of a pre-token in it; only the
part before that depends on what enters.  Prefix scans over the chunks give
each such part the state that enters it, and they run side by side too.

Normalisation is that of the file's published settings: NFC, lower case by
code point, white space dropped; special strings in a text count one token
each.  Edge cases: NULL or empty text has 0 bytes and 0 tokens; repeated rows
give repeated results; an empty table gives an empty table.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm import textkit as tk

#: Symbols of one chunk, and states and pairs of tokens that a worker keeps before it compiles anew.
CHUNK, MAX_STATES, MAX_PAIRS = 256, 120_000, 200_000
SPREAD = np.uint64(0x9E3779B97F4A7C15)
START, UNKNOWN, END = 0, 1, b"\xff\xfe"  # END: marks the end of a pre-token; never part of UTF-8


def _byte_alphabet() -> dict[str, int]:
    """The published byte-level alphabet: printable bytes as themselves, the others from U+0100 on."""
    kept = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(kept)]
    return {chr(b): b for b in kept} | {chr(0x100 + i): b for i, b in enumerate(others)}


class Merges:
    """Vocabulary and merges of a tokenizer file, over bytes; END closes the last token of a word."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, alphabet = spec["model"], _byte_alphabet()
        suffix = model["end_of_word_suffix"]

        def raw(token: str) -> bytes:
            end = token.endswith(suffix)
            return bytes(alphabet[c] for c in (token[: -len(suffix)] if end else token)) + (END if end else b"")

        self.special = [t["content"] for t in spec["added_tokens"]]
        # by themselves: states name these objects, not copies of their bytes
        self.tokens = {t: t for t in map(raw, (t for t in model["vocab"] if t not in self.special))}
        pairs = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
        self.rank = {(raw(a), raw(b)): i for i, (a, b) in enumerate(pairs)}
        self.grows = {g: g for g in {t[:i] for t in self.tokens for i in range(1, len(t) - (2 if t.endswith(END) else 0) + t.endswith(END)) if not t[:i].endswith(END[:1])}}
        self._fits: dict[tuple[bytes, bytes], bool] = {}

    def pairs(self) -> int:
        return len(self._fits)

    def forget(self, limit: int) -> None:
        """Drop what is known of pairs of tokens, if these are more than ``limit``."""
        if len(self._fits) > limit:
            self._fits.clear()

    def encode(self, data: bytes) -> list[bytes]:
        """Merges applied lowest rank first, leftmost first."""
        if data.endswith(END):
            parts = [data[i : i + 1] for i in range(len(data) - 3)] + [data[-3:]]
        else:
            parts = [data[i : i + 1] for i in range(len(data))]
        rank = self.rank
        while len(parts) > 1:
            best = min(range(len(parts) - 1), key=lambda i: rank.get((parts[i], parts[i + 1]), 1 << 30))
            if (parts[best], parts[best + 1]) not in rank:
                break
            parts[best : best + 2] = [parts[best] + parts[best + 1]]
        return parts

    def fits(self, left: bytes | None, right: bytes) -> bool:
        """Whether the two tokens may stand side by side in an encoding."""
        if left is None:
            return self.encode_alone(right)
        key = (left, self.tokens[right])
        if key not in self._fits:
            self._fits[key] = self.encode(left + right) == [left, right]
        return self._fits[key]

    def encode_alone(self, token: bytes) -> bool:
        key = (b"", self.tokens[token])
        if key not in self._fits:
            self._fits[key] = self.encode(token) == [token]
        return self._fits[key]


class Transducer:
    """States and transitions compiled so far; ``counts`` runs texts through them."""

    def __init__(self, merges: Merges):
        self.merges = merges
        self._clear()

    def _clear(self) -> None:
        #: a state: (suffix, last token before it, count there less the count here) of each suffix that may grow
        start = ((b"", None, 0),)
        self.states = [start, ()]
        self.number = {start: START}
        self.merges.forget(MAX_PAIRS)
        self.filled = 0
        self._allocate(1 << 13)
        for key in range(UNKNOWN * 512, UNKNOWN * 512 + 512):  # of each byte, within a pre-token and as its last
            self._put(key, START if key & 1 else UNKNOWN, 0)

    def _allocate(self, size: int) -> None:
        """A table of ``size`` slots (a power of two) with the transitions made so far."""
        held = (self.keys, self.values) if self.filled else None
        self.keys, self.values = np.full(size, -1, dtype=np.int64), np.full(size, -1, dtype=np.int64)
        self.shift = np.uint64(64 - size.bit_length() + 1)
        if held is None:
            return
        keys, values = (x[held[0] >= 0] for x in held)
        slot = self._slot(keys)
        while len(keys):  # of those that want one free slot the first gets it, the others look at the next
            free = np.flatnonzero(self.keys[slot] < 0)
            taken, first = np.unique(slot[free], return_index=True)
            self.keys[taken], self.values[taken] = keys[free[first]], values[free[first]]
            left = np.ones(len(keys), dtype=bool)
            left[free[first]] = False
            keys, values, slot = keys[left], values[left], (slot[left] + 1) & (size - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * SPREAD) >> self.shift).astype(np.int64)

    def _put(self, key: int, following: int, change: int) -> None:
        """One more transition: the state that follows and the change of the count, in one number."""
        if 2 * (self.filled + 1) > len(self.keys):
            self._allocate(2 * len(self.keys))
        slot = (key * int(SPREAD) & (1 << 64) - 1) >> int(self.shift)
        while self.keys[slot] >= 0:
            slot = (slot + 1) & (len(self.keys) - 1)
        self.keys[slot], self.values[slot] = key, following << 16 | change + (1 << 15)
        self.filled += 1

    def _find(self, keys: np.ndarray) -> np.ndarray:
        """The transition of each key; -1 for those not made yet."""
        slot = self._slot(keys)
        held, out = self.keys[slot], self.values[slot]
        open_ = np.flatnonzero((held != keys) & (held >= 0))
        while len(open_):
            slot[open_] = (slot[open_] + 1) & (len(self.keys) - 1)
            at = slot[open_]
            held, out[open_] = self.keys[at], self.values[at]
            open_ = open_[(held != keys[open_]) & (held >= 0)]
        return out

    def _compile(self, key: int) -> None:
        """The transition of a state by a byte, as the last byte of a pre-token or not."""
        m, byte = self.merges, bytes([key >> 1 & 255])
        entries = self.states[key >> 9]
        if key & 1:
            for suffix, left, count in entries:
                token = suffix + byte + END
                if token in m.tokens and m.fits(left, token):
                    self._put(key, START, count + 1)
                    return
            raise AssertionError("a pre-token without an encoding")
        for suffix, left, count in entries:
            token = suffix + byte
            if token in m.tokens and m.fits(left, token):
                here, change = m.tokens[token], count + 1
                break
        else:
            raise AssertionError("a prefix without an encoding")
        kept = [(m.grows[s + byte], left, count - change) for s, left, count in entries if s + byte in m.grows]
        target = (*kept, (b"", here, 0))
        k = self.number.get(target)
        if k is None:
            k = self.number[target] = len(self.states)
            self.states.append(target)
        self._put(key, k, change)

    def _advance(self, state: np.ndarray, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Next state of every lane, and the change of its count; a symbol is a byte and whether it ends a pre-token."""
        keys = state << 9 | symbol
        found = self._find(keys)
        lacking = found < 0
        if lacking.any():
            for key in np.unique(keys[lacking]).tolist():
                self._compile(key)
            found[lacking] = self._find(keys[lacking])
        return found >> 16, (found & 0xFFFF) - (1 << 15)

    def run(self, data: np.ndarray, final: np.ndarray) -> np.ndarray:
        """Change of the token count at every symbol of a stream of whole pre-tokens."""
        n = len(data)
        emitted = np.zeros(n, dtype=np.int16)
        if not n:
            return emitted
        if len(self.states) > MAX_STATES or self.merges.pairs() > MAX_PAIRS:
            self._clear()
        symbol = data.astype(np.int16) << 1 | final
        chunks = -(-n // CHUNK)
        pad = chunks * CHUNK - n
        grid = np.concatenate([symbol, np.full(pad, symbol[0] | 1)]).reshape(chunks, CHUNK).T.copy()
        out = np.zeros((CHUNK, chunks), dtype=np.int16)
        # each chunk's own part: the state that enters is known only after the end of a pre-token
        state = np.full(chunks, UNKNOWN, dtype=np.int64)
        state[0] = START
        state[1:][(grid[-1, :-1] & 1).astype(bool)] = START
        open_chunk = state == UNKNOWN
        for t in range(CHUNK):
            state, out[t] = self._advance(state, grid[t])
        emitted[:] = out.T.ravel()[:n]
        # prefix scans: the last chunk before that left in a known state, and the next end of a pre-token
        known = np.where(state != UNKNOWN, np.arange(chunks), -1)
        source = np.maximum.accumulate(known)
        first = np.flatnonzero(open_chunk)
        first = first[np.concatenate([[True], source[first[1:] - 1] != source[first[:-1] - 1]])] if len(first) else first
        if len(first):
            begin = first * CHUNK
            stops = np.flatnonzero(final)
            length = stops[np.searchsorted(stops, begin)] - begin + 1
            lane = state[source[first - 1]]
            order = np.argsort(-length, kind="stable")
            begin, length, lane = begin[order], length[order], lane[order]
            for t in range(int(length[0])):
                live = int(np.searchsorted(-length, -t, "left"))
                lane, emitted[begin[:live] + t] = self._advance(lane[:live], symbol[begin[:live] + t])
        return emitted

    def counts(self, texts: list[str]) -> np.ndarray:
        """Tokens of each text, without special strings."""
        data, final, bounds = tk.word_pretokens(texts)
        total = np.concatenate([[0], np.cumsum(self.run(data, final), dtype=np.int64)])
        return total[bounds[1:]] - total[bounds[:-1]]


_loaded: dict[str, Transducer] = {}


def load(path: str) -> Transducer:
    """The transducer of a tokenizer file, one per Python worker."""
    if path not in _loaded:
        _loaded[path] = Transducer(Merges(path))
    return _loaded[path]


def count_texts(texts: list[str], path: str) -> np.ndarray:
    """Tokens of each text; special strings split a text and count one each."""
    model = load(path)
    if not texts:
        return np.zeros(0, dtype=np.int64)
    parts, owner = tk.split_at_marks(texts, model.merges.special)
    within = np.bincount(owner, weights=model.counts(parts), minlength=len(texts)).astype(np.int64)
    return within + np.bincount(owner, minlength=len(texts)) - 1


def count_tokens(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: the id column, ``n_bytes`` and ``n_tokens``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = tk.text_buffers(batch.column("text"))
            for i, j in tk.slices(offsets):
                raw = data[offsets[i] : offsets[j]].tobytes()
                texts = [raw[a:b].decode("utf-8", "replace") for a, b in zip(offsets[i:j] - offsets[i], offsets[i + 1 : j + 1] - offsets[i], strict=True)]
                n = count_texts(texts, tokenizer_path)
                yield pa.RecordBatch.from_arrays([batch.column("key").slice(i, j - i), pa.array(np.diff(offsets[i : j + 1])), pa.array(n)], names=["key", "n_bytes", "n_tokens"])

    kind = docs.schema[id_col].dataType.simpleString()
    src = docs.select(docs[id_col].alias("key"), docs[text_col].alias("text"))
    return src.mapInArrow(run, f"key {kind}, n_bytes bigint, n_tokens bigint").withColumnRenamed("key", id_col)
