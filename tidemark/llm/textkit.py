"""Vectorised text helpers: Arrow text columns as numpy bytes, word spans, 64-bit
span hashes, Unicode classes, lock-free loops over bounded slices.

Every operator that needs Python takes Arrow batches and cuts them into slices
of about ``SLICE_BYTES`` of text, so memory is bounded by the slice (or by one
row's text, where that is longer), never by the partition.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20

_U = np.uint64


def splitmix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser, element by element."""
    z = x + _U(0x9E3779B97F4A7C15)
    z = (z ^ (z >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> _U(27))) * _U(0x94D049BB133111EB)
    return z ^ (z >> _U(31))


_BYTE_CODE = splitmix(np.arange(256, dtype=np.uint64)) | _U(1)
_BASE = 0x5851F42D4C957F2D  # odd, so it has an inverse modulo 2**64
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[str, np.ndarray] = {}


def _power_table(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, kept between calls."""
    if "up" not in _powers or len(_powers["up"]) < n:
        size = max(n, 1 << 16)
        for name, base in (("up", _BASE), ("down", _BASE_INVERSE)):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            _powers[name] = np.cumprod(steps, dtype=np.uint64)
    return _powers["up"][:n], _powers["down"][:n]


def span_hash(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of the bytes of each span ``data[start:end]``.

    One prefix sum over the whole buffer gives the hash of every span, so no
    Python object is made per word.
    """
    up, down = _power_table(len(data) + 1)
    prefix = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_BYTE_CODE[data] * up[: len(data)], out=prefix[1:])
    h = (prefix[ends] - prefix[starts]) * down[starts]
    return splitmix(h ^ ((ends - starts).astype(np.uint64) << _U(48)))


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and n + 1 offsets of a string column; NULL counts as empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0] : off[-1]], off - off[0]


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges [i, j) of at most ``limit`` bytes, or of one longer row."""
    n, i = len(offsets) - 1, 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        yield i, j
        i = j


_WORD_GAP = np.zeros(256, dtype=bool)
_WORD_GAP[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


def byte_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans of words ``[^\\x20\\x09-\\x0D]+`` and the number of words of each row."""
    n = len(data)
    word = np.zeros(n + 2, dtype=bool)
    word[1:-1] = ~_WORD_GAP[data]
    first = word[1:-1] & ~word[:-2]
    last = word[1:-1] & ~word[2:]
    inner = offsets[1:-1]
    inner = inner[(inner > 0) & (inner < n)]
    first[inner] = word[1:-1][inner]  # a row's first byte begins a word
    last[inner - 1] = word[1:-1][inner - 1]
    starts = np.flatnonzero(first)
    ends = np.flatnonzero(last) + 1
    bounds = np.searchsorted(starts, offsets)
    return starts, ends, np.diff(bounds)


LETTER, NUMBER, SPACE, OTHER = 1, 2, 3, 0
#: Code points with the Unicode property White_Space.
WHITE_SPACE = (*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
_classes: list[np.ndarray] = []


def char_classes() -> np.ndarray:
    """Class of every code point (letter, number, white space, other), built once per process."""
    if not _classes:
        kind = {"L": LETTER, "N": NUMBER}
        table = np.fromiter((kind.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)), np.uint8, 0x110000)
        table[list(WHITE_SPACE)] = SPACE
        _classes.append(table)
    return _classes[0]


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def byte_ends(points: np.ndarray) -> np.ndarray:
    """n + 1 byte offsets of the code points in UTF-8."""
    width = 1 + (points >= 0x80).astype(np.int64) + (points >= 0x800) + (points >= 0x10000)
    out = np.zeros(len(points) + 1, dtype=np.int64)
    np.cumsum(width, out=out[1:])
    return out


_APOSTROPHE = ord("'")


def contraction_lengths(points: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Letters that belong to 's 't 'm 'd 're 've 'll after the apostrophes at ``at`` (0: none)."""
    padded = np.concatenate([points, np.zeros(2, points.dtype)])
    a, b = padded[at + 1], padded[at + 2]
    one = np.isin(a, [ord(c) for c in "stmd"])
    two = ((a == ord("r")) | (a == ord("v"))) & (b == ord("e")) | (a == ord("l")) & (b == ord("l"))
    return np.where(one, 1, np.where(two, 2, 0))


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices start, start + 1, ... of every range, one range after the other."""
    lengths = lengths.astype(np.int64)
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts.astype(np.int64) - (ends - lengths), lengths) + np.arange(total)


class SpanMemo:
    """Ids of distinct byte spans, by their 64-bit hash, in plain arrays.

    ``ids`` answers all spans of a slice at once; only distinct spans that are
    not known yet go to ``make`` (a list of byte strings to lists of ids).  The
    memo starts anew beyond ``limit`` entries, which changes no result.
    """

    def __init__(self, make: Callable[[list[bytes]], list[list[int]]], limit: int):
        self.make, self.limit = make, limit
        self._forget()

    def _forget(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.start = np.zeros(0, np.int64)
        self.length = np.zeros(0, np.int64)
        self.pool = np.zeros(0, np.int32)

    def locate(self, keys: np.ndarray, starts: np.ndarray, ends: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the ids of each span begin in the pool, and how many there are."""
        if len(self.keys) > self.limit:
            self._forget()
        distinct, example, which = np.unique(keys, return_index=True, return_inverse=True)
        at = np.searchsorted(self.keys, distinct)
        known = np.zeros(len(distinct), dtype=bool)
        inside = at < len(self.keys)
        known[inside] = self.keys[at[inside]] == distinct[inside]
        start, length = np.zeros(len(distinct), np.int64), np.zeros(len(distinct), np.int64)
        start[known], length[known] = self.start[at[known]], self.length[at[known]]
        new = np.flatnonzero(~known)
        if len(new):
            raw, where = data.tobytes(), example[new]
            made = self.make([raw[a:b] for a, b in zip(starts[where].tolist(), ends[where].tolist(), strict=True)])
            length[new] = np.fromiter(map(len, made), np.int64, len(made))
            start[new] = len(self.pool) + np.cumsum(length[new]) - length[new]
            self.pool = np.concatenate([self.pool, np.fromiter(chain.from_iterable(made), np.int32)])
            self.keys = np.insert(self.keys, at[new], distinct[new])
            self.start = np.insert(self.start, at[new], start[new])
            self.length = np.insert(self.length, at[new], length[new])
        return start[which], length[which]


def word_pretokens(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of normalised texts, where each pre-token of a word-level tokenizer ends, and bytes to keep.

    Normalised: NFC, lower case by code point.  Pre-tokens: contractions, runs
    of letters, single numbers, runs of others; white space is none.  Returns
    the UTF-8 bytes without white space, a flag on the last byte of every
    pre-token, and n + 1 offsets of the texts in those bytes.
    """
    clean = [(t if t.isascii() else unicodedata.normalize("NFC", t).replace("\u03a3", "\u03c3")).lower() for t in texts]
    joined = "\n".join(clean) + "\n"
    points = code_points(joined)
    n = len(points)
    kind = char_classes()[points]
    stop = np.ones(n, dtype=bool)  # the last character of each pre-token: where the class changes, and every number
    stop[:-1] = kind[:-1] != kind[1:]
    begin = np.ones(n, dtype=bool)
    begin[1:] = stop[:-1]
    at = np.flatnonzero((points == 0x27) & begin & stop)
    more = contraction_lengths(points, at)
    at, more = at[more > 0], more[more > 0]
    stop[kind == NUMBER] = True
    stop[at] = False
    stop[at + more] = True
    edges = byte_ends(points)
    data = np.frombuffer(joined.encode("utf-8", "surrogatepass"), dtype=np.uint8)
    final = np.zeros(len(data), dtype=bool)
    final[edges[1:][stop] - 1] = True
    keep = np.repeat(kind != SPACE, np.diff(edges))
    lengths = np.fromiter(map(len, clean), np.int64, len(clean)) + 1
    bounds = edges[np.concatenate([[0], np.cumsum(lengths)])]
    return data[keep], final[keep], np.concatenate([[0], np.cumsum(keep)])[bounds]


def split_at_marks(texts: list[str], marks: list[str]) -> tuple[list[str], np.ndarray]:
    """Texts without the marks, as parts in order, and the row of each part.  A row with k marks has k + 1 parts."""
    parts, owner = [], []
    for i, text in enumerate(texts):
        pieces = [text]
        if "<|" in text:
            for mark in marks:
                pieces = [p for piece in pieces for p in piece.split(mark)]
        parts += pieces
        owner += [i] * len(pieces)
    return parts, np.array(owner, dtype=np.int64)
