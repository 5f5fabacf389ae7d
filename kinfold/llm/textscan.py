"""Array-at-a-time tokenizing of Arrow string columns.

A piece is a run of whole documents whose UTF-8 bytes lie one after another; all positions are
byte positions in the piece.  Words are maximal runs of bytes of a class.

Words are hashed eight bytes a round, with all bits mixed between rounds; long ones by a
cryptographic hash.  Hashes of sliding runs (of a few words, or of a gram of bytes) are polynomial
in the ring of 64-bit integers: every multiplier is odd and so has an inverse, which turns the
hash of any run into a difference of prefix sums.  Such sums are blind to some pairs of runs of
1024 symbols and more, so no run of that length is ever named by them.
"""

from __future__ import annotations

import ctypes
import hashlib
import inspect
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import wraps

import numpy as np
import pyarrow as pa

PIECE = 1 << 20
BYTE_BASE, WORD_BASE = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F

#: words [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after lower-casing A-Z
ALNUM = np.zeros(256, bool)
ALNUM[0x30:0x3A] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True
#: words [^\x20\x09-\x0D]+
SPACED = np.ones(256, bool)
SPACED[[0x20, 9, 10, 11, 12, 13]] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def release() -> None:
    """Give freed memory back: a worker lives on beside the executor's heap after its task."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def lean(f: Callable) -> Callable:
    """``f``, a function of a table or a generator over batches, with release() when it is done."""
    if inspect.isgeneratorfunction(f):

        @wraps(f)
        def run(batches):
            yield from f(batches)
            release()

    else:

        @wraps(f)
        def run(table):
            out = f(table)
            release()
            return out

    return run


class _Powers:
    """Powers of an odd base and of its inverse, grown on demand."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    def to(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            grown = max(n, 2 * len(self.up))
            for name, base in (("up", self.base), ("down", self.inverse)):
                p = np.full(grown, base, np.uint64)
                p[0] = 1
                setattr(self, name, np.multiply.accumulate(p))
        return self.up[:n], self.down[:n]


BYTES, WORDS = _Powers(BYTE_BASE), _Powers(WORD_BASE)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


#: Runs of more bytes are hashed one by one.
LONG_RUN = 512
_KEPT = np.array([(1 << (8 * k)) - 1 for k in range(9)], np.uint64)


def hash_runs(data: np.ndarray, start: np.ndarray, end: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit hashes of runs of bytes; other seeds give independent ones."""
    n = end - start
    eight = np.ndarray((len(data) + 1,), "<u8", np.concatenate([data, np.zeros(8, np.uint8)]), strides=(1,))
    h = mix(n.astype(np.uint64) * np.uint64(WORD_BASE) + np.uint64(seed * 2 + 1) * np.uint64(BYTE_BASE >> 8))
    long = n > LONG_RUN
    at, left, rows = start, np.where(long, 0, n), None
    while True:
        live = np.flatnonzero(left > 0)
        if not len(live):
            break
        at, left = at[live], left[live]
        rows = live if rows is None else rows[live]
        h[rows] = mix(h[rows] ^ (eight[at] & _KEPT[np.minimum(left, 8)]))
        at, left = at + 8, left - 8
    for k in np.flatnonzero(long).tolist():
        digest = hashlib.blake2b(data[start[k] : end[k]].tobytes(), digest_size=8, salt=seed.to_bytes(8, "little")).digest()
        h[k] = np.frombuffer(digest, np.uint64)[0]
    return h


def prefix_hash(values: np.ndarray, powers: _Powers) -> np.ndarray:
    """h with h[j] - h[i] = sum of values[k] * base**k over i <= k < j."""
    h = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers.to(len(values))[0], out=h[1:])
    return h


def run_hash(h: np.ndarray, start: np.ndarray, end: np.ndarray, powers: _Powers) -> np.ndarray:
    return (h[end] - h[start]) * powers.to(len(h))[1][start]


@dataclass
class Piece:
    first: int  # index in the column of the piece's first document
    data: np.ndarray  # bytes
    bounds: np.ndarray  # documents' starts, and the end

    @property
    def count(self) -> int:
        return len(self.bounds) - 1


def pieces(column: pa.Array, limit: int = PIECE) -> Iterator[Piece]:
    """Whole documents in runs of about ``limit`` bytes; a null counts as an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return
    if column.null_count:
        column = column.fill_null("")
    width = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, width)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    i = 0
    while i < len(column):
        j = max(i + 1, int(np.searchsorted(at, at[i] + limit, "right")) - 1)
        yield Piece(i, data[at[i] : at[j]], at[i : j + 1] - at[i])
        i = j


@dataclass
class Tokens:
    start: np.ndarray  # byte positions in the piece
    end: np.ndarray
    bounds: np.ndarray  # documents' first words, and the number of words
    lower: np.ndarray  # bytes with A-Z lower-cased

    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))

    def hashes(self, seed: int = 0) -> np.ndarray:
        return hash_runs(self.lower, self.start, self.end, seed)


def tokens(piece: Piece, word: np.ndarray) -> Tokens:
    low = LOWER[piece.data]
    if not len(low):
        none = np.zeros(0, np.int64)
        return Tokens(none, none, np.zeros(piece.count + 1, np.int64), low)
    inside = word[low]
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    filled = piece.bounds[:-1] < piece.bounds[1:]
    first, last = piece.bounds[:-1][filled], piece.bounds[1:][filled] - 1
    begins[first], ends[last] = inside[first], inside[last]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return Tokens(start, end, np.searchsorted(start, piece.bounds), low)


def gather(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    """The byte runs as an Arrow column of strings."""
    n = end - start
    offsets = np.concatenate([[0], np.cumsum(n)])
    at = np.arange(offsets[-1]) - np.repeat(offsets[:-1] - start, n)
    return pa.LargeStringArray.from_buffers(len(n), pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data[at]))


def window_hashes(t: Tokens, hashes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """First words and hashes of all runs of ``size`` words within one document."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    g = prefix_hash(hashes, WORDS)
    at = np.arange(n)
    doc = t.doc()
    at = at[doc[:n] == doc[size - 1 :]]
    return at, mix(run_hash(g, at, at + size, WORDS))
