"""Vectorised word handling for Arrow string columns, shared by the text operators.

A block of documents is one byte buffer.  Words are maximal runs of bytes other than space and \\x09-\\x0D; A-Z are lower-cased on
request.  Everything is numpy over the whole block, so that the cost per word stays at some tens of nanoseconds, and a block is
bounded by bytes, not by documents.
"""

from __future__ import annotations

import ctypes
import hashlib
import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

_U = np.uint64
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_MASK = np.array([0] + [(1 << (8 * k)) - 1 for k in range(1, 9)], _U)
#: Words above this many bytes are hashed by blake2b, one at a time.
_LONG = 512


def mix(x: np.ndarray) -> np.ndarray:
    """The finalizer of splitmix64."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def slices(column: pa.Array, most_bytes: int) -> Iterator[pa.Array]:
    """Consecutive parts of a string column, of at most so many bytes each unless a single text is longer; nulls become empty."""
    column = column.fill_null("") if column.null_count else column
    if not len(column):
        return
    ends = _offsets(column)[1:]
    at = 0
    while at < len(column):
        base = ends[at - 1] if at else _offsets(column)[0]
        to = max(at + 1, int(np.searchsorted(ends, base + most_bytes, side="right")))
        yield column.slice(at, to - at)
        at = to


def _offsets(column: pa.Array) -> np.ndarray:
    kind = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    return np.frombuffer(column.buffers()[1], kind)[column.offset : column.offset + len(column) + 1]


class Words:
    """The words of a block: data (bytes), starts and ends in data, doc (row of each word), first (index of each row's first word, and the total). blank: for each byte, whether it parts words."""

    def __init__(self, column: pa.Array, lower: bool = False, blank: np.ndarray = _SPACE):
        column = column.fill_null("") if column.null_count else column
        n = len(column)
        off = _offsets(column).astype(np.int64) if n else np.zeros(1, np.int64)
        buf = column.buffers()[2] if n else None
        raw = np.frombuffer(buf, np.uint8)[off[0] : off[-1]] if buf is not None and off[-1] > off[0] else np.zeros(0, np.uint8)
        off = off - off[0]
        self.rows = n
        data = _LOWER[raw] if lower else raw
        ink = ~blank[raw]
        begin, end = ink.copy(), ink.copy()
        begin[1:] &= ~ink[:-1]
        end[:-1] &= ~ink[1:]
        full = off[1:] > off[:-1]
        edge = off[:-1][full]
        begin[edge] = ink[edge]
        edge = off[1:][full] - 1
        end[edge] = ink[edge]
        self.starts = np.flatnonzero(begin)
        self.ends = np.flatnonzero(end) + 1
        self.first = np.searchsorted(self.starts, off)
        self.counts = np.diff(self.first)
        self.doc = np.repeat(np.arange(n), self.counts)
        self.data = np.concatenate([data, np.zeros(8, np.uint8)])

    def hashes(self, seed: int = 0) -> np.ndarray:
        """64 bits for each word."""
        size = self.ends - self.starts
        h = np.full(len(size), 0x9E3779B97F4A7C15 ^ seed, _U) + size.astype(_U) * _U(0xD6E8FEB86659FD93)
        if not len(size):
            return h
        loads = np.ndarray((len(self.data) - 7,), "<u8", self.data.tobytes() if not self.data.flags.c_contiguous else self.data, strides=(1,))
        at, left, who = self.starts, np.minimum(size, _LONG + 1), None
        while len(at):
            part = loads[at] & _MASK[np.minimum(left, 8)]
            if who is None:
                h = mix(h ^ part) * _U(0x9FB21C651E98DF25)
            else:
                h[who] = mix(h[who] ^ part) * _U(0x9FB21C651E98DF25)
            more = np.flatnonzero((left > 8) & (left <= _LONG))
            who = more if who is None else who[more]
            at, left = at[more] + 8, left[more] - 8
        for i in np.flatnonzero(size > _LONG):
            word = self.data[self.starts[i] : self.ends[i]].tobytes()
            h[i] = _U(int.from_bytes(hashlib.blake2b(word, digest_size=8, key=seed.to_bytes(8, "little")).digest(), "little"))
        return mix(h)

    def spaced(self, first: int, to: int) -> bytes:
        """Words first to to-1, joined by one space."""
        return b" ".join(self.data[a:b].tobytes() for a, b in zip(self.starts[first:to].tolist(), self.ends[first:to].tolist(), strict=True))


_ODD = [_U(int.from_bytes(hashlib.blake2b(b"step%d" % k, digest_size=8).digest(), "little") | 1) for k in range(64)]


def grams(h: np.ndarray, n: int) -> np.ndarray:
    """A hash of each n consecutive entries; entry i covers h[i:i+n], so there are n-1 fewer."""
    if len(h) < n:
        return np.zeros(0, _U)
    out = h[: len(h) - n + 1] * _ODD[0]
    for k in range(1, n):
        out = out + h[k : len(h) - n + 1 + k] * _ODD[k]
    return mix(out)


def inside(doc: np.ndarray, n: int) -> np.ndarray:
    """Whether entries i to i+n-1 belong to one row, for each i that has so many."""
    return doc[n - 1 :] == doc[: len(doc) - n + 1] if len(doc) >= n else np.zeros(0, bool)


def planes(x: np.ndarray, width: int) -> bytes:
    """Unsigned integers as byte planes, lowest byte first: sorted deltas leave zero planes, which any codec removes."""
    raw = np.ascontiguousarray(x.astype("<u8")).view(np.uint8).reshape(-1, 8)
    return np.ascontiguousarray(raw[:, :width].T).tobytes()


def unplanes(b: bytes, width: int) -> np.ndarray:
    """The reverse of planes()."""
    n = len(b) // width
    raw = np.zeros((n, 8), np.uint8)
    raw[:, :width] = np.frombuffer(b, np.uint8).reshape(width, n).T
    return raw.reshape(-1).view("<u8")


def pack(x: np.ndarray) -> bytes:
    """Numbers from 0 on as byte planes, as many as the largest needs, after one byte that tells how many."""
    width = max(1, (int(x.max()).bit_length() + 7) // 8) if len(x) else 1
    return bytes([width]) + planes(x, width)


def unpack(b: bytes) -> np.ndarray:
    """The reverse of pack()."""
    return unplanes(b[1:], b[0]).astype(np.int64)


Scan = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def released(scan: Scan) -> Scan:
    """scan, at whose end the memory that it has freed goes back to the system: workers outlive their tasks, and an allocator keeps what it has had."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from scan(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc
        if trim is not None:
            trim(0)

    return run


assert sys.byteorder == "little", "words are loaded as little-endian integers"
