"""Vectorised text kernels over Arrow string columns: words of the UTF-8 bytes with polynomial hashes.

A word is a run of bytes of a 256-entry class table; its hash is (P[end] - P[start]) / B**start modulo 2**64 with
P the prefix sums of byte * B**i, so any substring's hash costs two lookups. Chunks bound the memory: a chunk
holds whole texts and is larger than CHUNK_BYTES only if a single text is.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 19
CHUNK_ROWS = 4096
_BASE = 0x9E3779B97F4A7C15
_U64 = np.uint64


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = pow(_BASE, -1, 1 << 64)
    out = []
    for base in (_BASE, inverse):
        p = np.full(n, base, _U64)
        p[0] = 1
        out.append(np.cumprod(p))
    return out[0], out[1]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """B**i and B**-i for i < n at least."""
    return _powers(max(CHUNK_BYTES + 1, 1 << (n - 1).bit_length()))


def mix(h: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    h = (h ^ (h >> _U64(30))) * _U64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U64(27))) * _U64(0x94D049BB133111EB)
    return h ^ (h >> _U64(31))


def table(members) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(members)] = True
    return out


#: Everything but ASCII blanks.
NOT_SPACE = ~table(b" \t\n\v\f\r")
#: ASCII letters and every byte of a multi-byte character.
LETTERS = table([*range(65, 91), *range(97, 123), *range(128, 256)])
NOT_NEWLINE = ~table(b"\n")


def chunks(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets): whole texts, null as empty."""
    if column.null_count:
        column = column.fill_null("")
    large = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, off_buf, data_buf = column.buffers()
    n = len(column)
    if n == 0:
        return
    off = np.frombuffer(off_buf, np.int64 if large else np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    data = np.frombuffer(data_buf, np.uint8) if data_buf is not None else np.zeros(0, np.uint8)
    a = 0
    while a < n:
        b = int(np.searchsorted(off, off[a] + CHUNK_BYTES, "right")) - 1
        b = min(max(b, a + 1), a + CHUNK_ROWS, n)
        yield a, b, data[off[a] : off[b]], off[a : b + 1] - off[a]
        a = b


def lower_chunks(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """chunks() of the lower-cased texts; only one chunk is lower-cased at a time."""
    for a, b, _, _ in chunks(column):
        for c, d, data, offsets in chunks(pc.utf8_lower(column.slice(a, b - a))):
            yield a + c, a + d, data, offsets


class Words:
    """start, end: byte positions; first: index of each row's first word (n_rows + 1)."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, member: np.ndarray):
        inside = np.zeros(len(data) + 1, bool)
        inside[:-1] = member[data]
        before = np.zeros(len(data) + 1, bool)
        before[1:] = inside[:-1]
        cuts = offsets[1:-1]
        head = inside & ~before
        head[cuts] |= inside[cuts]
        tail = before & ~inside
        tail[cuts] |= before[cuts]
        self.start = np.flatnonzero(head)
        self.end = np.flatnonzero(tail)
        self.first = np.searchsorted(self.start, offsets)
        self.count = np.diff(self.first)
        self.row = np.repeat(np.arange(len(offsets) - 1), self.count)

    def hashes(self, data: np.ndarray) -> np.ndarray:
        power, inverse = powers(len(data) + 1)
        total = np.zeros(len(data) + 1, _U64)
        np.cumsum((data.astype(_U64) + _U64(1)) * power[: len(data)], out=total[1:])
        return mix((total[self.end] - total[self.start]) * inverse[self.start] + (self.end - self.start).astype(_U64))


def shingles(word_hash: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of every run of `size` words inside a row; a row with fewer words (but one at least) has one
    shingle of all its words."""
    n = len(word_hash)
    count = np.diff(first)
    rows = np.arange(len(count))
    h = np.zeros(max(n - size + 1, 0), _U64)
    for k in range(size):
        h = h * _U64(_BASE) + word_hash[k : k + len(h)]
    row_of = np.repeat(rows, count)
    whole = row_of[: len(h)] == row_of[size - 1 :] if len(h) else np.zeros(0, bool)
    out, row = mix(h[whole]), row_of[: len(h)][whole]
    short = rows[(count > 0) & (count < size)]
    if len(short):
        acc = np.zeros(len(short), _U64)
        for k in range(size - 1):
            has = count[short] > k
            acc[has] = acc[has] * _U64(_BASE) + word_hash[first[short[has]] + k]
        out = np.concatenate([out, mix(acc + count[short].astype(_U64))])
        row = np.concatenate([row, short])
    return out, row
