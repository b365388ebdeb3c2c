"""Vectorised word segmentation and hashing over Arrow string columns.

Words are maximal runs of bytes outside 0x20 and 0x09-0x0D. All separators are ASCII, so working on UTF-8 bytes gives
the same words as working on characters. Texts are taken in chunks of about a megabyte: memory follows the chunk (or
the longest single text), not the batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import blake2b

import numpy as np
import pyarrow as pa

CHUNK = 1 << 20
U64 = np.uint64
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
#: Up to this many bytes a word is hashed in blocks side by side with others; a longer one by a digest of its own.
BLOCKED = 256
_MASK = np.array([(1 << (8 * k)) - 1 for k in range(9)], dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective finaliser on 64 bits."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def constants(n: int, seed: int) -> np.ndarray:
    """n odd 64-bit constants, the same everywhere for a seed."""
    return mix(np.arange(1, n + 1, dtype=U64) * U64(0xD1342543DE82EF95) + U64(seed)) | U64(1)


@dataclass
class Chunk:
    """Some rows of a batch: bytes, the rows' limits in them, word limits and the rows' first words."""

    rows: slice
    data: np.ndarray
    limits: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    def hashes(self, seed: int = 1, lower: bool = False) -> np.ndarray:
        """One 64-bit hash for each word: its length, then each block of 8 bytes, mixed in one after the other.

        Words of up to 8 bytes and one length never collide; a word of more than BLOCKED bytes gets a BLAKE2 digest.
        """
        length = self.end - self.start
        h = mix(length.astype(U64) * U64(0xA24BAED4963EE407) + mix(np.array([seed], U64)))
        if not len(h):
            return h
        data = np.append(_LOWER[self.data] if lower else self.data, np.zeros(8, np.uint8))
        block_at = np.ndarray(len(data) - 7, "<u8", data.data, strides=(1,))
        every = np.flatnonzero(length <= BLOCKED)
        at, left = self.start[every], length[every]
        while len(every):
            block = block_at[at] & _MASK[np.minimum(left, 8)]
            h[every] = mix(h[every] ^ block) + U64(0x9FB21C651E98DF25)
            more = left > 8
            every, at, left = every[more], at[more] + 8, left[more] - 8
        for k in np.flatnonzero(length > BLOCKED).tolist():
            digest = blake2b(data[self.start[k] : self.end[k]].data, digest_size=8, key=seed.to_bytes(8, "little"))
            h[k] = int.from_bytes(digest.digest(), "little")
        return mix(h)


_LETTER = np.zeros(256, bool)
_LETTER[[*range(ord("0"), ord("9") + 1), *range(ord("a"), ord("z") + 1), *range(ord("A"), ord("Z") + 1), *range(128, 256)]] = True


def bare(c: Chunk) -> Chunk:
    """The chunk with each word's limits drawn in to its letters and digits; a word without any stays as it is."""
    if not len(c.start):
        return c
    letters = np.concatenate([[0], np.cumsum(_LETTER[c.data])])
    some = letters[c.end] > letters[c.start]
    places = np.append(np.flatnonzero(_LETTER[c.data]), len(c.data))
    start = np.where(some, places[np.minimum(letters[c.start], len(places) - 1)], c.start)
    end = np.where(some, places[np.maximum(letters[c.end] - 1, 0)] + 1, c.end)
    return Chunk(c.rows, c.data, c.limits, start, end, c.first)


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and limits of a string column; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    limits = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    return (np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)), limits


def chunks(column: pa.Array, size: int = CHUNK) -> Iterator[Chunk]:
    data, limits = text_buffer(column)
    lo, n = 0, len(limits) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(limits, limits[lo] + size, side="right")) - 1)
        at = limits[lo : hi + 1] - limits[lo]
        b = data[limits[lo] : limits[hi]]
        space = _SPACE[b]
        begins, ends = ~space, ~space
        full = at[1:] > at[:-1]
        before = np.empty(len(b), bool)
        after = np.empty(len(b), bool)
        if len(b):
            before[0], before[1:] = True, space[:-1]
            after[-1], after[:-1] = True, space[1:]
            before[at[:-1][full]] = True
            after[at[1:][full] - 1] = True
        start = np.flatnonzero(begins & before)
        yield Chunk(slice(lo, hi), b, at, start, np.flatnonzero(ends & after) + 1, np.searchsorted(start, at))
        lo = hi


def windows(h: np.ndarray, first: np.ndarray, width: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of width words, by their start; and which starts stay inside their row."""
    k = constants(width, seed)
    n = len(h) - width + 1
    if n <= 0:
        return np.zeros(0, U64), np.zeros(0, bool)
    out = np.zeros(n, U64)
    for j in range(width):
        out += h[j : j + n] * k[j]
    inside = np.ones(len(h) + width, bool)
    for back in range(1, width):
        p = first[1:] - back
        inside[p[p >= first[:-1]]] = False
    return mix(out), inside[:n]
