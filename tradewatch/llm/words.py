"""Words of many texts at once, as numpy arrays over the bytes of an Arrow column.

A word is a run of bytes that a fold table does not map to 0. Its hash is the value of its bytes
as a polynomial modulo 2**64, taken from prefix sums, so that no Python code runs per word.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 19  # of text handled at once; a longer text is a chunk of its own

_BASE = np.uint64(0x9E3779B97F4A7C15)
_UNBASE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers = {}


def fold_table(separators: bytes, lower: bool) -> np.ndarray:
    """Byte to byte; the separators and NUL become 0, A-Z lower case if wanted."""
    table = np.arange(256, dtype=np.uint8)
    if lower:
        table[65:91] += 32
    table[np.frombuffer(separators, np.uint8)] = 0
    return table


SPACES = b" \t\n\x0b\x0c\r"
LINES = fold_table(b"\n", lower=False)
SPACED = fold_table(SPACES, lower=True)
_LETTERS = {*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)}
PLAIN = fold_table(bytes(b for b in range(256) if b not in _LETTERS), lower=True)


class Words(NamedTuple):
    """start, end: byte positions in the chunk; row: the text of each word; hash: uint64."""

    start: np.ndarray
    end: np.ndarray
    row: np.ndarray
    hash: np.ndarray


class Chunk(NamedTuple):
    """Texts first .. first + len(offset) - 2 of a column, as bytes; text i is data[offset[i]:offset[i + 1]]."""

    first: int
    data: np.ndarray
    offset: np.ndarray

    @property
    def rows(self) -> int:
        return len(self.offset) - 1


def mix(x: np.ndarray) -> np.ndarray:
    """Spread all bits of a uint64 array over all bits."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def powers(n: int, base: np.uint64 = _BASE) -> np.ndarray:
    """base**0 .. base**(n - 1) modulo 2**64."""
    known = _powers.get(base)
    if known is None or len(known) < n:
        size = max(n, CHUNK_BYTES + 1)
        known = np.full(size, base, np.uint64)
        known[0] = 1
        _powers[base] = known = np.cumprod(known, dtype=np.uint64)
    return known[:n]


def chunks(texts: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """All texts of a column in order, null as empty, in chunks of about `limit` bytes."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null(b"" if pa.types.is_binary(texts.type) else "")
    texts = texts.cast(pa.large_binary())
    n = len(texts)
    if not n:
        return
    _, offsets, data = texts.buffers()
    offset = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + n + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    low = 0
    while low < n:
        high = int(np.searchsorted(offset, offset[low] + limit, side="right")) - 1
        high = min(n, max(high, low + 1))
        yield Chunk(low, whole[offset[low] : offset[high]], offset[low : high + 1] - offset[low])
        low = high


def hash_words(chunk: Chunk, fold: np.ndarray) -> Words:
    """The words of each text of a chunk, in order."""
    data = fold[chunk.data]
    n = len(data)
    if not n:
        none = np.zeros(0, np.int64)
        return Words(none, none, none, none.astype(np.uint64))
    inside = np.zeros(n + 2, bool)
    np.not_equal(data, 0, out=inside[1:-1])
    edge = np.zeros(n + 1, bool)
    edge[chunk.offset] = True
    start = np.flatnonzero(inside[1:-1] & (~inside[:-2] | edge[:n]))
    end = np.flatnonzero(inside[1:-1] & (~inside[2:] | edge[1:])) + 1
    hashed = np.empty(len(start), np.uint64)
    low = 0
    while low < len(start):
        # Words of about a chunk at once, so that a very long text takes no more memory.
        high = max(low + 1, int(np.searchsorted(end, start[low] + 2 * CHUNK_BYTES, side="right")))
        first, last = int(start[low]), int(end[high - 1])
        total = np.zeros(last - first + 1, np.uint64)
        np.cumsum(data[first:last] * powers(last - first), dtype=np.uint64, out=total[1:])
        a, b = start[low:high] - first, end[low:high] - first
        hashed[low:high] = mix((total[b] - total[a]) * powers(last - first, _UNBASE)[a])
        low = high
    row = np.searchsorted(chunk.offset, start, side="right") - 1
    return Words(start, end, row, hashed)


def grams(words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Position of the first word and hash of every run of n words within one text."""
    count = len(words.hash) - n + 1
    if count <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    value = np.zeros(count, np.uint64)
    for k in range(n):
        value = value * np.uint64(0xC2B2AE3D27D4EB4F) + words.hash[k : k + count]
    first = np.flatnonzero(words.row[:count] == words.row[n - 1 :])
    return first, mix(value[first])


def per_row(chunk: Chunk, flags: np.ndarray) -> np.ndarray:
    """Sum of a value per byte over each text."""
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return total[chunk.offset[1:]] - total[chunk.offset[:-1]]
