"""Words of whole texts as numpy arrays: boundaries, 64-bit hashes and hashes of word windows.

Texts are handled as their UTF-8 bytes. A slab is a run of whole texts of a few MB, laid out in one
byte array, so that temporary arrays stay small however long the input batch is; a text longer than
a slab makes a slab of its own.

A word's hash adds up the values of its bytes times powers of an odd number, modulo 2^64, so the
hashes of all words of a slab come from one cumulative sum. Hashes of windows combine the hashes of
their words in the same manner and are mixed at the end. A second, independent lane tells buckets
apart, so that what meets in a bucket is compared on more than 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLAB_BYTES = 1 << 20
_POWERS: dict[int, np.ndarray] = {}

#: Multipliers of the hashes: odd, so that they can be inverted modulo 2^64.
BYTE_FACTOR = np.uint64(0x9E3779B97F4A7C15)
WORD_FACTOR = np.uint64(0xD1342543DE82EF95)

_VALUES = np.random.Generator(np.random.PCG64(20240607)).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits after which all bits depend on all bits."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def powers(factor: np.uint64, n: int) -> np.ndarray:
    """factor^0 .. factor^(n-1) modulo 2^64. Powers for a slab are kept for the next one."""
    have = _POWERS.get(int(factor))
    if have is None or len(have) < n:
        have = np.full(max(n, SLAB_BYTES + 1), factor, np.uint64)
        have[0] = 1
        np.multiply.accumulate(have, out=have)
        if len(have) == SLAB_BYTES + 1:
            _POWERS[int(factor)] = have
    return have[:n]


def byte_class(member) -> np.ndarray:
    """A table of 256 booleans: is this byte part of a word?"""
    return np.array([bool(member(b)) for b in range(256)])


#: Words `[^\\x20\\x09-\\x0D]+`.
NOT_SPACE = byte_class(lambda b: b != 0x20 and not 0x09 <= b <= 0x0D)
#: Words `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`, of lower-cased text.
LETTERS_DIGITS = byte_class(lambda b: b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A)
#: A-Z to a-z; other bytes stay.
LOWER = np.array([b + 32 if 0x41 <= b <= 0x5A else b for b in range(256)], np.uint8)


@dataclass
class Slab:
    """Whole texts side by side; text d is ``data[begins[d]:begins[d + 1]]``. Word i is ``data[starts[i]:ends[i]]``; text d has the words
    ``first[d]`` to ``first[d + 1]``."""

    rows: slice
    data: np.ndarray
    begins: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray
    hashes: np.ndarray

    def __len__(self) -> int:
        return len(self.first) - 1

    def word(self, i: int) -> bytes:
        return self.data[self.starts[i] : self.ends[i]].tobytes()

    def text_of(self) -> np.ndarray:
        """For each word the number of its text within the slab."""
        return np.repeat(np.arange(len(self)), np.diff(self.first))

    def left(self) -> np.ndarray:
        """For each word, how many words its text still has from it on."""
        return np.repeat(self.first[1:], np.diff(self.first)) - np.arange(len(self.starts))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and where each text begins (one more entry at the end); null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
    data = column.buffers()[2]
    return (np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)), offsets


def slabs(column: pa.Array, member: np.ndarray, lower: bool = False, limit: int = SLAB_BYTES) -> Iterator[Slab]:
    """Cut a string column into slabs and find the words of each."""
    data, offsets = text_bytes(column)
    at, n = 0, len(offsets) - 1
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1)
        part = data[offsets[at] : offsets[to]]
        if lower:
            part = LOWER[part]
        yield _slab(slice(at, to), part, offsets[at : to + 1] - offsets[at], member)
        at = to


def _slab(rows: slice, data: np.ndarray, begins: np.ndarray, member: np.ndarray) -> Slab:
    inside = np.zeros(len(data) + 1, bool)
    inside[:-1] = member[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[begins] = True
    before = np.concatenate(([False], inside[:-1]))
    starts = np.flatnonzero(inside & (~before | edge))
    ends = np.flatnonzero(before & (~inside | edge))
    first = np.searchsorted(starts, begins)
    return Slab(rows, data, begins, starts, ends, first, word_hashes(data, starts, ends))


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The 64-bit hash of each word; it depends on the word alone, not on its place.

    The sum over a word carries the power of its place, which the inverse power takes off again."""
    sums = np.zeros(len(data) + 1, np.uint64)
    terms = _VALUES.take(data)
    terms *= powers(BYTE_FACTOR, len(data))
    np.cumsum(terms, out=sums[1:])
    inverse = np.uint64(pow(int(BYTE_FACTOR), -1, 1 << 64))
    back = powers(inverse, len(data) + 1)[starts]
    return mixed((sums[ends] - sums[starts]) * back + (ends - starts).astype(np.uint64))


def window_hashes(hashes: np.ndarray, size: int, seed: int = 0) -> np.ndarray:
    """The hash of the ``size`` words from each word on (zero beyond the end of the slab).

    Windows are put together from windows of half their size, so the cost grows with the logarithm."""
    n, factor = len(hashes), int(WORD_FACTOR) + 2 * seed
    out, length = np.zeros(n, np.uint64), 0
    block, step = hashes, 1
    while step <= size:
        if size & step:  # append a block to what is there already
            out[: n - length] += block[length:] * np.uint64(pow(factor, length, 1 << 64))
            length += step
        if step * 2 <= size:
            block = block.copy()
            block[: max(0, n - step)] += block[step:].copy() * np.uint64(pow(factor, step, 1 << 64))
        step *= 2
    return mixed(out + np.uint64(size))
