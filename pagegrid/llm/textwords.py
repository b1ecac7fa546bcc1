"""Words and word-window hashes of many texts at once, in numpy over the Arrow buffers.

All functions take a block: the UTF-8 bytes of some texts back to back. A block holds
about BLOCK_BYTES, or one text if that is longer, so memory follows the longest text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 18
_B = 0x9E3779B97F4A7C15  # odd, so that its powers have inverses modulo 2**64
_Q = 0xD1B54A32D192ED03
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _table(*ranges: tuple[int, int]) -> np.ndarray:
    out = np.ones(256, bool)
    for a, b in ranges:
        out[a : b + 1] = False
    return out


#: Words end at white space only, or at any ASCII character that is no letter or digit.
SPACED = _table((0x20, 0x20), (0x09, 0x0D))
ALNUM = _table((0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n or more."""
    if base not in _powers or len(_powers[base][0]) < n:
        size = 1 << max(16, (n - 1).bit_length())
        inverse = pow(base, -1, 1 << 64)
        found = []
        for x in (base, inverse):
            p = np.full(size, x, np.uint64)
            p[0] = 1
            found.append(np.multiply.accumulate(p))
        _powers[base] = (found[0], found[1])
    return _powers[base]


def mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(30))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def before(x: np.ndarray) -> np.ndarray:
    """Sums of all values before each index, one more than there are values."""
    out = np.zeros(len(x) + 1, np.uint64)
    np.cumsum(x, out=out[1:])
    return out


@dataclass
class Block:
    """first: row number of the first text; offsets: where each text starts, and the end."""

    first: int
    data: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def text(self, i: int) -> bytes:
        return self.data[self.offsets[i] : self.offsets[i + 1]].tobytes()


def blocks(column: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[Block]:
    """The texts of a string column, a null as an empty text."""
    column = column.cast(pa.large_string()).fill_null("")
    if not len(column):
        return
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    i = 0
    while i < len(column):
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        j = min(j, len(column))
        yield Block(i, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
        i = j


@dataclass
class Words:
    """starts, ends: bytes of each word; of: index of each text's first word, and the end."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    of: np.ndarray

    def hashes(self) -> np.ndarray:
        n = len(self.data)
        p, q = powers(_B, n + 1)
        sums = before((self.data.astype(np.uint64) + np.uint64(1)) * p[:n])
        h = (sums[self.ends] - sums[self.starts]) * q[self.starts]
        return mix(h + (self.ends - self.starts).astype(np.uint64))

    def windows(self, hashes: np.ndarray, size: int) -> np.ndarray:
        """A hash for each run of `size` words, at its first word; runs may cross texts."""
        n = len(hashes)
        if n < size:
            return np.zeros(0, np.uint64)
        p, q = powers(_Q, n + 1)
        sums = before(hashes * p[:n])
        return mix((sums[size:] - sums[: n - size + 1]) * q[: n - size + 1] + np.uint64(size))

    def packed(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The words with one space between neighbours: bytes, starts, ends. There must be a word."""
        ends = np.cumsum(self.ends - self.starts + 1) - 1
        starts = ends - (self.ends - self.starts)
        out = np.full(int(ends[-1]) + 1, 32, np.uint8)
        keep = np.ones(len(out), bool)
        keep[ends] = False
        inside = np.zeros(len(self.data) + 1, np.int8)
        inside[self.starts] += 1
        inside[self.ends] -= 1
        out[keep] = self.data[np.cumsum(inside[:-1], dtype=np.int8).astype(bool)]
        return out, starts, ends

    def room(self) -> np.ndarray:
        """For each word, how many words its text has from there on."""
        return np.repeat(self.of[1:], np.diff(self.of)) - np.arange(len(self.starts))

    def join(self, i: int, size: int) -> bytes:
        return b" ".join(self.data[a:b].tobytes() for a, b in zip(self.starts[i : i + size], self.ends[i : i + size]))


def words(block: Block, kind: np.ndarray = SPACED, lower: bool = True) -> Words:
    data = LOWER[block.data] if lower else block.data
    inside = kind[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[block.offsets] = True
    starts, ends = inside.copy(), inside.copy()
    starts[1:] &= ~inside[:-1] | edge[1:-1]
    ends[:-1] &= ~inside[1:] | edge[1:-1]
    starts = np.flatnonzero(starts)
    return Words(data, starts, np.flatnonzero(ends) + 1, np.searchsorted(starts, block.offsets))
