"""Texts of Arrow batches as byte arrays, and the words in them as numpy arrays.

Texts are handled in groups of a few megabytes, so that the arrays made from them stay small; one
longer text makes a group of its own.
"""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

GROUP_BYTES = 4 << 20
#: Separators of ASCII text: blank, and tab to carriage return.
SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
#: Words as anything between those separators.
NOT_SPACE = ~SPACES
#: Words as ASCII letters, digits and every byte of a longer character.
ALNUM = np.zeros(256, bool)
for _low, _high in ((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)):
    ALNUM[_low : _high + 1] = True
#: A to Z in lower case, other bytes as they are.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20

_PAD = 8
_K1, _K2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_MASKS = np.array([0] + [(1 << (8 * n)) - 1 for n in range(1, 9)], dtype=np.uint64)


def by_shard(rows: DataFrame, shards: int, *order: str) -> DataFrame:
    """Rows dealt by the number in ``shard``, one shard to a partition, and sorted by it, or by the
    columns given; numbers below 0 are dealt among the partitions."""
    place = F.pmod(F.col("shard"), F.lit(shards)).cast("int")
    return rows.repartitionById(shards, place).sortWithinPartitions(*(order or ("shard",)))


def free_memory() -> None:
    """Gives what a task has freed back to the system, since Spark keeps its worker for others."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # not in every C library
        ctypes.CDLL(None).malloc_trim(0)


def free_name(columns: list[str], name: str) -> str:
    """The name, with underscores after it until no column has it."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def text_groups(column: pa.Array, limit: int = GROUP_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets) of consecutive rows; a null is empty.

    The bytes end in a few zeros, which belong to no text.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    n = len(column)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + n + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(n, max(last, first + 1))
        low, high = int(offsets[first]), int(offsets[last])
        part = np.zeros(high - low + _PAD, np.uint8)
        part[: high - low] = data[low:high]
        yield first, last, part, offsets[first : last + 1] - low
        first = last


def words_of(data: np.ndarray, offsets: np.ndarray, in_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, start, end) of each word in order; words do not cross texts."""
    size = int(offsets[-1])
    flags = in_word[data[:size]]
    if not size or not flags.any():
        empty = np.zeros(0, np.int64)
        return empty, empty, empty
    filled = offsets[:-1][offsets[:-1] < offsets[1:]]
    before = np.empty(size, bool)
    before[0] = False
    before[1:] = flags[:-1]
    before[filled] = False
    starts = np.flatnonzero(flags & ~before)
    after = np.empty(size, bool)
    after[-1] = False
    after[:-1] = flags[1:]
    after[filled[1:] - 1] = False
    ends = np.flatnonzero(flags & ~after) + 1
    rows = np.searchsorted(offsets, starts, "right") - 1
    return rows, starts, ends


def chunk_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where chunks begin: at texts, and at single blanks between characters that are no white
    space. Next to a character that may be longer white space there is no cut."""
    size = int(offsets[-1])
    if not size:
        return np.zeros(0, np.int64)
    at = np.flatnonzero(data[:size] == 0x20)
    at = at[(at > 0) & (at < size - 1)]
    before, after = data[at - 1], data[at + 1]
    at = at[(before > 0x20) & (after > 0x20) & (before != 0x7F)]
    before, after = data[at - 1], data[at + 1]
    two = data[np.maximum(at - 2, 0)]
    three = data[np.maximum(at - 3, 0)]
    next_two = data[at + 2]
    wide = (before >= 0x80) & (
        ((two == 0xC2) & ((before == 0x85) | (before == 0xA0))) | ((three >= 0xE1) & (three <= 0xE3))
    )
    wide |= (after == 0xC2) & ((next_two == 0x85) | (next_two == 0xA0))
    wide |= (after >= 0xE1) & (after <= 0xE3)
    cuts = np.zeros(size, bool)
    cuts[at[~wide]] = True
    cuts[offsets[:-1][offsets[:-1] < offsets[1:]]] = True
    return np.flatnonzero(cuts)


def mixed(h: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit hashes."""
    h = (h ^ (h >> np.uint64(32))) * _K2
    h = (h ^ (h >> np.uint64(29))) * _K1
    return h ^ (h >> np.uint64(32))


def hash_slices(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of slices of padded bytes; equal bytes have equal hashes anywhere."""
    lengths = ends - starts
    out = mixed(lengths.astype(np.uint64) * _K1 + _K2)
    if not len(starts):
        return out
    eights = np.ndarray((len(data) - 7,), "<u8", buffer=data, strides=(1,))
    todo, at, left = np.arange(len(starts)), starts.astype(np.int64), lengths.astype(np.int64)
    while len(todo):
        piece = eights[at] & _MASKS[np.minimum(left, 8)]
        h = (out[todo] ^ piece) * _K1
        out[todo] = h ^ (h >> np.uint64(31))
        keep = left > 8
        todo, at, left = todo[keep], at[keep] + 8, left[keep] - 8
    return mixed(out)


def run_starts(rows: np.ndarray) -> np.ndarray:
    """Indices at which a sorted array changes its value, the first one included."""
    if not len(rows):
        return np.zeros(0, np.int64)
    return np.flatnonzero(np.concatenate(([True], rows[1:] != rows[:-1])))


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The indices start, start + 1, ... of each slice, one slice after the other."""
    total = int(lengths.sum())
    shift = np.repeat(starts - np.concatenate(([0], np.cumsum(lengths)[:-1])), lengths)
    return shift + np.arange(total)


class HashSlots:
    """Numbers by 64-bit hash, in an open-addressing table of fixed size."""

    def __init__(self, bits: int) -> None:
        self.mask = np.uint64((1 << bits) - 1)
        self.keys = np.zeros(1 << bits, np.uint64)
        self.numbers = np.full(1 << bits, -1, np.int32)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The number of each hash, -1 where it has none."""
        wanted = np.maximum(hashes, np.uint64(1))  # 0 marks a free place
        place = (wanted & self.mask).astype(np.int64)
        held = self.keys[place]
        out = np.where(held == wanted, self.numbers[place], -1)
        todo = np.flatnonzero((held != wanted) & (held != 0))
        while len(todo):
            place[todo] = (place[todo] + 1) & int(self.mask)
            held = self.keys[place[todo]]
            hit = held == wanted[todo]
            out[todo[hit]] = self.numbers[place[todo[hit]]]
            todo = todo[~hit & (held != 0)]
        return out

    def add(self, hashes: np.ndarray, numbers: np.ndarray) -> None:
        """Puts distinct hashes that are not there."""
        wanted = np.maximum(hashes, np.uint64(1))
        place = (wanted & self.mask).astype(np.int64)
        todo = np.arange(len(wanted))
        while len(todo):
            free = todo[self.keys[place[todo]] == 0]
            self.keys[place[free]] = wanted[free]
            done = self.keys[place[todo]] == wanted[todo]
            self.numbers[place[todo[done]]] = numbers[todo[done]]
            todo = todo[~done]
            place[todo] = (place[todo] + 1) & int(self.mask)
