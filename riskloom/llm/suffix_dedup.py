"""Removes every byte string of ``LENGTH`` bytes that also starts anywhere else, by suffix arrays.

A shard is a block of texts of some megabytes. Its suffix array is refined by Larsson-Sadakane
doubling in numpy, Kasai's common prefixes give the classes of equal strings in the shard, and the
sorted strings of all shards, as hashes dealt by range, are merged by binary search.

Most strings can be told to be unique before: each window of ``LENGTH`` bytes has a minimizer, its
leftmost ``GRAM``-byte substring with the least hash, and equal windows have equal ones at the same
distance. Consecutive windows with one minimizer are a run. A run whose minimizer is found nowhere
else holds no repeated string; one whose whole bytes are found elsewhere, and whose minimizer is
found with no other bytes, is repeated as a whole. The others are cut into pieces by the distance to
the minimizer, and a piece is judged likewise by the bytes that all its windows share and by its
whole bytes. Only what is then left is suffix-sorted. All steps count over all texts. A shard sends
each hash once, however often it has it, so no key is hot, and a shard of a step gets an even range
of hashes.

Strings are compared across shards by 64-bit hashes. Defined results: a null or empty text has no
bytes and nothing removed, as has one shorter than ``LENGTH``; repeated rows repeat each other's
strings; an empty table has no rows; other columns are passed over.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from riskloom.llm.batches import by_shard, hash_slices, mixed, ragged, text_groups
from riskloom.llm.ngram_trie import _runs, _shard_of_word, _steps, _sums, pack, unpack
from riskloom.session import fresh_folder

LENGTH = 200
GRAM = 40
BLOCK_BYTES = 4 << 20
SHARD_HASHES = 2_000_000
STEP = 20
LEVEL = 3  # of compression
LANES = 4096
#: What a run of windows is known to be.
UNIQUE, REPEATED, REPEATED_AND_MORE, MIXED = 0, 1, 2, 3

_TABLE = np.random.default_rng(20).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_P = np.uint64(0x9E3779B97F4A7C15)


# --- suffix arrays -----------------------------------------------------------------------------


def suffix_array(data: np.ndarray, depth: int) -> np.ndarray:
    """Places of the suffixes, sorted by their first ``depth`` bytes; zeros follow the end.

    The first eight bytes sort all suffixes; each further round sorts the groups that are still
    undecided by the ranks of what follows, doubling the depth.
    """
    n = len(data)
    padded = np.concatenate((data, np.zeros(8, np.uint8)))
    keys = np.ndarray((n,), ">u8", buffer=padded, strides=(1,)).astype(np.uint64)
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    new = np.concatenate(([True], ordered[1:] != ordered[:-1])) if n else np.zeros(0, bool)
    first = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    rank = np.empty(n + 1, np.int64)
    rank[order] = first
    rank[n] = -1
    known = 8
    while known < depth:
        step = min(known, depth - known)
        single = new & np.concatenate((new[1:], [True])) if n else new
        at = np.flatnonzero(~single)
        if not len(at):
            break
        places = order[at]
        groups = rank[places]
        both = groups * (n + 2) + rank[np.minimum(places + step, n)] + 1
        by = np.argsort(both, kind="stable")
        both = both[by]
        order[at] = places[by]
        fresh = np.concatenate(([True], both[1:] != both[:-1]))
        new[at] = fresh
        rank[order[at]] = np.maximum.accumulate(np.where(fresh, at, 0))
        known += step
    return order


def common_prefixes(data: np.ndarray, order: np.ndarray, limit: int, lanes: int = LANES) -> np.ndarray:
    """Kasai's algorithm: for each place in the suffix array the bytes shared with the one before,
    up to ``limit``.

    Along the text a common prefix below the limit shrinks by one byte at most. The text is cut
    into lanes that go on side by side, each comparing eight bytes at a time. The suffixes must be
    sorted by their first ``limit`` bytes.
    """
    n = len(data)
    if not n:
        return np.zeros(0, np.int64)
    padded = np.concatenate((data, np.zeros(16, np.uint8)))
    eights = np.ndarray((n + 8,), "<u8", buffer=padded, strides=(1,))
    before = np.empty(n, np.int64)
    before[order[1:]] = order[:-1]
    before[order[0]] = -1
    shared = np.zeros(n, np.int64)
    size = -(-n // lanes)
    starts = np.arange(0, n, size)
    length = np.zeros(len(starts), np.int64)
    for k in range(size):
        lane = np.flatnonzero(starts + k < n)
        at = starts[lane] + k
        other = before[at]
        # Suffixes that share ``limit`` bytes are in no order, so nothing follows for the next one.
        length[lane] = np.where(length[lane] >= limit, 0, np.maximum(length[lane] - 1, 0))
        length[lane[other < 0]] = 0
        todo = lane[other >= 0]
        while len(todo):
            a = starts[todo] + k + length[todo]
            b = before[starts[todo] + k] + length[todo]
            inside = (length[todo] < limit) & (a < n) & (b < n)
            todo, a, b = todo[inside], a[inside], b[inside]
            differ = eights[a] ^ eights[b]
            same = differ == 0
            low = differ & (~differ + np.uint64(1))
            bytes_same = np.bitwise_count(low - np.uint64(1)) >> 3
            length[todo] += np.where(same, 8, bytes_same)
            todo = todo[same]
        # Zeros after the end are no part of a suffix; one that ends there may be tied with zeros.
        rest = np.minimum(n - at, np.where(other < 0, 0, n - other))
        shared[at] = np.minimum(np.minimum(length[lane], rest), limit)
        length[lane] = np.where(length[lane] >= rest, 0, length[lane])
    return shared[order]


def string_classes(data: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(places in sorted order, class of each): suffixes of a class share ``length`` bytes."""
    order = suffix_array(data, length)
    return order, np.cumsum(common_prefixes(data, order, length) < length)


# --- runs of windows ---------------------------------------------------------------------------


def _gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """Hashes of the ``gram`` bytes at each place, put together from those of powers of two."""
    power, width, out, done = _TABLE[data], 1, None, 0
    factor = _P
    while True:
        if gram & width:
            if out is None:
                out, done = power, width
            else:
                n = len(data) - done - width + 1
                out = out[:n] * factor + power[done : done + n]
                done += width
        width *= 2
        if width > gram:
            break
        power = power[: len(power) - width // 2] * factor + power[width // 2 :]
        with np.errstate(over="ignore"):
            factor = factor * factor
    return mixed(out[: max(0, len(data) - gram + 1)])


def _least(values: np.ndarray, count: int) -> np.ndarray:
    """The least of ``count`` consecutive values."""
    width = 1
    while 2 * width <= count:
        values = np.minimum(values[: len(values) - width], values[width:])
        width *= 2
    rest = count - width
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def runs(data: np.ndarray, offsets: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(first window, last window, minimizer's place, minimizer's hash) of runs of windows that lie in
    one text and have the same minimizer at the same place. Equal windows are never in one run."""
    size = int(offsets[-1])
    none = np.zeros(0, np.int64)
    if size < length:
        return none, none, none, none.astype(np.uint64)
    hashes = _gram_hashes(data[:size], gram)
    # The place takes the low bits, so that the leftmost of equal hashes is the least.
    low = np.uint64((1 << size.bit_length()) - 1)
    least = _least((hashes & ~low) | np.arange(len(hashes), dtype=np.uint64), length - gram + 1) & low
    inside = np.zeros(len(least) + 1, np.int64)
    lengths = np.diff(offsets)
    long = np.flatnonzero(lengths >= length)
    inside[offsets[long]] += 1
    np.add.at(inside, offsets[long] + lengths[long] - length + 1, -1)
    valid = np.cumsum(inside[:-1]) > 0
    # No window that lies in one text is next to one that lies in another.
    same = np.concatenate(([False], (least[1:] == least[:-1]) & valid[:-1] & valid[1:]))
    starts = np.flatnonzero(valid & ~same)
    ends = np.flatnonzero(valid & ~np.concatenate((same[1:], [False])))
    places = least[starts].astype(np.int64)
    return starts, ends, places, hashes[places]


def pieces(
    data: np.ndarray, first: np.ndarray, last: np.ndarray, place: np.ndarray, least: np.ndarray, length: int, step: int = STEP
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(first window, last window, hash of the bytes that all windows of the piece share, hash of all
    its bytes) of runs cut by the distance to the minimizer.

    Equal windows have equal minimizers at equal distances, so they lie in pieces of the same number
    whose shared bytes are equal.
    """
    near, far = (place - last) // step, (place - first) // step
    count = far - near + 1
    run = np.repeat(np.arange(len(first)), count)
    number = ragged(near, count)
    low = np.maximum(first[run], place[run] - (number * step + step - 1))
    high = np.minimum(last[run], place[run] - number * step)
    start = place[run] - number * step
    key = mixed(least[run] + number.astype(np.uint64) * _P)
    core = mixed(hash_slices(data, start, start + length - step + 1) ^ key)
    ends = ((place[run] - low) * length + place[run] - high).astype(np.uint64)
    return low, high, core, mixed(hash_slices(data, low, high + length) ^ mixed(key + ends))


# --- the job -----------------------------------------------------------------------------------


def _blocks(docs: DataFrame, kind: str, limit: int, length: int, gram: int) -> DataFrame:
    """(doc_id, text) to blocks: IDs, text lengths, the bytes, and the number of runs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        ids: list[pa.Array] = []
        parts: list[np.ndarray] = []
        lengths: list[np.ndarray] = []

        def block() -> pa.RecordBatch:
            data, sizes, own = np.concatenate(parts), np.concatenate(lengths), pa.concat_arrays(ids)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([number], pa.int64()),
                    pa.ListArray.from_arrays(pa.array([0, len(own)], pa.int32()), own),
                    pa.array([pack(sizes)], pa.binary()),
                    pa.array([zstandard.ZstdCompressor(level=LEVEL).compress(data.tobytes())], pa.binary()),
                    pa.array([len(data) * 2 // (length - gram + 2) + 1], pa.int64()),
                ],
                ["block", "ids", "lengths", "bytes", "n_runs"],
            )

        for batch in batches:
            for first, last, data, offsets in text_groups(batch.column(1), limit):
                if parts and sum(map(len, parts)) + int(offsets[-1]) > limit:
                    yield block()
                    number, ids, parts, lengths = number + 1, [], [], []
                ids.append(batch.column(0).slice(first, last - first))
                parts.append(data[: offsets[-1]].copy())
                lengths.append(np.diff(offsets))
        if ids:
            yield block()

    return docs.mapInArrow(run, f"block long, ids array<{kind}>, lengths binary, bytes binary, n_runs long")


class _Pairs:
    """Two hashes of each of some pieces of text, as distinct pairs in order."""

    def __init__(self, core: np.ndarray, whole: np.ndarray) -> None:
        order = np.lexsort((whole, core))
        core, whole = core[order], whole[order]
        new = np.ones(len(order), bool)
        new[1:] = (core[1:] != core[:-1]) | (whole[1:] != whole[:-1])
        self.of = np.empty(len(order), np.int64)
        self.of[order] = np.cumsum(new) - 1
        self.core, self.whole = core[new], whole[new]
        self.many = np.bincount(self.of, minlength=len(self.core)) > 1


def _text(data: bytes) -> np.ndarray:
    """Bytes with a few zeros after them."""
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data) + bytes(8), np.uint8)


def _offsets(sizes: np.ndarray) -> np.ndarray:
    return np.concatenate(([0], np.cumsum(sizes.astype(np.int64))))


def _runs_of_block(lengths: bytes, data: bytes, length: int, gram: int):
    """(bytes, offsets, runs, pairs of minimizer and content)"""
    text, offsets = _text(data), _offsets(unpack(lengths)[0])
    found = runs(text, offsets, length, gram)
    # A minimizer's hash is low, since it is the least of many; mixed, it falls anywhere.
    return text, offsets, found, _Pairs(mixed(found[3]), hash_slices(text, found[0], found[1] + length))


def _pieces(keys: np.ndarray, shards: int) -> tuple[list[int], list[slice]]:
    """Shards that sorted keys fall into, and their slices."""
    cuts = np.searchsorted(_shard_of_word(keys, shards), np.arange(shards + 1))
    some = np.flatnonzero(np.diff(cuts)).tolist()
    return some, [slice(int(cuts[s]), int(cuts[s + 1])) for s in some]


def _message(shards: list[int], block: int, data: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(shards, pa.int64()), pa.array([block] * len(shards), pa.int64()), pa.array(data, pa.binary())],
        ["shard", "block", "data"],
    )


_MESSAGE = "shard long, block long, data binary"


def _send_runs(blocks: DataFrame, shards: int, length: int, gram: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, sizes, data in zip(*(c.to_pylist() for c in batch.columns)):
                pairs = _runs_of_block(sizes, data, length, gram)[3]
                some, parts = _pieces(pairs.core, shards)
                yield _message(some, number, [_packed(pairs.core[p], pairs.whole[p], pairs.many[p]) for p in parts])

    return blocks.select("block", "lengths", "bytes").mapInArrow(run, _MESSAGE)


def _packed(core: np.ndarray, whole: np.ndarray, many: np.ndarray) -> bytes:
    return pack(_steps(core), whole, many)


def _send_pieces(opened: DataFrame, shards: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, data in zip(*(c.to_pylist() for c in batch.columns)):
                steps, whole, many = unpack(data)
                core = _sums(steps)
                some, parts = _pieces(core, shards)
                yield _message(some, number, [_packed(core[p], whole[p], many[p]) for p in parts])

    return opened.select("block", "pairs").mapInArrow(run, _MESSAGE)


def _judge(sent: DataFrame, shards: int) -> DataFrame:
    """What each of a block's pairs is, in their order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, rows in _runs(batches):
            parts = [unpack(r[2]) for r in rows]
            core = np.concatenate([_sums(p[0]) for p in parts])
            whole = np.concatenate([p[1] for p in parts])
            many = np.concatenate([p[2] for p in parts])
            order = np.lexsort((whole, core))
            new_core = np.ones(len(order), bool)
            new_core[1:] = core[order][1:] != core[order][:-1]
            new = new_core.copy()
            new[1:] |= whole[order][1:] != whole[order][:-1]
            pair, group = np.cumsum(new) - 1, np.cumsum(new_core) - 1
            times = np.bincount(pair, weights=1 + many[order])
            kinds = np.bincount(group[new])
            alone = kinds[group[new]] == 1
            found = np.where(
                alone, np.where(times > 1, REPEATED, UNIQUE), np.where(times > 1, REPEATED_AND_MORE, MIXED)
            )
            state = np.empty(len(order), np.int64)
            state[order] = found[pair]
            cuts = np.cumsum([0, *(len(p[0]) for p in parts)])
            yield _message(
                [shard] * len(rows), 0, [pack(state[a:b]) for a, b in zip(cuts, cuts[1:])]
            ).set_column(1, "block", pa.array([r[1] for r in rows], pa.int64()))

    return by_shard(sent, shards).mapInArrow(run, _MESSAGE)


def _by_block(answers: DataFrame) -> DataFrame:
    return answers.groupBy("block").agg(F.collect_list(F.struct("shard", "data")).alias("answers"))


def _joined(answers: list[dict] | None) -> np.ndarray:
    """The answers of all shards, in order."""
    parts = [unpack(a["data"])[0] for a in sorted(answers or [], key=lambda a: a["shard"])]
    return np.concatenate(parts).astype(np.int64) if parts else np.zeros(0, np.int64)


def _cover(size: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Which of ``size`` bytes some range covers."""
    change = np.zeros(size + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, ends, -1)
    return np.cumsum(change[:-1]) > 0


class _Texts:
    """A block's texts: the results of those that are decided, and the bytes of the others."""

    def __init__(self, meta: np.ndarray, digests: np.ndarray, data: np.ndarray) -> None:
        #: For each text its length, whether it is open, the bytes and the runs removed.
        self.meta, self.digests, self.data = meta, digests, data
        self.rows = np.flatnonzero(meta[1])
        self.offsets = _offsets(meta[0][self.rows])

    @classmethod
    def open(cls, offsets: np.ndarray, data: np.ndarray) -> _Texts:
        n = len(offsets) - 1
        meta = np.stack([np.diff(offsets), np.ones(n, np.int64), *np.zeros((2, n), np.int64)])
        return cls(meta, np.zeros((n, 32), np.uint8), data)

    @classmethod
    def load(cls, meta: bytes, digests: bytes, data: bytes) -> _Texts:
        numbers = np.stack(unpack(meta)).astype(np.int64)
        return cls(numbers, np.frombuffer(digests, np.uint8).reshape(-1, 32).copy(), _text(data))

    def dump(self) -> list[pa.Array]:
        raw = self.data[: self.offsets[-1]].tobytes()
        packed = zstandard.ZstdCompressor(level=LEVEL).compress(raw)
        return [pa.array([x], pa.binary()) for x in (pack(*self.meta), self.digests.tobytes(), packed)]

    def close(self, gone: np.ndarray, asked: np.ndarray) -> np.ndarray:
        """Decides all texts but those with a string still asked for; returns what to add to a place
        in each of the texts that were open to get its place among the bytes that go on."""
        n = len(self.rows)
        stay = np.zeros(n, bool)
        stay[np.searchsorted(self.offsets, asked, "right") - 1] = True
        total = np.concatenate(([0], np.cumsum(gone)))
        for k in np.flatnonzero(~stay).tolist():
            low, high, row = int(self.offsets[k]), int(self.offsets[k + 1]), self.rows[k]
            own, removed = gone[low:high], int(total[high] - total[low])
            kept = self.data[low:high]
            if removed:
                self.meta[2:, row] = removed, int(own[0]) + int((own[1:] & ~own[:-1]).sum())
                kept = kept[~own]
            self.digests[row] = np.frombuffer(hashlib.sha256(kept.tobytes()).digest(), np.uint8)
        self.meta[1, self.rows[~stay]] = 0
        sizes = np.diff(self.offsets)
        shift = np.zeros(n, np.int64)
        shift[stay] = np.cumsum(sizes[stay]) - sizes[stay] - self.offsets[:-1][stay]
        self.kept = ragged(self.offsets[:-1][stay], sizes[stay])
        self.data = np.concatenate((self.data[self.kept], np.zeros(8, np.uint8)))
        self.rows, self.offsets = self.rows[stay], _offsets(sizes[stay])
        return shift


def _edges(gone: np.ndarray) -> bytes:
    """Where ranges of bytes that go begin and end."""
    edges = np.flatnonzero(np.diff(np.concatenate(([0], gone.view(np.int8), [0]))))
    return pack(edges[::2], edges[1::2])


def _covered(size: int, edges: bytes) -> np.ndarray:
    return _cover(size, *(x.astype(np.int64) for x in unpack(edges)))


_TEXTS = "block long, ids array<{id}>, meta binary, digests binary, bytes binary, cover binary"
_OPENED = f"{_TEXTS}, pairs binary, places binary, n_pairs long"
_SORTED = f"{_TEXTS}, data binary, n_hashes long"


def _names(ddl: str) -> list[str]:
    return [f.split()[0] for f in ddl.split(", ")]


def _open_runs(joined: DataFrame, kind: str, length: int, gram: int) -> DataFrame:
    """Each block with the texts that no longer have an open run decided, and the pieces of the open
    runs in the others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                number, sizes, raw, answers = (batch.column(c)[k].as_py() for c in (0, 2, 3, 4))
                yield block(number, batch.column(1).slice(k, 1), sizes, raw, answers)

    def block(number: int, ids: pa.Array, sizes: bytes, raw: bytes, answers: list[dict] | None) -> pa.RecordBatch:
        data, offsets, (first, last, place, least), pairs = _runs_of_block(sizes, raw, length, gram)
        state = _joined(answers)[pairs.of] if len(pairs.of) else pairs.of
        whole = (state == REPEATED) | (state == REPEATED_AND_MORE)
        gone = _cover(int(offsets[-1]), first[whole], last[whole] + length)
        more = (state == REPEATED_AND_MORE) | (state == MIXED)
        low, high, core, full = pieces(data, first[more], last[more], place[more], least[more], length)
        texts = _Texts.open(offsets, data)
        row = np.searchsorted(offsets, low, "right") - 1
        shift = texts.close(gone, low)
        own = _Pairs(core, full)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([number], pa.int64()), ids, *texts.dump(),
                pa.array([_edges(gone[texts.kept])], pa.binary()),
                pa.array([_packed(own.core, own.whole, own.many)], pa.binary()),
                pa.array([pack(low + shift[row], high - low, own.of)], pa.binary()),
                pa.array([len(own.core)], pa.int64()),
            ],
            _names(_OPENED),
        )

    columns = joined.select("block", "ids", "lengths", "bytes", "answers")
    return columns.mapInArrow(run, _OPENED.format(id=kind))


def _sort_strings(joined: DataFrame, kind: str, length: int) -> DataFrame:
    """Each block with the texts decided that hold no string still in question, and the sorted
    strings of the open pieces: their hashes, with the place of those in question."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                number, meta, digests, raw, cover, places, answers = (batch.column(c)[k].as_py() for c in (0, 2, 3, 4, 5, 6, 7))
                yield block(number, batch.column(1).slice(k, 1), _Texts.load(meta, digests, raw), cover, places, answers)

    def block(number: int, ids: pa.Array, texts: _Texts, cover: bytes, places: bytes, answers: list[dict] | None) -> pa.RecordBatch:
        size = int(texts.offsets[-1])
        low, span, pair = (x.astype(np.int64) for x in unpack(places))
        high = low + span
        state = _joined(answers)[pair] if len(pair) else pair
        whole = (state == REPEATED) | (state == REPEATED_AND_MORE)
        gone = _covered(size, cover) | _cover(size, low[whole], high[whole] + length)
        more = (state == REPEATED_AND_MORE) | (state == MIXED)
        hashes, single, many = _strings(texts.data, size, low[more], high[more], length)
        gone |= _cover(size, many, many + length)
        # A string whose bytes all go already is not in question, but others may ask for it.
        total = np.concatenate(([0], np.cumsum(gone)))
        asked = single >= 0
        asked[asked] = total[single[asked] + length] - total[single[asked]] < length
        row = np.searchsorted(texts.offsets, single[asked], "right") - 1
        shift = texts.close(gone, single[asked])
        moved = np.zeros(len(single), np.int64)
        moved[asked] = single[asked] + shift[row] + 1  # 0 is a string not in question
        return pa.RecordBatch.from_arrays(
            [
                pa.array([number], pa.int64()), ids, *texts.dump(),
                pa.array([_edges(gone[texts.kept])], pa.binary()),
                pa.array([pack(_steps(hashes), moved)], pa.binary()),
                pa.array([len(hashes)], pa.int64()),
            ],
            _names(_SORTED),
        )

    columns = joined.select("block", "ids", "meta", "digests", "bytes", "cover", "places", "answers")
    return columns.mapInArrow(run, _SORTED.format(id=kind))


def _strings(data: np.ndarray, size: int, first: np.ndarray, last: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct strings at the windows of some pieces: (sorted hashes, place of a string that the
    block has once, else -1; places of all strings that it has more than once)."""
    none = np.zeros(0, np.int64)
    if not len(first):
        return none.astype(np.uint64), none, none
    order = np.argsort(first, kind="stable")
    first, last = first[order], last[order]
    # Pieces that overlap or touch are one region of text.
    reach = np.maximum.accumulate(last + length)
    apart = np.concatenate(([True], first[1:] > reach[:-1]))
    low, high = first[apart], reach[np.concatenate((apart[1:], [True]))]
    region = ragged(low, high - low)
    starts = np.zeros(size + 1, bool)
    starts[ragged(first, last - first + 1)] = True
    order, classes = string_classes(data[region], length)
    places = region[order]
    asked = starts[places]
    places, classes = places[asked], classes[asked]
    firsts = np.flatnonzero(np.concatenate(([True], classes[1:] != classes[:-1])))
    counts = np.diff(np.concatenate((firsts, [len(classes)])))
    hashes = hash_slices(data, places[firsts], places[firsts] + length)
    by = np.argsort(hashes)
    single = np.where(counts == 1, places[firsts], -1)
    return hashes[by], single[by], places[np.repeat(counts > 1, counts)]


def _send_strings(own: DataFrame, shards: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, data in zip(*(c.to_pylist() for c in batch.columns)):
                steps, _ = unpack(data)
                hashes = _sums(steps)
                some, parts = _pieces(hashes, shards)
                yield _message(some, number, [pack(_steps(hashes[p])) for p in parts])

    return own.select("block", "data").mapInArrow(run, _MESSAGE)


def _merge_strings(sent: DataFrame, shards: int) -> DataFrame:
    """Which of each block's strings another block has as well: each block's sorted hashes are
    searched for in all of them, sorted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, rows in _runs(batches):
            parts = [_sums(unpack(r[2])[0]) for r in rows]
            every = np.sort(np.concatenate(parts), kind="stable")
            found = [
                np.searchsorted(every, p, "right") - np.searchsorted(every, p, "left") > 1 for p in parts
            ]
            yield _message([shard] * len(rows), 0, [pack(f) for f in found]).set_column(
                1, "block", pa.array([r[1] for r in rows], pa.int64())
            )

    return by_shard(sent, shards).mapInArrow(run, _MESSAGE)


def _finish(joined: DataFrame, kind: str, length: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                ids = batch.column(0)[k].values
                meta, digests, raw, cover, data, answers = (batch.column(c)[k].as_py() for c in range(1, 7))
                texts = _Texts.load(meta, digests, raw)
                size = int(texts.offsets[-1])
                moved = unpack(data)[1].astype(np.int64)
                found = moved[_joined(answers) > 0] if len(moved) else moved
                found = found[found > 0] - 1
                texts.close(_covered(size, cover) | _cover(size, found, found + length), found[:0])
                yield pa.RecordBatch.from_arrays(
                    [ids, *map(pa.array, texts.meta[[0, 2, 3]]), pa.array([d.tobytes().hex() for d in texts.digests], pa.string())],
                    ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
                )

    columns = joined.select("ids", "meta", "digests", "bytes", "cover", "data", "answers")
    schema = f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return columns.mapInArrow(run, schema)


def _total(df: DataFrame, column: str, of: int) -> int:
    """Shards for the sum of a column."""
    return max(1, -(-int(df.agg(F.sum(column)).head()[0] or 0) // of))


def _written(df: DataFrame, name: str) -> DataFrame:
    """The rows are compressed already."""
    path = fresh_folder(df.sparkSession, name)
    df.write.option("compression", "uncompressed").parquet(path)
    return df.sparkSession.read.parquet(path)


def remove_repeats(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    length: int = LENGTH,
    gram: int = GRAM,
    block_bytes: int = BLOCK_BYTES,
    shard_hashes: int = SHARD_HASHES,
) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of each text."""
    kind = docs.schema[doc_id].dataType.simpleString()
    given = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    blocks = _written(_blocks(given, kind, block_bytes, length, gram), "repeats-blocks")
    shards = _total(blocks, "n_runs", shard_hashes)
    states = _written(_judge(_send_runs(blocks, shards, length, gram), shards), "repeats-runs")
    joined = blocks.join(_by_block(states), "block", "left")
    opened = _written(_open_runs(joined, kind, length, gram), "repeats-opened")
    shards = _total(opened, "n_pairs", shard_hashes)
    states = _written(_judge(_send_pieces(opened, shards), shards), "repeats-pieces")
    joined = opened.drop("pairs").join(_by_block(states), "block", "left")
    own = _written(_sort_strings(joined, kind, length), "repeats-strings")
    shards = _total(own, "n_hashes", shard_hashes)
    found = _merge_strings(_send_strings(own, shards), shards)
    return _finish(own.join(_by_block(found), "block", "left"), kind, length)
