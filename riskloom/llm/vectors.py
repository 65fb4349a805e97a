"""Integer vectors of Arrow batches, blocks of them as rows, and the best scores of many queries.

A component x becomes floor(256 x). Scores are inner products and exact: they are computed in the
narrowest float type in which no sum of products can round, and in Python's integers beyond; a score
out of 64 bits becomes the nearest one in it. A vector takes no part if it is null or holds a
component that is null, not finite or out of 64 bits. A shorter vector counts as ending in zeros.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from riskloom.llm.batches import ragged, run_starts

SCALE = 256.0
BLOCK_ROWS = 8192
BLOCK_BYTES = 8 << 20
#: Place of a row without ID among equal scores: after all others.
NO_ID = np.iinfo(np.int64).max

BLOCK = "ids array<long>, wanted binary, labels binary, keys binary, vectors binary, dim int, width int"


def integers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(which rows take part, their components in int64), as wide as the longest."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    with np.errstate(all="ignore"):
        flat = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
        flat = np.floor(flat * SCALE)
        usable = np.abs(flat) < 2.0**63
    bad = np.concatenate(([0], np.cumsum(~usable)))
    ends = np.cumsum(lengths)
    ok = column.is_valid().to_numpy(zero_copy_only=False) & (bad[ends] == bad[ends - lengths])
    kept = lengths[ok]
    dim = int(kept.max()) if len(kept) else 0
    values = flat[np.repeat(ok, lengths)].astype(np.int64)
    if (kept == dim).all():
        return ok, values.reshape(len(kept), dim)
    out = np.zeros((len(kept), dim), np.int64)
    out[np.repeat(np.arange(len(kept)), kept), ragged(np.zeros(len(kept), np.int64), kept)] = values
    return ok, out


def norms(values: np.ndarray) -> np.ndarray:
    floats = values.astype(np.float64)
    return np.sqrt(np.einsum("ij,ij->i", floats, floats))


def widened(values: np.ndarray, dim: int) -> np.ndarray:
    if values.shape[1] == dim:
        return values
    return np.pad(values, ((0, 0), (0, dim - values.shape[1])))


def stacked(parts: list[np.ndarray]) -> np.ndarray:
    dim = max(p.shape[1] for p in parts)
    return np.concatenate([widened(p, dim) for p in parts])


def packed(values: np.ndarray) -> tuple[bytes, int]:
    """(bytes, bytes of a component) in the narrowest integer type."""
    most = max(int(values.max()), -1 - int(values.min())) if values.size else 0
    width = next(w for w in (2, 4, 8) if most < 1 << (8 * w - 1))
    return values.astype(f"<i{width}").tobytes(), width


def unpacked(raw: bytes, rows: int, dim: int, width: int) -> np.ndarray:
    return np.frombuffer(raw, f"<i{width}").reshape(rows, dim)


def exact_type(left: float, right: float) -> type:
    """A type in which inner products of vectors of at most these norms are exact."""
    reach = left * right
    return np.float32 if reach < 2**23 else np.float64 if reach < 2**52 else object


def products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Inner products as int64 of rows held in a type of ``exact_type``."""
    made = left @ right.T
    if made.dtype == object:
        made = np.clip(made, np.iinfo(np.int64).min, np.iinfo(np.int64).max)
    return made.astype(np.int64)


def typed(values: np.ndarray, kind: type) -> np.ndarray:
    return values.astype(np.int64).astype(kind) if kind is object else values.astype(kind)


class Best:
    """For each query and each of its windows of scores, the k best of what was offered; equal scores
    go by the smaller ID, rows without ID last. ``need`` is the least score that may still enter."""

    def __init__(self, low: np.ndarray, high: np.ndarray, k: int) -> None:
        self.high, self.k = high, k
        self.need = np.where(low <= high, low, np.iinfo(np.int64).max)
        empty = np.zeros(0, np.int64)
        self.held = [(empty, empty, empty, empty) for _ in range(low.shape[1])]

    def least(self) -> np.ndarray:
        """The least score of use to each query."""
        return self.need.min(axis=1)

    def offer(self, query: np.ndarray, score: np.ndarray, vec_id: np.ndarray, place: np.ndarray) -> None:
        for j in range(len(self.held)):
            fits = (score >= self.need[query, j]) & (score <= self.high[query, j])
            if not fits.any():
                continue
            new = (query[fits], score[fits], vec_id[fits], place[fits])
            rows = [np.concatenate(pair) for pair in zip(self.held[j], new)]
            order = np.lexsort((rows[3], rows[2], -rows[1], rows[0]))
            rows = [r[order] for r in rows]
            starts = run_starts(rows[0])
            rank = np.arange(len(order)) - np.repeat(starts, np.diff(np.append(starts, len(order))))
            last = rank == self.k - 1
            self.need[rows[0][last], j] = rows[1][last]
            self.held[j] = tuple(r[rank < self.k] for r in rows)


def blocks(
    rows: DataFrame,
    vec_id: Column,
    vector: Column,
    wanted: Column,
    label: Column | None = None,
    keys: list[Column] = [],
) -> DataFrame:
    """Consecutive rows of each partition as blocks: block, a number of its own made from the partition's
    and the place in it; IDs; which rows are wanted as queries; labels; up to two doubles a row."""
    columns = [vec_id.cast("long").alias("v"), vector.alias("x"), F.coalesce(wanted, F.lit(False)).alias("w")]
    columns.append((F.lit(None) if label is None else label).cast("long").alias("l"))
    columns += [k.cast("double").alias(f"k{i}") for i, k in enumerate(keys)]
    last = len(columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 20
        for batch in _of_rows(batches):
            ok, values = integers(batch.column(1))
            if not len(values):
                continue
            kept = batch.filter(pa.array(ok))
            raw, width = packed(values)
            of = [kept.column(i).to_numpy(zero_copy_only=False).astype(np.float64) for i in range(4, last)]
            labels = pc.fill_null(kept.column(3), 0).to_numpy().astype("<i8").tobytes()
            row = [
                [number],
                [kept.column(0)],
                [kept.column(2).to_numpy(zero_copy_only=False).astype(np.uint8).tobytes()],
                [labels],
                [np.array(of).astype("<f8").tobytes()],
                [raw],
                [values.shape[1]],
                [width],
            ]
            kinds = [pa.int64(), pa.list_(pa.int64()), *[pa.binary()] * 4, pa.int32(), pa.int32()]
            names = ["block", "ids", "wanted", "labels", "keys", "vectors", "dim", "width"]
            row[1] = [kept.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(r, k) for r, k in zip(row, kinds)], names)
            number += 1

    return rows.select(*columns).mapInArrow(run, f"block long, {BLOCK}")


def _of_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most the rows and bytes of a block, as full as can be."""
    waiting, rows = [], 0
    limit = BLOCK_ROWS
    for batch in batches:
        widest = pc.max(pc.list_value_length(batch.column(1))).as_py() or 1
        limit = max(1, min(limit, BLOCK_BYTES // (8 * widest)))
        waiting.append(batch)
        rows += len(batch)
        if rows >= limit:
            joined = pa.Table.from_batches(waiting).combine_chunks().to_batches()[0]
            full = rows - rows % limit
            for first in range(0, full, limit):
                yield joined.slice(first, limit)
            waiting, rows = [joined.slice(full)], rows - full
    if rows:
        yield pa.Table.from_batches(waiting).combine_chunks().to_batches()[0]


class Shard:
    """Blocks read back and put together: IDs, wanted, labels, keys, vectors, and of each row the number
    that it has over all blocks."""

    def __init__(self, rows: list[dict]) -> None:
        counts = [len(r["wanted"]) for r in rows]
        self.ids = np.concatenate([_ids(r["ids"]) for r in rows])
        self.has_id = np.concatenate([~_nulls(r["ids"]) for r in rows])
        self.wanted = np.concatenate([np.frombuffer(r["wanted"], np.uint8) for r in rows]).astype(bool)
        self.labels = np.concatenate([np.frombuffer(r["labels"], "<i8") for r in rows])
        self.keys = np.concatenate(
            [np.frombuffer(r["keys"], "<f8").reshape(-1, n) for r, n in zip(rows, counts)], axis=1
        )
        self.values = stacked([unpacked(r["vectors"], n, r["dim"], r["width"]) for r, n in zip(rows, counts)])
        self.numbers = np.concatenate([r["block"] * BLOCK_ROWS + np.arange(n) for r, n in zip(rows, counts)])
        self.norms = norms(self.values)
        self._typed: dict[type, np.ndarray] = {}

    def typed(self, kind: type) -> np.ndarray:
        if kind not in self._typed:
            self._typed[kind] = typed(self.values, kind)
        return self._typed[kind]


def _ids(listed: list | np.ndarray) -> np.ndarray:
    return np.array([NO_ID if x is None else x for x in listed], np.int64)


def _nulls(listed: list | np.ndarray) -> np.ndarray:
    return np.array([x is None for x in listed], bool)


def id_array(ids: np.ndarray, has_id: np.ndarray) -> pa.Array:
    return pa.array(ids, pa.int64(), mask=~has_id)


def rows_of(batch: pa.RecordBatch) -> Iterator[dict]:
    """The rows of a batch, one after the other, as dictionaries."""
    for k in range(len(batch)):
        yield {name: batch.column(i)[k].as_py() for i, name in enumerate(batch.schema.names)}


def nearest(values: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of the nearest centre, distance to it) of each row."""
    dim = max(values.shape[1], centres.shape[1])
    values, centres = widened(values, dim).astype(np.float64), widened(centres, dim)
    at, least = np.zeros(len(values), np.int64), np.full(len(values), np.inf)
    own = np.einsum("ij,ij->i", centres, centres)
    for low in range(0, len(values), 4096):
        part = values[low : low + 4096]
        at[low : low + 4096] = (own - 2 * (part @ centres.T)).argmin(axis=1)
        gap = part - centres[at[low : low + 4096]]
        least[low : low + 4096] = np.sqrt(np.einsum("ij,ij->i", gap, gap))
    return at, least


def sample_vectors(rows: DataFrame, vec_id: str, vector: str, size: int) -> np.ndarray:
    """At most ``size`` vectors that take part, those with the lowest hashes; the driver holds no more."""
    drawn = rows.where(F.col(vector).isNotNull()).select(vec_id, vector)
    # Twice as many, since some may take no part.
    drawn = drawn.orderBy(F.xxhash64(vec_id, vector), vec_id).limit(2 * size).toArrow()
    if not drawn.num_rows:
        return np.zeros((0, 1))
    return integers(drawn.column(1))[1][:size].astype(np.float64)
