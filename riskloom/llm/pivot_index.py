"""Exact top-k search by inner product over a pivot-distance index.

Pivots are the centres of a bounded sample. Every vector is keyed by its nearest pivot and the
distance to it, and the table is sorted by that key over range partitions, which cut ties by row, so
that a pivot or a distance that a third of all rows share is spread like any other. A partition is a
shard; runs of 128 rows of one pivot in it are annuli, each with its least and largest distance and
its largest norm N.

For a query q at distance d from an annulus' pivot p, a vector v of the annulus is at least
g = max(0, low - d, d - high) away from q by the triangle inequality, so that
q.v = (|q|^2 + |v|^2 - |q - v|^2) / 2 <= (|q|^2 + N^2 - g^2) / 2, and at most q.p + |q| * high besides.
Annuli are expanded from the largest bound down, and a query stops where the bound falls below its
k-th best score.

The first round searches each query's own shard, where its nearest annuli are. The k-th best score
found there goes with the query in the second round to the other shards, but to those alone whose
annuli can reach it. The pivots only decide the speed; the result is exact.

A cell of the second round is one shard with a slab of the query groups, so that a task's work is
bounded however many queries there are. The shards' bounds for routing go to the tasks if there are
at most ``DIRECTORY_ROWS`` of them; beyond, queries go to every shard and stop there.

Defined results: vectors that take no part and shorter vectors as in ``vectors``; a row without ID is
a candidate after all others of its score and never a query; of repeated rows each is a row of its
own, so one finds the other; fewer than k other rows are all returned; an empty table has no rows.
Further columns are passed over.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from riskloom.llm import vectors
from riskloom.llm.batches import by_shard, ragged, run_starts
from riskloom.session import fresh_folder, remove_folder

NEAREST = 5
PIVOTS = 128
PIVOT_BYTES = 8 << 20
#: Vectors that the pivots are found from.
SAMPLE = 2048
ANNULUS = 128
SHARD_ROWS = 16_384
GROUP = 256
#: Query groups of a cell.
SLAB = 64
DIRECTORY_ROWS = 100_000
MOST_TASKS = 20_000

FOUND = "query bigint, query_id bigint, vec_id bigint, score bigint"
MESSAGE = "numbers array<long>, least array<long>"


def find_pivots(sample: np.ndarray, count: int = PIVOTS, rounds: int = 6) -> np.ndarray:
    """Centres of the sample by a few rounds of k-means, from evenly spaced rows."""
    count = min(count, len(sample), max(1, PIVOT_BYTES // (8 * sample.shape[1] or 1)))
    centres = sample[np.linspace(0, len(sample) - 1, count).astype(int)].copy()
    for _ in range(rounds):
        at, _ = vectors.nearest(sample, centres)
        for c in np.unique(at):
            centres[c] = sample[at == c].mean(axis=0)
    return np.unique(centres, axis=0)


class Annuli:
    """The annuli of sorted rows, and upper bounds of a query's score in each."""

    def __init__(self, pivot: np.ndarray, distance: np.ndarray, norms: np.ndarray, most: int = ANNULUS) -> None:
        runs = run_starts(pivot)
        lengths = np.diff(np.append(runs, len(pivot)))
        parts = -(-lengths // most)
        self.starts = np.repeat(runs, parts) + most * ragged(np.zeros(len(runs), np.int64), parts)
        self.ends = np.append(self.starts[1:], len(pivot))
        self.pivot = pivot[self.starts]
        self.low = distance[self.starts]
        self.high = distance[self.ends - 1]
        self.norm = np.maximum.reduceat(norms, self.starts) if len(norms) else norms


def bounds(queries: np.ndarray, pivots: np.ndarray, pivot: np.ndarray, low, high, norm) -> np.ndarray:
    """No vector of the annulus scores more: a row for each query, a column for each annulus."""
    dim = max(queries.shape[1], pivots.shape[1])
    queries, pivots = vectors.widened(queries, dim).astype(np.float64), vectors.widened(pivots, dim)
    own = np.einsum("ij,ij->i", queries, queries)[:, None]
    dots = queries @ pivots.T
    away = np.sqrt(np.maximum(own + np.einsum("ij,ij->i", pivots, pivots) - 2 * dots, 0))[:, pivot]
    slack = 1e-9 * (own + norm**2 + high**2) + 1e-3
    gap = np.maximum(np.maximum(low - away, away - high) - 1e-6 * (away + high), 0)
    by_distance = (own + norm**2 - gap**2) / 2
    by_pivot = dots[:, pivot] + np.sqrt(own) * high
    return np.minimum(by_distance, by_pivot) + slack


def expand(
    shard: vectors.Shard, annuli: Annuli, pivots: np.ndarray, queries: np.ndarray, least: np.ndarray, k: int,
    own: np.ndarray | None = None,
) -> vectors.Best:
    """The k best rows of a shard for each query, of those that score at least ``least``. ``own`` is the
    query's place in the shard, which it does not find."""
    best = vectors.Best(least[:, None], np.full((len(least), 1), np.iinfo(np.int64).max), k)
    dim = max(queries.shape[1], shard.values.shape[1])
    limit = bounds(queries, pivots, annuli.pivot, annuli.low, annuli.high, annuli.norm)
    kind = vectors.exact_type(float(vectors.norms(queries).max()), float(shard.norms.max()))
    given = vectors.widened(vectors.typed(queries, kind), dim)
    held = vectors.widened(shard.typed(kind), dim)
    widest = limit.max(axis=0)
    for a in np.argsort(-widest, kind="stable"):
        need = best.least()
        if widest[a] < need.min():
            break
        live = np.flatnonzero(limit[:, a] >= need)
        if not len(live):
            continue
        low, high = int(annuli.starts[a]), int(annuli.ends[a])
        scores = vectors.products(given[live], held[low:high])
        fits = scores >= need[live][:, None]
        if own is not None:
            here = np.flatnonzero((own[live] >= low) & (own[live] < high))
            fits[here, own[live][here] - low] = False
        row, column = np.nonzero(fits)
        best.offer(live[row], scores[row, column], shard.ids[low + column], low + column)
    return best


def _index(rows: DataFrame, pivots: np.ndarray, vec_id: str, vector: str, queries: Column, path: str) -> int:
    """Writes the sorted shards and gives back their number."""
    spark = rows.sparkSession
    kinds = rows.select(F.col(vec_id).cast("long").alias("v"), F.col(vector).alias("x")).schema

    def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok, values = vectors.integers(batch.column(1))
            kept = batch.filter(pa.array(ok))
            at, distance = vectors.nearest(values, pivots)
            yield pa.RecordBatch.from_arrays(
                [*kept.columns, pa.array(at, pa.int32()), pa.array(distance)], ["v", "x", "w", "pivot", "distance"]
            )

    given = rows.select(F.col(vec_id).cast("long").alias("v"), F.col(vector).alias("x"), queries.alias("w"))
    fields = f"v long, x {kinds['x'].dataType.simpleString()}, w boolean, pivot int, distance double"
    given.mapInArrow(key, fields).write.parquet(f"{path}/keyed")
    keyed = spark.read.parquet(f"{path}/keyed")
    shards = -(-keyed.count() // SHARD_ROWS)
    # A number for each row parts ties, so that no key is bound to one partition.
    dealt = keyed.withColumn("n", F.monotonically_increasing_id()).repartitionByRange(
        max(1, shards), "pivot", "distance", "n"
    )
    ordered = dealt.sortWithinPartitions("pivot", "distance")
    keys = [F.col("pivot"), F.col("distance")]
    made = vectors.blocks(ordered, F.col("v"), F.col("x"), F.col("w"), keys=keys)
    # Blocks carry their partition's number: the shard.
    made.withColumn("shard", F.shiftright("block", 20)).write.parquet(f"{path}/shards")
    return spark.read.parquet(f"{path}/shards").agg(F.max("shard")).first()[0] + 1


def _in_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[vectors.Shard]:
    """The shards of blocks that come shard after shard."""
    waiting: list[dict] = []
    for batch in batches:
        for row in vectors.rows_of(batch):
            if waiting and waiting[0]["shard"] != row["shard"]:
                yield vectors.Shard(waiting)
                waiting = []
            waiting.append(row)
    if waiting:
        yield vectors.Shard(waiting)


def _annuli(shard: vectors.Shard) -> Annuli:
    return Annuli(shard.keys[0].astype(np.int64), shard.keys[1], shard.norms)


def _first_round(path: str, spark, pivots: np.ndarray, k: int, shards: int) -> None:
    """Writes each query with what it finds in its own shard, and the shards' bounds for routing."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard in _in_shards(batches):
            annuli = _annuli(shard)
            asked = np.flatnonzero(shard.wanted & shard.has_id)
            for low in range(0, len(asked), GROUP):
                at = asked[low : low + GROUP]
                least = np.full(len(at), np.iinfo(np.int64).min)
                best = expand(shard, annuli, pivots, shard.values[at], least, k, own=at)
                query, score, _, place = best.held[0]
                edges = np.searchsorted(query, np.arange(len(at) + 1))
                full = np.diff(edges) == k
                raws = [vectors.packed(shard.values[i : i + 1]) for i in at]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(shard.numbers[at]),
                        pa.array(shard.ids[at]),
                        pa.array(np.where(full, best.need[:, 0], np.iinfo(np.int64).min)),
                        pa.array([r for r, _ in raws], pa.binary()),
                        pa.array([w for _, w in raws], pa.int32()),
                        pa.ListArray.from_arrays(
                            pa.array(edges, pa.int32()), vectors.id_array(shard.ids[place], shard.has_id[place])
                        ),
                        pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(score)),
                    ],
                    ["query", "query_id", "least", "vector", "width", "ids", "scores"],
                )

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in vectors.rows_of(batch):
                shard = vectors.Shard([row])
                runs = Annuli(shard.keys[0].astype(np.int64), shard.keys[1], shard.norms, most=vectors.BLOCK_ROWS)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(runs.pivot), row["shard"]), pa.int64()),
                        pa.array(runs.pivot, pa.int32()),
                        *(pa.array(x) for x in (runs.low, runs.high, runs.norm)),
                    ],
                    ["shard", "pivot", "low", "high", "norm"],
                )

    stored = spark.read.parquet(f"{path}/shards")
    fields = "query long, query_id long, least long, vector binary, width int, ids array<long>, scores array<long>"
    by_shard(stored, shards).mapInArrow(search, fields).write.parquet(f"{path}/queries")
    fields = "shard long, pivot int, low double, high double, norm double"
    stored.mapInArrow(describe, fields).write.parquet(f"{path}/directory")


def _messages(path: str, spark, pivots: np.ndarray, shards: int, slabs: int) -> DataFrame:
    """Groups of queries for each other shard that can hold better rows than the first round found."""
    segments = spark.read.parquet(f"{path}/directory")
    known = None
    if segments.count() <= DIRECTORY_ROWS:
        table = segments.toArrow()
        known = [c.to_numpy() for c in table.columns]

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, len(batch), GROUP):
                part = list(vectors.rows_of(batch.slice(low, GROUP)))
                values = vectors.stacked([vectors.unpacked(r["vector"], 1, len(r["vector"]) // r["width"], r["width"]) for r in part])
                numbers, ids, least = (np.array([r[c] for r in part], np.int64) for c in ("query", "query_id", "least"))
                home = numbers // vectors.BLOCK_ROWS >> 20
                if known is None:
                    reach = np.ones((len(part), shards), bool)
                else:
                    limit = bounds(values, pivots, known[1], *known[2:])
                    reach = np.zeros((len(part), shards), bool)
                    row, column = np.nonzero(limit >= least[:, None])
                    reach[row, known[0][column]] = True
                reach[np.arange(len(part)), home] = False
                for shard in np.flatnonzero(reach.any(axis=0)).tolist():
                    at = np.flatnonzero(reach[:, shard])
                    raw, width = vectors.packed(values[at])
                    cell = shard * slabs + int(numbers[0]) // vectors.BLOCK_ROWS % slabs
                    row = [cell, 1, ids[at].tolist(), numbers[at].tolist(), least[at].tolist(), raw, values.shape[1], width]
                    kinds = [pa.int64(), pa.int32(), *[pa.list_(pa.int64())] * 3, pa.binary(), pa.int32(), pa.int32()]
                    names = ["shard", "kind", "ids", "numbers", "least", "vectors", "dim", "width"]
                    yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, kinds)], names)

    asked = spark.read.parquet(f"{path}/queries").select("query", "query_id", "least", "vector", "width")
    fields = f"shard long, kind int, ids array<long>, {MESSAGE}, vectors binary, dim int, width int"
    return asked.mapInArrow(route, fields)


def _second_round(path: str, spark, pivots: np.ndarray, k: int, shards: int, queries: int) -> DataFrame:
    slabs = max(1, -(-queries // (GROUP * SLAB)))
    messages = _messages(path, spark, pivots, shards, slabs)
    stored = spark.read.parquet(f"{path}/shards")
    copies = F.explode(F.sequence(F.lit(0), F.lit(slabs - 1)))
    stored = stored.withColumn("slab", copies).withColumn("shard", F.col("shard") * slabs + F.col("slab"))
    cells = stored.drop("slab").withColumn("kind", F.lit(0)).unionByName(messages, allowMissingColumns=True)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, cell, shard, annuli = [], None, None, None
        for batch in batches:
            for row in vectors.rows_of(batch):
                if row["shard"] != cell:
                    parts, cell, shard = [], row["shard"], None
                if row["kind"] == 0:
                    parts.append(row)
                    continue
                if shard is None:
                    shard, parts = vectors.Shard(parts), []
                    annuli = _annuli(shard)
                asked = vectors.unpacked(row["vectors"], len(row["ids"]), row["dim"], row["width"])
                numbers, ids = np.array(row["numbers"], np.int64), np.array(row["ids"], np.int64)
                best = expand(shard, annuli, pivots, asked, np.array(row["least"], np.int64), k)
                query, score, found, place = best.held[0]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(numbers[query]),
                        pa.array(ids[query]),
                        vectors.id_array(found, shard.has_id[place]),
                        pa.array(score),
                    ],
                    ["query", "query_id", "vec_id", "score"],
                )

    tasks = min(shards * slabs, MOST_TASKS)
    return by_shard(cells, tasks, "shard", "kind", "block").mapInArrow(search, FOUND)


def top_k(
    rows: DataFrame, queries: Column, k: int = NEAREST, vec_id: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """query_id, rank, vec_id, score: for each row where ``queries`` holds, the k other rows of the highest
    inner product, ties to the smaller ID."""
    spark = rows.sparkSession
    sample = vectors.sample_vectors(rows, vec_id, vector, SAMPLE)
    if not len(sample):
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    pivots = find_pivots(sample)
    path = fresh_folder(spark, "pivot-index")
    shards = _index(rows, pivots, vec_id, vector, queries, path)
    remove_folder(spark, f"{path}/keyed")
    _first_round(path, spark, pivots, k, shards)
    asked = spark.read.parquet(f"{path}/queries")
    at_home = asked.select("query", "query_id", F.inline(F.arrays_zip(F.col("ids").alias("vec_id"), F.col("scores").alias("score"))))
    elsewhere = _second_round(path, spark, pivots, k, shards, asked.count())
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    ranked = at_home.unionByName(elsewhere).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
