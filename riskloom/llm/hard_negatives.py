"""Hard negatives by lists that the anchors of a cluster share.

Anchors are grouped with the nearest of a few directions found from a bounded sample, and each group
of at most 256 has a centre and the largest angle t of a member to it. Every shard of the table is
sorted once for a group, by |v| cos(max(0, angle of v to the centre - t)): no member a can score more
than |a| times that, since its angle to v is at least the difference. Each member walks down this one
list, 256 rows at a time, until the bound of all that follows is below what it still needs.

Two walks are made. The first finds an anchor's positives, the best other rows of its label; it walks
the list's rows of that label alone. The second finds for each positive the best rows of other labels
whose score is in the window that the positive's score sets; a member needs no row below its lowest
window or below the last of the negatives that a window has full. What the shards find is merged by
anchor, or anchor and positive. A cell of a walk is a shard with a slab of the groups, as in
``pivot_index``.

Defined results: rows with a null label, and vectors that take no part, are left out; shorter vectors
as in ``vectors``; a row without ID is a candidate after all others of its score and never an anchor;
of repeated rows each is a row of its own; fewer positives or negatives than asked for are all
returned; an anchor without positives or negatives has no rows, and neither has an empty table.
Further columns are passed over. Labels are integers.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from riskloom.llm import vectors
from riskloom.llm.batches import by_shard, run_starts
from riskloom.session import fresh_folder

#: Anchors that the directions are found from, and how many there are at most.
SAMPLE = 2048
DIRECTIONS = 64
GROUP = 256
STEP = 256
#: Blocks of a shard, and groups of a slab.
SHARD_BLOCKS = 4
SLAB = 64
MOST_TASKS = 20_000

RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
_LOWEST, _HIGHEST = np.iinfo(np.int64).min, np.iinfo(np.int64).max


@dataclass(frozen=True)
class Mining:
    """Positives of an anchor, negatives of a positive, and the least and largest share, in hundredths,
    of the positive's score that a negative may have."""

    positives: int = 5
    negatives: int = 3
    least: int = 50
    most: int = 95

    def window(self, scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(lowest, highest) score of a negative for each score of a positive."""
        whole = scores.astype(object)
        low, high = -(-self.least * whole // 100), self.most * whole // 100
        return (np.clip(x, _LOWEST, _HIGHEST).astype(np.int64) for x in (low, high))


def directions(sample: np.ndarray, count: int = DIRECTIONS, rounds: int = 6) -> np.ndarray:
    """Unit vectors that the sample gathers about, by a few rounds of k-means over angles; one for about
    32 of the sample at most."""
    unit = _unit(sample)
    count = max(1, min(count, len(unit) // 32))
    centres = unit[np.linspace(0, len(unit) - 1, count).astype(int)].copy()
    for _ in range(rounds):
        at = (unit @ centres.T).argmax(axis=1)
        for c in np.unique(at):
            centres[c] = unit[at == c].sum(axis=0)
        centres = _unit(centres)
    return centres


def _unit(values: np.ndarray) -> np.ndarray:
    values = values.astype(np.float64)
    return values / np.maximum(vectors.norms(values), 1e-300)[:, None]


def _angles(values: np.ndarray, centre: np.ndarray) -> np.ndarray:
    dim = max(values.shape[1], centre.shape[1])
    cosines = (_unit(vectors.widened(values, dim)) @ vectors.widened(centre, dim).T)[:, 0]
    return np.arccos(np.clip(cosines, -1, 1))


class SharedList:
    """The rows of a shard in the order of their bound for any member of a group."""

    def __init__(self, shard: vectors.Shard, members: np.ndarray) -> None:
        centre = _unit(_unit(members).sum(axis=0, keepdims=True))
        # A little wider and larger than computed, so that rounding never hides a row.
        widest = _angles(members, centre).max() + 1e-6
        apart = np.maximum(_angles(shard.values, centre) - widest, 0)
        bound = shard.norms * np.cos(apart)
        self.order = np.argsort(-bound, kind="stable")
        self.bound = bound[self.order]
        self.shard = shard
        self.own = vectors.norms(members)
        dim = max(members.shape[1], shard.values.shape[1])
        kind = vectors.exact_type(float(self.own.max()), float(shard.norms.max(initial=0)))
        self.members = vectors.widened(vectors.typed(members, kind), dim)
        self.rows = vectors.widened(shard.typed(kind), dim)
        self.slack = 1e-9 * self.own * float(shard.norms.max(initial=0)) + 1e-3
        self.visited = 0

    def walk(self, best: vectors.Best, members: np.ndarray, order: np.ndarray, bound: np.ndarray, fits) -> None:
        """Offers the listed rows to the members until none of the rest can serve any. ``fits`` tells
        which pairs of members and rows may meet."""
        for low in range(0, len(order), STEP):
            need = best.least()[members]
            limit = self.own[members] * bound[low] + self.slack[members]
            members = members[limit >= need]
            if not len(members):
                return
            at = order[low : low + STEP]
            scores = vectors.products(self.members[members], self.rows[at])
            self.visited += scores.size
            hit = (scores >= best.least()[members][:, None]) & fits(members, at)
            row, column = np.nonzero(hit)
            best.offer(members[row], scores[row, column], self.shard.ids[at[column]], at[column])


def find_positives(shard: vectors.Shard, group: dict, mining: Mining) -> pa.RecordBatch:
    listed = SharedList(shard, group["values"])
    labels, numbers = group["labels"], group["numbers"]
    g = len(labels)
    best = vectors.Best(np.full((g, 1), _LOWEST), np.full((g, 1), _HIGHEST), mining.positives)
    in_order = shard.labels[listed.order]
    for label in np.unique(labels):
        same = in_order == label
        other = lambda members, at: shard.numbers[at] != numbers[members][:, None]
        listed.walk(best, np.flatnonzero(labels == label), listed.order[same], listed.bound[same], other)
    query, score, _, place = best.held[0]
    return pa.RecordBatch.from_arrays(
        [pa.array(numbers[query]), vectors.id_array(shard.ids[place], shard.has_id[place]), pa.array(score)],
        ["number", "found_id", "score"],
    )


def find_negatives(shard: vectors.Shard, group: dict, mining: Mining) -> pa.RecordBatch:
    listed = SharedList(shard, group["values"])
    labels, numbers, scores = group["labels"], group["numbers"], group["scores"]
    # An anchor with fewer positives has empty windows for the rest.
    given = np.array([s + [-1] * (mining.positives - len(s)) for s in scores], np.int64)
    low, high = mining.window(given)
    missing = np.arange(mining.positives) >= np.array([len(s) for s in scores])[:, None]
    low[missing], high[missing] = 1, 0
    best = vectors.Best(low, high, mining.negatives)
    other = lambda members, at: shard.labels[at] != labels[members][:, None]
    listed.walk(best, np.arange(len(labels)), listed.order, listed.bound, other)
    parts = []
    for j, (query, score, _, place) in enumerate(best.held):
        parts.append(
            pa.RecordBatch.from_arrays(
                [
                    pa.array(numbers[query]),
                    pa.array(np.full(len(query), j), pa.int32()),
                    vectors.id_array(shard.ids[place], shard.has_id[place]),
                    pa.array(score),
                ],
                ["number", "place", "found_id", "score"],
            )
        )
    return pa.Table.from_batches(parts).combine_chunks().to_batches(max_chunksize=None)


def _anchors(stored: DataFrame, centres: np.ndarray) -> DataFrame:
    """The anchors with their group's direction and their angle to it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in vectors.rows_of(batch):
                shard = vectors.Shard([row])
                at = np.flatnonzero(shard.wanted & shard.has_id)
                if not len(at):
                    continue
                dim = max(shard.values.shape[1], centres.shape[1])
                cosines = _unit(vectors.widened(shard.values[at], dim)) @ vectors.widened(centres, dim).T
                raws = [vectors.packed(shard.values[i : i + 1]) for i in at]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(shard.numbers[at]),
                        pa.array(shard.ids[at]),
                        pa.array(shard.labels[at]),
                        pa.array([r for r, _ in raws], pa.binary()),
                        pa.array([w for _, w in raws], pa.int32()),
                        pa.array(cosines.argmax(axis=1), pa.int32()),
                        pa.array(-cosines.max(axis=1)),
                    ],
                    ["number", "anchor_id", "label", "vector", "width", "direction", "angle"],
                )

    fields = "number long, anchor_id long, label long, vector binary, width int, direction int, angle double"
    return stored.mapInArrow(run, fields)


GROUPS = (
    "group long, numbers array<long>, members array<long>, scores array<array<long>>, vectors binary, dim int, width int"
)


def _groups(anchors: DataFrame, parts: int) -> DataFrame:
    """Anchors of one direction, ordered by angle, in groups of at most ``GROUP``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        made = TaskContext.get().partitionId() << 32
        waiting: list[dict] = []
        for batch in batches:
            waiting += vectors.rows_of(batch)
            done = 0
            edges = [*run_starts(np.array([r["direction"] for r in waiting])).tolist(), len(waiting)]
            for a, b in zip(edges, edges[1:]):
                for low in range(a, b, GROUP):
                    if b == len(waiting) and low + GROUP > b:
                        break  # may go on in the next batch
                    done = min(low + GROUP, b)
                    yield _group(waiting[low:done], made)
                    made += 1
            waiting = waiting[done:]
        if waiting:
            yield _group(waiting, made)

    ordered = anchors.repartitionByRange(parts, "direction", "angle", "number").sortWithinPartitions("direction", "angle")
    return ordered.mapInArrow(run, GROUPS)


def _group(rows: list[dict], number: int) -> pa.RecordBatch:
    each = [vectors.unpacked(r["vector"], 1, len(r["vector"]) // r["width"], r["width"]) for r in rows]
    values = vectors.stacked(each)
    raw, width = vectors.packed(values)
    long = pa.list_(pa.int64())
    row = [number, [r["number"] for r in rows], [r["label"] for r in rows], [r["scores"] for r in rows], raw, values.shape[1], width]
    kinds = [pa.int64(), long, long, pa.list_(long), pa.binary(), pa.int32(), pa.int32()]
    names = ["group", "numbers", "members", "scores", "vectors", "dim", "width"]
    return pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(row, kinds)], names)


def _walk(stored: DataFrame, anchors: DataFrame, shards: int, count: int, find, mining: Mining, fields: str) -> DataFrame:
    """What ``find`` finds for every group of the anchors in every shard."""
    groups_at_least = -(-count // GROUP)
    slabs = -(-groups_at_least // SLAB)
    cell = lambda shard, slab: shard * slabs + slab
    shard = F.pmod(F.xxhash64("block"), F.lit(shards))
    copies = F.explode(F.sequence(F.lit(0), F.lit(slabs - 1)))
    rows = stored.withColumn("slab", copies).withColumn("shard", cell(shard, F.col("slab"))).withColumn("kind", F.lit(0))
    groups = _groups(anchors, max(1, groups_at_least // 8)).withColumn("to", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    slab = F.pmod(F.xxhash64("group"), F.lit(slabs))
    groups = groups.withColumn("shard", cell(F.col("to"), slab)).withColumn("kind", F.lit(1)).drop("to")
    cells = rows.drop("slab").unionByName(groups, allowMissingColumns=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, at, held = [], None, None
        for batch in batches:
            for row in vectors.rows_of(batch):
                if row["shard"] != at:
                    parts, at, held = [], row["shard"], None
                if row["kind"] == 0:
                    parts.append(row)
                    continue
                if held is None:
                    if not parts:  # a shard that no block fell into
                        continue
                    held, parts = vectors.Shard(parts), []
                group = {
                    "values": vectors.unpacked(row["vectors"], len(row["numbers"]), row["dim"], row["width"]),
                    "numbers": np.array(row["numbers"], np.int64),
                    "labels": np.array(row["members"], np.int64),
                    "scores": row["scores"],
                }
                made = find(held, group, mining)
                yield from made if isinstance(made, list) else [made]

    return by_shard(cells, min(shards * slabs, MOST_TASKS), "shard", "kind", "block").mapInArrow(run, fields)


def _first(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc_nulls_last("found_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine(
    rows: DataFrame,
    anchors: Column,
    label: Column,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    mining: Mining = Mining(),
) -> DataFrame:
    """A row for each anchor, positive and negative: ``anchors`` tells which rows are anchors, ``label``
    is a row's class."""
    spark = rows.sparkSession
    labelled = rows.select(
        F.col(vec_id).cast("long").alias("v"), F.col(vector).alias("x"), F.coalesce(anchors, F.lit(False)).alias("w"), label.cast("long").alias("l")
    ).where(F.col("l").isNotNull() & F.col("x").isNotNull())
    sample = vectors.sample_vectors(labelled.where("w"), "v", "x", SAMPLE)
    if not len(sample):
        return spark.createDataFrame([], RESULT)
    path = fresh_folder(spark, "hard-negatives")
    made = vectors.blocks(labelled, F.col("v"), F.col("x"), F.col("w"), label=F.col("l"))
    made.write.parquet(f"{path}/blocks")
    stored = spark.read.parquet(f"{path}/blocks")
    shards = max(1, -(-stored.count() // SHARD_BLOCKS))
    _anchors(stored, directions(sample)).write.parquet(f"{path}/anchors")
    asked = spark.read.parquet(f"{path}/anchors")
    count = asked.count()
    unscored = asked.withColumn("scores", F.lit(None).cast("array<long>"))
    fields = "number long, found_id long, score long"
    near = _first(_walk(stored, unscored, shards, count, find_positives, mining, fields), ["number"], mining.positives)
    listed = F.sort_array(F.collect_list(F.struct("rank", "found_id", "score")))
    near.groupBy("number").agg(listed.alias("near")).write.parquet(f"{path}/positives")
    positives = spark.read.parquet(f"{path}/positives")
    scored = asked.join(positives, "number").withColumn("scores", F.col("near.score")).drop("near")
    fields = "number long, place int, found_id long, score long"
    far = _first(_walk(stored, scored, shards, count, find_negatives, mining, fields), ["number", "place"], mining.negatives)
    of = asked.select("number", "anchor_id").join(positives, "number")
    pair = F.col("near")[F.col("place")]
    return far.join(of, "number").select(
        "anchor_id",
        pair["found_id"].alias("positive_id"),
        "rank",
        F.col("found_id").alias("negative_id"),
        pair["score"].alias("positive_score"),
        F.col("score").alias("negative_score"),
    )
