"""SimHash near-duplicates by a Gray-order hierarchical index.

A fingerprint has a bit set where over half the hashes of the text's word shingles have it. Equal
fingerprints are one node. Two nodes link at ``max_bits`` or fewer differing bits; the groups are
the connected components.

Two fingerprints that differ in at most k bits agree on one of k + 1 parts of their bits, so nodes
are grouped by each part in turn. A group that is too large is parted again by the bits it does not
share yet, which keeps every link and bounds a group by the number of its free bits. Inside a
group the fingerprints are sorted by Gray rank; runs of eight form a node that holds the pattern of
the bits they share, eight nodes a higher one, and so on. A search goes down from the top with the
differences to each pattern, drops a whole node when they exceed k, and joins a whole node when even
its free bits cannot exceed k. What leaves a group is a link from each member to the root it found.

Defined results: a text without words, null or empty, has the fingerprint zero and links like any
other; a row without ID is grouped, and the component of a group without any ID is null; repeated
rows share a fingerprint; an empty table has no rows. Other columns are passed over.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from riskloom.llm.batches import free_name, ragged
from riskloom.session import fresh_folder

SHINGLE_WORDS = 3
MAX_BITS = 2
SEED = 42
GROUP_LIMIT = 4096
FANOUT = 8


def fingerprint(text: bytes, size: int = SHINGLE_WORDS, seed: int = SEED) -> int:
    """The fingerprint of a UTF-8 text, lower-casing A to Z."""
    from xxhash import xxh64_intdigest

    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    size = min(size, len(words))
    hashes = np.array(
        [
            xxh64_intdigest(joined[a:b], seed)
            for a, b in zip(starts[: len(words) - size + 1].tolist(), ends[size - 1 :].tolist())
        ],
        np.uint64,
    )
    counts = np.zeros(64, np.int64)
    for low in range(0, len(hashes), 65536):
        part = hashes[low : low + 65536].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    set_bits = np.flatnonzero(2 * counts > len(hashes)).tolist()
    return sum(1 << b for b in set_bits)


def fingerprints(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = SHINGLE_WORDS, seed: int = SEED
) -> DataFrame:
    """doc_id, text_key (a hash of the text) and fp, the fingerprint as a signed long."""
    kind = docs.schema[doc_id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.large_binary())
            values = [fingerprint(t.as_py() or b"", size, seed) for t in texts]
            fps = np.array(values, np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(fps)], ["doc_id", "text_key", "fp"]
            )

    keyed = docs.select(doc_id, text, F.xxhash64(text).alias("text_key"))
    return keyed.mapInArrow(run, f"doc_id {kind}, text_key long, fp long")


def gray_rank(values: np.ndarray) -> np.ndarray:
    """The place of each value in the order of the reflected binary code."""
    out = values.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        out ^= out >> np.uint64(shift)
    return out


def _parts(mask: int, count: int) -> list[int]:
    """Masks that part the bits not in ``mask`` into ``count`` sets of about the same size, each
    joined with ``mask``."""
    free = [b for b in range(64) if not mask >> b & 1]
    cuts = [len(free) * k // count for k in range(count + 1)]
    return [mask | sum(1 << b for b in free[a:b]) for a, b in zip(cuts, cuts[1:])]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _deal(rows: DataFrame, masks: Column) -> DataFrame:
    """Each fingerprint once for each mask, with the bits under it."""
    dealt = rows.select("fp", F.explode(masks).alias("mask"))
    return dealt.select("mask", F.col("fp").bitwiseAND(F.col("mask")).alias("bits"), "fp")


def _masks(values: list[int]) -> Column:
    return F.array(*[F.lit(_signed(m)) for m in values])


def groups(fps: DataFrame, max_bits: int = MAX_BITS, limit: int = GROUP_LIMIT) -> DataFrame:
    """mask, bits, fp: groups of distinct fingerprints such that every two of them within
    ``max_bits`` meet in a group.

    A group over the limit is parted again until its free bits alone keep it below the limit; each
    round is written to the shared folder.
    """
    spark = fps.sparkSession
    masks, small = _parts(0, max_bits + 1), []
    rows = _deal(fps, _masks(masks))
    while True:
        path = fresh_folder(spark, "simhash-dealt")
        rows.write.parquet(path)
        rows = spark.read.parquet(path)
        path = fresh_folder(spark, "simhash-groups")
        rows.groupBy("mask", "bits").agg(F.count("*").alias("n")).where("n > 1").write.parquet(path)
        sized = spark.read.parquet(path)
        small.append(rows.join(sized.where(F.col("n") <= limit), ["mask", "bits"]).drop("n"))
        large = sized.where(F.col("n") > limit).drop("n")
        if large.isEmpty():
            break
        finer = {m: [x for x in _parts(m, max_bits + 1) if x != m] for m in masks}
        choice = F.create_map(*[x for m, f in finer.items() for x in (F.lit(_signed(m)), _masks(f))])
        inside = rows.join(large, ["mask", "bits"])
        rows = _deal(inside, choice[F.col("mask")]).distinct()
        masks = sorted({x for f in finer.values() for x in f})
    out = small[0]
    for more in small[1:]:
        out = out.unionByName(more)
    return out


def _levels(fps: np.ndarray, firsts: np.ndarray, sizes: np.ndarray) -> list[dict[str, np.ndarray]]:
    """The index over sorted groups: level 0 is the fingerprints, a node of the next is a run of
    ``FANOUT`` nodes of one group, until each group has one node."""
    levels = [{"low": fps, "high": fps, "first": firsts, "size": sizes, "begin": np.arange(len(fps)), "count": np.ones(len(fps), np.int64)}]
    while (levels[-1]["size"] > 1).any():
        below = levels[-1]
        size = -(-below["size"] // FANOUT)
        first = np.concatenate(([0], np.cumsum(size)[:-1]))
        group = np.repeat(np.arange(len(size)), size)
        begin = below["first"][group] + FANOUT * (np.arange(int(size.sum())) - first[group])
        levels.append(
            {
                "low": np.bitwise_and.reduceat(below["low"], begin),
                "high": np.bitwise_or.reduceat(below["high"], begin),
                "first": first,
                "size": size,
                "begin": begin,
                "count": np.minimum(FANOUT, below["first"][group] + below["size"][group] - begin),
            }
        )
    return levels


def _find(parent: np.ndarray, nodes: np.ndarray) -> np.ndarray:
    roots = parent[nodes]
    while True:
        up = parent[roots]
        if np.array_equal(up, roots):
            return roots
        roots = up


def _union(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Joins a[i] with b[i]; the root is the lowest place."""
    while len(a):
        a, b = _find(parent, a), _find(parent, b)
        apart = a != b
        a, b = a[apart], b[apart]
        np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))
        parent[:] = parent[parent]


def link_groups(group: np.ndarray, fps: np.ndarray, max_bits: int, block: int = 4096) -> tuple[np.ndarray, np.ndarray]:
    """(fingerprint, root) for every member of a group that is linked to a lower place of it.

    ``group`` is sorted, and distinct fingerprints are sorted by Gray rank within it.
    """
    firsts = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
    sizes = np.diff(np.concatenate((firsts, [len(group)])))
    levels = _levels(fps, firsts, sizes)
    parent = np.arange(len(fps))
    number = np.repeat(np.arange(len(firsts)), sizes)
    top = len(levels) - 1
    for low in range(0, len(fps), block):
        asked = np.arange(low, min(low + block, len(fps)))
        nodes = levels[top]["first"][number[asked]]
        for level in range(top, -1, -1):
            here = levels[level]
            query, shared = fps[asked], ~(here["low"][nodes] ^ here["high"][nodes])
            differ = np.bitwise_count((query ^ here["low"][nodes]) & shared)
            loose = np.bitwise_count(~shared)
            near = differ <= max_bits
            if level == 0:
                _union(parent, asked[near], nodes[near])
                break
            whole = near & (differ + loose <= max_bits)
            if whole.any():
                # Every member is within reach: all of the node joins the one that asks.
                a, first = asked[whole], nodes[whole]
                for k in range(level, 0, -1):
                    sizes_k = levels[k]["count"][first]
                    a = np.repeat(a, sizes_k)
                    first = _expand(levels[k]["begin"][first], sizes_k)
                _union(parent, a, first)
            down = near & ~whole
            asked, nodes = asked[down], nodes[down]
            sizes_k = here["count"][nodes]
            asked, nodes = np.repeat(asked, sizes_k), _expand(here["begin"][nodes], sizes_k)
    roots = _find(parent, np.arange(len(fps)))
    moved = roots != np.arange(len(fps))
    return fps[moved], fps[roots[moved]]


def _expand(begin: np.ndarray, count: np.ndarray) -> np.ndarray:
    return ragged(begin, count) if len(begin) else begin


def links(fps: DataFrame, max_bits: int = MAX_BITS, limit: int = GROUP_LIMIT) -> DataFrame:
    """a, b: links of distinct fingerprints whose components are those of all pairs within
    ``max_bits``; a group gives at most one for each member."""
    dealt = groups(fps, max_bits, limit)
    key = F.xxhash64("mask", "bits").alias("key")
    sorted_groups = (
        dealt.select(key, "mask", "bits", "fp").repartition("key").sortWithinPartitions("key", "mask", "bits")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for batch in batches:
            rows = np.stack([batch.column(k).to_numpy() for k in (1, 2, 3)])
            held.append(rows)
            if sum(h.shape[1] for h in held) < 4 * limit:
                continue
            rows = np.concatenate(held, axis=1)
            same = (rows[0] == rows[0, -1]) & (rows[1] == rows[1, -1])
            last = rows.shape[1] if not same.any() else int(np.argmax(same))
            held = [rows[:, last:]]  # the last group may go on in the next batch
            if last:
                yield _linked(rows[:, :last], max_bits)
        if held and (rows := np.concatenate(held, axis=1)).shape[1]:
            yield _linked(rows, max_bits)

    return sorted_groups.mapInArrow(run, "a long, b long").distinct()


def _linked(rows: np.ndarray, max_bits: int) -> pa.RecordBatch:
    mask, bits, fps = rows[0], rows[1], np.ascontiguousarray(rows[2]).view(np.uint64)
    change = np.concatenate(([True], (mask[1:] != mask[:-1]) | (bits[1:] != bits[:-1])))
    group = np.cumsum(change)
    order = np.lexsort((gray_rank(fps), group))
    a, b = link_groups(group[order], fps[order], max_bits)
    return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])


def components(edges: DataFrame) -> DataFrame:
    """node, root for the nodes of undirected links (a, b): the lowest node of the component.

    Large-star and small-star steps in turn; each round is written to the shared folder, and the
    rounds end when the links no longer change.
    """
    spark = edges.sparkSession
    path = fresh_folder(spark, "simhash-links")
    edges.where("a <> b").select("a", "b").write.parquet(path)
    now = spark.read.parquet(path)
    before = None
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        # Large star: neighbours above a node link to the lowest node around it.
        large = both.join(lowest, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        # Small star: neighbours below a node, and the node, link to the lowest of them.
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = down.groupBy("a").agg(F.min("b").alias("m"))
        small = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = small.unionByName(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct()
        path = fresh_folder(spark, "simhash-links")
        small.write.parquet(path)
        now = spark.read.parquet(path)
        state = tuple(
            now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).head()
        )
        if state == before:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = state


def _grouped(docs: DataFrame, doc_id: str, text: str, max_bits: int, **options) -> DataFrame:
    """doc_id, text_key, fp and root, the lowest fingerprint of the component."""
    spark = docs.sparkSession
    path = fresh_folder(spark, "fingerprints")
    fingerprints(docs, doc_id, text, **options).write.parquet(path)
    marked = spark.read.parquet(path)
    linked = components(links(marked.select("fp").distinct(), max_bits))
    joined = marked.join(linked, marked["fp"] == linked["node"], "left")
    return joined.select("doc_id", "text_key", "fp", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", max_bits: int = MAX_BITS, **options) -> DataFrame:
    """doc_id, fp (signed long) and component_id, the lowest ID of the component."""
    found = _grouped(docs, doc_id, text, max_bits, **options)
    lowest = found.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    return found.join(lowest, "root").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", max_bits: int = MAX_BITS, **options) -> DataFrame:
    """One document of each component: that with the lowest ID, one without ID only where no other
    is. Rows that repeat both ID and text are one document."""
    found = _grouped(docs, doc_id, text, max_bits, **options)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")).alias("first")
    kept = found.groupBy("root").agg(first).select("first.doc_id", "first.text_key")
    key = free_name(docs.columns, "riskloom_text_key")
    keyed = docs.withColumn(key, F.xxhash64(text))
    same = keyed[doc_id].eqNullSafe(kept["doc_id"]) & (keyed[key] == kept["text_key"])
    return keyed.join(kept, same, "left_semi").dropDuplicates([doc_id, key]).select(*docs.columns)
