"""Benchmark decontamination by a hash set of the benchmark's word n-grams.

Words are lower-cased (A to Z) runs of ASCII letters, digits and longer characters. A window is
``n`` consecutive words of a benchmark item; an item of fewer words, but not none, is one window.
The hashes of all windows form a broadcast set; each text's word windows are looked up in it, and
what is found is verified word by word.

Defined results: a null text or one without words has no hits; an item without words or text has no
window; an item without an ID is searched for but not listed; repeated rows are each judged on
their own; repeated items count once. Other columns are passed over by ``scan`` and kept by
``remove``. An empty benchmark leaves every document clean.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from riskloom.llm.batches import ALNUM, LOWER, free_name, hash_slices, mixed, ragged, run_starts, text_groups, words_of
from riskloom.session import fresh_folder, remove_folder

N_WORDS = 10
#: Text bytes of the benchmark in one broadcast set, which takes some fifty bytes a word. A larger
#: benchmark is searched block by block.
BLOCK_BYTES = 16 << 20
_Q = np.uint64(0x9FB21C651E98DF25)
_TABLE_BITS = 20


def _windows(hashes: np.ndarray, length: int) -> np.ndarray:
    """Hashes of all windows of ``length`` consecutive words."""
    count = len(hashes) - length + 1
    out = np.full(count, length, np.uint64)
    for j in range(length):
        out = out * _Q + hashes[j : j + count]
    return mixed(out)


def _words(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(padded lower-cased bytes, row, start and end of each word) of some texts."""
    raw = [(t or "").encode() for t in texts]
    offsets = np.cumsum([0, *map(len, raw)])
    lowered = LOWER[np.frombuffer(b"".join(raw) + bytes(8), np.uint8)]
    return lowered, *words_of(lowered, offsets, ALNUM)


@dataclass(frozen=True)
class Words:
    """Words of one or several texts: padded lower-cased bytes, where each begins and ends."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray

    def same(self, at: np.ndarray, other: Words, others: np.ndarray, length: int) -> np.ndarray:
        """Whether the ``length`` words from each place equal those of the other's place."""
        out = np.ones(len(at), bool)
        for j in range(length):
            a, b = self.starts[at + j], other.starts[others + j]
            sizes = self.ends[at + j] - a
            out &= sizes == other.ends[others + j] - b
            left = np.flatnonzero(out)
            differ = self.data[ragged(a[left], sizes[left])] != other.data[ragged(b[left], sizes[left])]
            out[np.repeat(left, sizes[left])[differ]] = False
        return out


@dataclass(frozen=True)
class Windows:
    """The distinct windows of one length, sorted by hash: where one of each begins among the words,
    and the items that hold it, from ``cuts[k]`` to ``cuts[k + 1]``."""

    keys: np.ndarray
    places: np.ndarray
    cuts: np.ndarray
    items: np.ndarray
    table: np.ndarray


@dataclass(frozen=True)
class WindowSet:
    """The searchable windows of some items, by length; the words are held once, hashes and places
    as arrays."""

    words: Words
    names: list[str]
    by_length: dict[int, Windows]

    def nbytes(self) -> int:
        arrays = [self.words.data, self.words.starts, self.words.ends]
        for w in self.by_length.values():
            arrays += [w.keys, w.places, w.cuts, w.items, w.table]
        return sum(a.nbytes for a in arrays)


def window_set(items: list[tuple[Any, str | None]], n: int = N_WORDS) -> WindowSet:
    data, rows, starts, ends = _words([text for _, text in items])
    words = Words(data, starts, ends)
    names = sorted({str(item) for item, _ in items if item is not None})
    number = {name: k for k, name in enumerate(names)}
    of_row = np.array([-1 if item is None else number[str(item)] for item, _ in items], np.int32)
    counts = np.bincount(rows, minlength=len(items))
    firsts = np.cumsum(counts) - counts
    hashes = hash_slices(data, starts, ends)
    sizes = np.minimum(n, counts)
    by_length: dict[int, Windows] = {}
    for length in np.unique(sizes[sizes > 0]).tolist():
        own = np.flatnonzero(sizes == length)
        places = ragged(firsts[own], counts[own] - length + 1)
        by_length[length] = _distinct_windows(words, places, _windows(hashes, length)[places], of_row[rows[places]], length)
    return WindowSet(words, names, by_length)


def _distinct_windows(words: Words, places: np.ndarray, keys: np.ndarray, items: np.ndarray, length: int) -> Windows:
    order = np.argsort(keys, kind="stable")
    places, keys, items = places[order], keys[order], items[order]
    first = np.arange(len(keys))  # the first window of the same words
    todo = np.arange(len(keys))
    while len(todo):  # once more only for different windows of one hash
        begins = run_starts(keys[todo])
        leader = todo[np.repeat(begins, np.diff(np.append(begins, len(todo))))]
        equal = words.same(places[todo], words, places[leader], length)
        first[todo[equal]] = leader[equal]
        todo = todo[~equal]
    leaders, of = np.unique(first, return_inverse=True)
    pairs = np.unique(np.stack((of, items), axis=1)[items >= 0], axis=0)
    table = np.zeros(1 << _TABLE_BITS, bool)
    table[keys >> np.uint64(64 - _TABLE_BITS)] = True
    return Windows(keys[leaders], places[leaders], np.searchsorted(pairs[:, 0], np.arange(len(leaders) + 1)), pairs[:, 1], table)


def _hits(data: np.ndarray, offsets: np.ndarray, windows: WindowSet):
    """(words per row, row of each word, hit flag of each word, items per row)."""
    lowered = LOWER[data]
    rows, starts, ends = words_of(lowered, offsets, ALNUM)
    words = Words(lowered, starts, ends)
    n_words = np.bincount(rows, minlength=len(offsets) - 1)
    delta = np.zeros(len(rows) + 1, np.int64)
    items: dict[int, set[str]] = {}
    hashes = hash_slices(lowered, starts, ends)
    for length, part in windows.by_length.items():
        if len(rows) < length:
            continue
        keys = _windows(hashes, length)
        likely = part.table[keys >> np.uint64(64 - _TABLE_BITS)]
        likely &= rows[: len(keys)] == rows[length - 1 :]
        at = np.flatnonzero(likely)
        slot, last = (np.searchsorted(part.keys, keys[at], side) for side in ("left", "right"))
        while len(at):  # more than once only for different windows of one hash
            found = slot < last
            at, slot, last = at[found], slot[found], last[found]
            same = words.same(at, windows.words, part.places[slot], length)
            delta[at[same]] += 1
            delta[at[same] + length] -= 1
            for row, k in np.unique(np.stack((rows[at[same]], slot[same]), axis=1), axis=0).tolist():
                held = part.items[part.cuts[k] : part.cuts[k + 1]].tolist()
                items.setdefault(row, set()).update(windows.names[x] for x in held)
            at, slot, last = at[~same], slot[~same] + 1, last[~same]
    return n_words, rows, np.cumsum(delta)[:-1] > 0, items


def _pieces(limit: int, n: int = N_WORDS):
    """Cuts an item's long text into pieces that hold all its windows and no other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                text = batch.column(1)[k].as_py()
                pieces = [text]
                if len(text) > limit:
                    data, _, starts, ends = _words([text])
                    low, pieces = 0, []
                    while low == 0 or low + n <= len(starts):
                        high = int(np.searchsorted(starts, starts[low] + limit)) if len(starts) else 0
                        high = max(high, low + 1)  # windows begin before it
                        stop = min(high + n - 1, len(starts))
                        pieces.append(b" ".join(data[a:b].tobytes() for a, b in zip(starts[low:stop].tolist(), ends[low:stop].tolist())).decode())
                        low = high
                yield pa.RecordBatch.from_arrays(
                    [pa.array([batch.column(0)[k].as_py()] * len(pieces), batch.schema.field(0).type), pa.array(pieces, pa.string())],
                    ["item", "text"],
                )

    return run


def _blocks(spark: SparkSession, benchmark: DataFrame, item: str, text: str, limit: int) -> Iterator[WindowSet]:
    """Window sets, one after the other, each of about ``limit`` bytes of distinct benchmark texts."""
    table = benchmark.select(F.col(item).alias("item"), F.col(text).alias("text")).where(F.length("text") > 0)
    table = table.mapInArrow(_pieces(max(1, limit // 16)), table.schema).distinct()
    path = fresh_folder(spark, "benchmark")
    table.write.parquet(path)
    table = spark.read.parquet(path)
    size = table.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).head()[0]
    count = max(1, -(-size // limit))
    for k in range(count):
        part = table.where(F.pmod(F.xxhash64("item", "text"), F.lit(count)) == k)
        yield window_set([(r[0], r[1]) for r in part.collect()])
    remove_folder(spark, path)


_FOUND = "n_words bigint, hits array<int>, items array<string>"


def scan(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item: str = "item_id",
    benchmark_text: str = "text",
    block_bytes: int = BLOCK_BYTES,
    name: str = "decontamination",
) -> DataFrame:
    """The documents' own columns and one more under ``name``, which it replaces: a struct of
    n_words, hits (positions of hit words) and items (IDs of the items with occurring windows,
    sorted as strings).

    A benchmark of one block is searched in the task that reads the documents. With more blocks, what
    has been found is written with the documents between two of them, so that drivers and tasks hold
    one block's set at a time and no text is shuffled; this function then runs all but the last.
    """
    spark = docs.sparkSession
    docs = docs.drop(name)
    out = docs.withColumn(name, F.lit(None).cast(f"struct<{_FOUND.replace(' ', ':').replace(',:', ',')}>"))
    schema, held, written = out.schema, None, None
    for windows in _blocks(spark, benchmark, item, benchmark_text, block_bytes):
        if held is not None:
            path = fresh_folder(spark, "decontamination")
            out.write.parquet(path)
            held.destroy()
            if written:
                remove_folder(spark, written)
            out, written = spark.read.parquet(path), path
        held = spark.sparkContext.broadcast(windows)
        out = out.mapInArrow(_scanner(held, text, name), schema)
    return out


def _scanner(windows: Any, text: str, name: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found_before = batch.column(batch.schema.get_field_index(name)).to_pylist()
            found: list[dict[str, Any]] = []
            for first, last, data, offsets in text_groups(batch.column(text)):
                n_words, rows, hit, items = _hits(data, offsets, windows.value)
                positions = np.flatnonzero(hit)
                firsts = np.concatenate(([0], np.cumsum(n_words)[:-1]))
                places = positions - firsts[rows[positions]]
                cuts = np.searchsorted(rows[positions], np.arange(last - first + 1))
                for r in range(last - first):
                    before = found_before[first + r] or {"hits": [], "items": []}
                    here = places[cuts[r] : cuts[r + 1]]
                    found.append(
                        {
                            "n_words": int(n_words[r]),
                            "hits": np.union1d(here, before["hits"]).astype(int).tolist()
                            if before["hits"]
                            else here.tolist(),
                            "items": sorted({*before["items"], *items.get(r, ())}),
                        }
                    )
            k = batch.schema.get_field_index(name)
            field = batch.schema.field(k)
            yield batch.set_column(k, field, pa.array(found, field.type))

    return run


def report(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", **options: Any) -> DataFrame:
    """Per document: n_words, n_hit, n_items, items_sha256 and contaminated."""
    found = scan(docs.select(doc_id, options.get("text", "text")), benchmark, **options)
    f = F.col("decontamination")
    return found.select(
        F.col(doc_id).alias("doc_id"),
        f["n_words"].alias("n_words"),
        F.size(f["hits"]).cast("long").alias("n_hit"),
        F.size(f["items"]).cast("long").alias("n_items"),
        F.sha2(F.array_join(f["items"], ","), 256).alias("items_sha256"),
        (F.size(f["hits"]) > 0).alias("contaminated"),
    )


def remove(docs: DataFrame, benchmark: DataFrame, **options: Any) -> DataFrame:
    """The documents without those that hold a window of the benchmark."""
    name = free_name(docs.columns, "decontamination")
    found = scan(docs, benchmark, name=name, **options)
    return found.where(F.size(F.col(name)["hits"]) == 0).select(*docs.columns)


def remove_spans(docs: DataFrame, benchmark: DataFrame, text: str = "text", **options: Any) -> DataFrame:
    """All documents, their text without the hit words; what stood before, between and after stays."""
    name = free_name(docs.columns, "decontamination")
    found = scan(docs, benchmark, text=text, name=name, **options)
    schema = docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(text).to_pylist()
            hits = batch.column(name).field("hits").to_pylist()
            batch = batch.drop_columns([name])
            for r, places in enumerate(hits):
                if places:
                    texts[r] = _without(texts[r], places)
            k = batch.schema.get_field_index(text)
            yield batch.set_column(k, batch.schema.field(k), pa.array(texts, batch.schema.field(k).type))

    return found.mapInArrow(run, schema)


def _without(text: str, places: list[int]) -> str:
    raw = text.encode()
    data = np.frombuffer(raw + bytes(8), np.uint8)
    _, starts, ends = words_of(data, np.array([0, len(raw)]), ALNUM)
    keep = np.ones(len(raw), bool)
    for p in places:
        keep[starts[p] : ends[p]] = False
    return data[: len(raw)][keep].tobytes().decode()


def items_digest(items: list[str]) -> str:
    """What ``items_sha256`` holds."""
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
