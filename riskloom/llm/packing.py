"""Best-fit packing of tokenised documents into sequences of fixed capacity.

Texts are tokenised with a public tokenizer's file and closed with an end token. Only a document
longer than a sequence is cut, into pieces of full capacity, the first of which takes the rest.
Full pieces are sequences of their own. The others are packed online by bounded-space best-fit: a
fixed number of bins is open, a bitset over free space finds the fullest bin that still takes a
piece, and when no open bin does and all are taken, the fullest closes.

Tokenising and packing are separate jobs: the pieces' sizes are written first, then dealt to as
many packing tasks as there are pieces for, so that half-filled bins at the end of a task stay
rare at any size.

Defined results: a null or empty text is the end token alone; repeated rows are packed each on
their own; an empty table has no pieces; columns other than the ID and the text are passed over.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from riskloom.llm.batches import HashSlots, chunk_starts, free_memory, hash_slices, ragged, text_groups
from riskloom.session import fresh_folder

CAPACITY = 1024
END_ID = 2
OPEN_BINS = 512
PIECES_PER_TASK = 200_000
#: Distinct chunks that a task keeps the IDs of.
KNOWN_CHUNKS = 1 << 20
GROUP_BYTES = 2 << 20
JOINED = 512

PIECES = "doc_id {id}, piece int, start long, length long, ids_crc32 long"


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    """The tokenizer and the number of bytes of each token, once for each Python process; nothing of the
    texts stays in it."""
    # Its own threads would add to those of the executor.
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    # A token of the byte-level vocabulary has a character for each byte.
    special = {k: t.content for k, t in tokenizer.get_added_tokens_decoder().items()}
    names = tokenizer.get_vocab(with_added_tokens=True)
    bytes_of = np.zeros(max(names.values()) + 1, np.int64)
    for name, k in names.items():
        bytes_of[k] = len(special[k].encode()) if k in special else len(name)
    return tokenizer, bytes_of


class ChunkTokenizer:
    """Token IDs of whole texts, tokenising each distinct chunk once.

    A text is cut before every single blank between two characters that are no white space. The
    tokenizer's own splitting starts anew at such a blank, so the IDs of the chunks, one after the
    other, are those of the text. What was seen is kept up to a fixed number of chunks, for one task.
    """

    def __init__(self, path: str) -> None:
        self.tokenizer, self.bytes_of = _tokenizer(path)
        self._forget()

    def _forget(self) -> None:
        self.slots = HashSlots(KNOWN_CHUNKS.bit_length())
        self.n = self.used = 0
        self.starts = np.zeros(KNOWN_CHUNKS, np.int32)
        self.lengths = np.zeros(KNOWN_CHUNKS, np.int32)
        self.ids = np.zeros(4 * KNOWN_CHUNKS, np.uint32)

    def _learn(self, keys: np.ndarray, chunks: list[bytes], joinable: np.ndarray) -> None:
        """Tokenises new chunks. Those that begin and end within a text are tokenised as one text,
        some hundred at a time, and taken apart by the bytes of their tokens."""
        alone, joined = np.flatnonzero(~joinable).tolist(), np.flatnonzero(joinable).tolist()
        groups = [[k] for k in alone] + [joined[low : low + JOINED] for low in range(0, len(joined), JOINED)]
        lengths, flat = np.zeros(len(chunks), np.int64), []
        order = np.array([k for g in groups for k in g], np.int64)
        for low in range(0, len(groups), 256):
            part = groups[low : low + 256]
            texts = [b"".join([chunks[k] for k in g]).decode() for g in part]
            for g, encoded in zip(part, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)):
                ids = np.array(encoded.ids, np.uint32)
                edges = np.cumsum(self.bytes_of[ids])
                ends = np.searchsorted(edges, np.cumsum([len(chunks[k]) for k in g]), "left") + 1
                lengths[g] = np.diff(ends, prepend=0) if len(g) > 1 else len(ids)
                flat.append(ids)
        flat = np.concatenate(flat)
        n, used = self.n + len(keys), self.used + len(flat)
        if n > len(self.starts):
            more = n - len(self.starts)
            self.starts, self.lengths = (np.concatenate((x, np.zeros(more, np.int32))) for x in (self.starts, self.lengths))
        if used > len(self.ids):
            self.ids = np.concatenate((self.ids, np.zeros(used - len(self.ids), np.uint32)))
        lengths = lengths[order]
        self.lengths[self.n : n] = lengths
        self.starts[self.n : n] = self.used + np.cumsum(lengths) - lengths
        self.ids[self.used : used] = flat
        self.slots.add(keys[order], np.arange(self.n, n, dtype=np.int32))
        self.n, self.used = n, used

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(IDs of all texts, number of IDs of each text)."""
        texts = len(offsets) - 1
        starts = chunk_starts(data, offsets)
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(texts, np.int64)
        ends = np.concatenate((starts[1:], offsets[-1:]))
        keys = hash_slices(data, starts, ends)
        slot = self.slots.find(keys)
        if (slot < 0).any():
            new = _distinct_places(keys, slot < 0)
            if self.n + len(new) > KNOWN_CHUNKS:
                self._forget()
                new = _distinct_places(keys, np.ones(len(keys), bool))
                if 2 * len(new) > len(self.slots.keys):
                    self.slots = HashSlots((4 * len(new)).bit_length())
            raw = data.tobytes()
            inside = ~np.isin(starts[new], offsets) & ~np.isin(ends[new], offsets)
            self._learn(keys[new], [raw[a:b] for a, b in zip(starts[new].tolist(), ends[new].tolist())], inside)
            slot = self.slots.find(keys)
        lengths = self.lengths[slot]
        firsts = np.searchsorted(starts, offsets)
        total = np.concatenate(([0], np.cumsum(lengths, dtype=np.int64)))
        return self.ids[ragged(self.starts[slot], lengths)], np.diff(total[firsts])


def _distinct_places(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """The first place of each distinct key among those wanted."""
    at = np.flatnonzero(wanted)
    return at[np.unique(keys[at], return_index=True)[1]]


def cut(length: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document."""
    if length <= capacity:
        return [(0, length)]
    rest = length % capacity
    pieces = [(0, rest)] if rest else []
    return pieces + [(start, capacity) for start in range(rest, length, capacity)]


def tokenized(
    docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text", end_id: int = END_ID
) -> DataFrame:
    """doc_id and ids, the document's token IDs with the end token."""
    kind = docs.schema[doc_id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks = ChunkTokenizer(tokenizer)
        for batch in batches:
            for first, last, ids, bounds in _documents(chunks, batch.column(1), end_id):
                lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids.view(np.int32)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, last - first), lists], ["doc_id", "ids"]
                )

    return docs.select(doc_id, text).mapInArrow(run, f"doc_id {kind}, ids array<int>")


def _documents(chunks: ChunkTokenizer, column: pa.Array, end_id: int):
    """(first row, row after the last, IDs, bounds) with the end token after each document."""
    for first, last, data, offsets in text_groups(column, GROUP_BYTES):
        ids, sizes = chunks.encode(data, offsets)
        bounds = np.concatenate(([0], np.cumsum(sizes + 1)))
        out = np.empty(bounds[-1], np.uint32)
        closing = np.zeros(len(out), bool)
        closing[bounds[1:] - 1] = True
        out[closing] = end_id
        out[~closing] = ids
        yield first, last, out, bounds


def pieces(
    docs: DataFrame,
    tokenizer: str,
    doc_id: str = "doc_id",
    text: str = "text",
    end_id: int = END_ID,
    capacity: int = CAPACITY,
) -> DataFrame:
    """doc_id, piece, start, length and the checksum of the piece's token IDs."""
    kind = docs.schema[doc_id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks = ChunkTokenizer(tokenizer)
        for batch in batches:
            for first, last, ids, bounds in _documents(chunks, batch.column(1), end_id):
                raw = memoryview(ids.astype("<u4").tobytes())
                rows, numbers, starts, lengths, sums = [], [], [], [], []
                edges = bounds.tolist()
                for r in range(last - first):
                    low = edges[r]
                    for k, (start, length) in enumerate(cut(edges[r + 1] - low, capacity)):
                        rows.append(first + r)
                        numbers.append(k)
                        starts.append(start)
                        lengths.append(length)
                        sums.append(zlib.crc32(raw[4 * (low + start) : 4 * (low + start + length)]))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(rows, pa.int64())),
                        pa.array(numbers, pa.int32()),
                        pa.array(starts, pa.int64()),
                        pa.array(lengths, pa.int64()),
                        pa.array(sums, pa.int64()),
                    ],
                    ["doc_id", "piece", "start", "length", "ids_crc32"],
                )
        del chunks
        free_memory()

    return docs.select(doc_id, text).mapInArrow(run, PIECES.format(id=kind))


class OpenBins:
    """At most ``limit`` open bins; a bit of ``free`` is set where a bin has that much space left."""

    def __init__(self, capacity: int, limit: int) -> None:
        self.capacity, self.limit = capacity, limit
        self.free = 0
        self.by_free: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.open = 0
        self.made = 0

    def put(self, length: int) -> tuple[int, int]:
        """(bin, offset) for a piece of at most the capacity."""
        if length == self.capacity:  # needs no open bin
            self.made += 1
            return self.made - 1, 0
        wide = self.free >> length
        if wide:
            space = length + ((wide & -wide).bit_length() - 1)  # the fullest bin that takes it
            at = self._take(space)
        else:
            if self.open == self.limit:
                self._take((self.free & -self.free).bit_length() - 1)  # the fullest closes
            space, at = self.capacity, self.made
            self.made += 1
        if space > length:
            left = space - length
            self.by_free[left].append(at)
            self.free |= 1 << left
            self.open += 1
        return at, self.capacity - space

    def _take(self, space: int) -> int:
        bins = self.by_free[space]
        at = bins.pop()
        self.open -= 1
        if not bins:
            self.free ^= 1 << space
        return at


def pack(
    sized: DataFrame, capacity: int = CAPACITY, open_bins: int = OPEN_BINS, tasks: int | None = None
) -> DataFrame:
    """Adds sequence_id and offset to pieces with a ``length`` of at most the capacity.

    A sequence number joins the task's number and the bin's, so tasks need not know each other.
    ``tasks`` is one for every 200,000 pieces unless given.
    """
    if tasks is None:
        tasks = -(-sized.count() // PIECES_PER_TASK)
    names = sized.columns
    k = names.index("length")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        base = TaskContext.get().partitionId() << 40
        bins = OpenBins(capacity, open_bins)
        for batch in batches:
            placed = [bins.put(n) for n in batch.column(k).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns,
                    pa.array([base + at for at, _ in placed], pa.int64()),
                    pa.array([offset for _, offset in placed], pa.int64()),
                ],
                [*names, "sequence_id", "offset"],
            )

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in sized.schema)
    dealt = sized.repartition(max(1, tasks))
    return dealt.mapInArrow(run, f"{fields}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer: str, **options) -> DataFrame:
    """Pieces of the documents with their sequence and place. The pieces, without their IDs, are
    written to the shared folder, so that a lost executor does not cost tokenising anew."""
    spark = docs.sparkSession
    path = fresh_folder(spark, "pieces")
    pieces(docs, tokenizer, **options).write.parquet(path)
    return pack(spark.read.parquet(path))


def sequences(docs: DataFrame, packed: DataFrame, tokenizer: str, **options) -> DataFrame:
    """sequence_id and ids: the packed sequences themselves, for documents with distinct IDs."""
    ids = tokenized(docs, tokenizer, **options)
    parts = packed.join(ids, "doc_id").select(
        "sequence_id",
        F.struct("offset", F.expr("slice(ids, int(start) + 1, int(length))").alias("ids")).alias("part"),
    )
    grouped = parts.groupBy("sequence_id").agg(F.sort_array(F.collect_list("part")).alias("parts"))
    return grouped.select("sequence_id", F.flatten(F.transform("parts", lambda p: p["ids"])).alias("ids"))


