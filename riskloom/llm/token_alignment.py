"""Alignment of the tokens that two tokenizers make of the same bytes.

Where a token of both ends, the bytes are cut: what lies between two cuts is a group, the smallest
stretch that both tokenizers agree on. Tokens of the two whose bytes overlap are linked. How many
documents hold a pair of IDs linked, and with which ID of B an ID of A is linked in most documents,
is counted over the corpus and given back to each document.

Texts up to ``RANGE`` bytes are aligned by batches. A longer one is cut into windows that are dealt to
tasks. The tokens of a window fall into byte ranges of ``RANGE`` by where they end, and each range
becomes a fragment: an open prefix, the tokens up to the first common end in it; closed groups; and an
open suffix, the tokens after the last one. Fragments are a monoid. Two compose by joining the suffix
of the left with the prefix of the right, which closes one more group if both have a common end, and
lengthens an open part if not; an empty fragment changes nothing. Composition is associative, so the
fragments of a document are reduced by a tree, 16 to a node, of which only the open parts and the
groups closed on the way travel; closed groups stay where they were made, and their sums are added.
No task holds a whole long document, but for one run of text without a safe cut, which the
tokenizers need whole, and the digest, which reads the groups in order piece by piece.

Both tokenizers cut before a single blank between two characters that are no white space, so texts
are cut there and each distinct chunk of a batch is tokenised and aligned once.

Defined results: a null or empty text, and one whose tokens of A or B do not spell a blank and the
text, has no tokens, zeros and an empty digest; repeated rows are documents of their own, also in the
counts; a row without ID is kept; an empty table has no rows; further columns are passed over.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from riskloom.llm.batches import chunk_starts, hash_slices, ragged, text_groups
from riskloom.llm.vectors import rows_of
from riskloom.session import fresh_folder

RANGE = 32 << 10
FANOUT_BITS = 4
JOINED = 512
#: Windows of a task that tokenises them.
TASK_WINDOWS = 128

NUMBERS = ["n_a", "n_b", "n_groups", "n_links"]
_LONGS = pa.list_(pa.int64())


@dataclass
class Tokens:
    """IDs and ends of both tokenizers' tokens over the same bytes. Ends rise; a token starts where the
    one before it ends."""

    a: np.ndarray
    a_end: np.ndarray
    b: np.ndarray
    b_end: np.ndarray

    def part(self, a: slice, b: slice) -> Tokens:
        return Tokens(self.a[a], self.a_end[a], self.b[b], self.b_end[b])

    def __add__(self, other: Tokens) -> Tokens:
        return Tokens(
            np.concatenate((self.a, other.a)),
            np.concatenate((self.a_end, other.a_end)),
            np.concatenate((self.b, other.b)),
            np.concatenate((self.b_end, other.b_end)),
        )

    def lists(self) -> list[list[int]]:
        return [x.tolist() for x in (self.a, self.a_end, self.b, self.b_end)]

    @staticmethod
    def of(lists) -> Tokens:
        return Tokens(*(np.array(x, np.int64) for x in lists))


def none() -> Tokens:
    return Tokens.of([[]] * 4)


def _meeting(t: Tokens) -> tuple[np.ndarray, np.ndarray]:
    """(number of tokens of B that end before each token of A does, whether one ends with it)."""
    at = np.searchsorted(t.b_end, t.a_end)
    ends = np.zeros(len(at), bool)
    inside = at < len(t.b_end)
    ends[inside] = t.b_end[at[inside]] == t.a_end[inside]
    return at, ends


class Aligned:
    """Groups and links of tokens that begin and end with a common end."""

    def __init__(self, tokens: Tokens) -> None:
        t = tokens
        self.tokens = t
        # For each token of A: the token of B that holds its last byte, and whether both end there.
        at, ends = _meeting(t)
        self.cuts = t.a_end[ends]
        of_b = np.zeros(len(t.b), bool)
        of_b[at[ends]] = True
        self.group = [np.cumsum(x) - x for x in (ends, of_b)]
        first = np.concatenate(([0], at[:-1] + ends[:-1])) if len(at) else at
        counts = at + 1 - first
        of_a = np.repeat(np.arange(len(t.a)), counts)
        self.pairs = t.a[of_a] << 32 | t.b[ragged(first, counts)]
        self.pair_end = t.a_end[of_a]

    def text(self) -> tuple[str, np.ndarray]:
        """(the groups as text, each closed by ``;``, end of each group in it)."""
        t = self.tokens
        group = np.concatenate(self.group)
        if not len(group):
            return "", np.zeros(0, np.int64)
        of_b = np.repeat([0, 1], [len(t.a), len(t.b)])
        ids = np.concatenate((t.a, t.b))
        order = np.argsort(2 * group + of_b, kind="stable")
        ids, group, of_b = ids[order], group[order], of_b[order]
        closes = np.append(group[1:] != group[:-1], True)
        turns = np.append(of_b[1:] != of_b[:-1], False)
        numbers, place = np.unique(ids, return_inverse=True)
        named = np.array([f"{n}{mark}" for mark in ",|;" for n in numbers.tolist()], object)
        parts = named[place + len(numbers) * np.where(closes, 2, np.where(turns, 1, 0))].tolist()
        lengths = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)))
        return "".join(parts), lengths[closes]


class Spelling:
    """The bytes of each token of a vocabulary."""

    def __init__(self, tokens: list[bytes]) -> None:
        self.lengths = np.array([len(t) for t in tokens], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.data = np.frombuffer(b"".join(tokens), np.uint8)

    def spell(self, ids: np.ndarray) -> np.ndarray:
        return self.data[ragged(self.starts[ids], self.lengths[ids])]


def _byte_of_sign() -> dict[str, int]:
    """Byte-level vocabularies write a printable Latin-1 byte as itself, and the others, in order, as the
    characters from U+0100 on."""
    own = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b <= 0xFF]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(0x100 + k): b for k, b in enumerate(rest)}


class TokenizerPair:
    """A byte-level tokenizer and a piece tokenizer, and the tokens of both for whole texts, which begin
    with a blank that the second adds by itself."""

    def __init__(self, byte_level: str, pieces: str) -> None:
        # Their own threads would add to those of the executor.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.byte_level = Tokenizer.from_file(byte_level)
        self.byte_level.encode_special_tokens = True
        signs = _byte_of_sign()
        names = self.byte_level.get_vocab(with_added_tokens=True)
        spelled = [b""] * (max(names.values()) + 1)
        for name, k in names.items():
            if all(c in signs for c in name):
                spelled[k] = bytes(signs[c] for c in name)
        self.spell_a = Spelling(spelled)
        self.pieces = SentencePieceProcessor(model_file=pieces)
        spelled = []
        for k in range(self.pieces.get_piece_size()):
            name = self.pieces.id_to_piece(k)
            if self.pieces.is_byte(k):
                spelled.append(bytes([int(name[3:5], 16)]))
            else:
                ruled = self.pieces.is_control(k) or self.pieces.is_unknown(k)
                spelled.append(b"" if ruled else name.replace("▁", " ").encode())
        self.spell_b = Spelling(spelled)
        # A piece with a blank after another character could reach over a cut.
        self.cuttable = not any(" " in s.decode(errors="replace").lstrip(" ") for s in spelled)

    def chunk_starts(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Where texts can be cut without a change to any token."""
        return chunk_starts(data, offsets) if self.cuttable else offsets[:-1][offsets[:-1] < offsets[1:]]

    def encode(self, texts: list[bytes]) -> list[tuple[np.ndarray, np.ndarray] | None]:
        """The IDs of both for each text, or None where they do not spell it."""
        strings = [t.decode("utf-8", "replace") for t in texts]
        of_a = self.byte_level.encode_batch_fast(strings, add_special_tokens=False)
        of_b = self.pieces.encode([s[1:] for s in strings], num_threads=1)
        out = []
        for text, a, b in zip(texts, of_a, of_b):
            a, b = np.array(a.ids, np.int64), np.array(b, np.int64)
            same = self.spell_a.spell(a).tobytes() == text == self.spell_b.spell(b).tobytes()
            out.append((a, b) if same else None)
        return out

    def tokens(self, chunks: list[bytes], joinable: np.ndarray) -> tuple[Tokens, np.ndarray, np.ndarray]:
        """(tokens of all chunks one after the other, which chunks are spelled rightly, where each starts).
        Those that begin and end within a text are tokenised some hundred at a time. A wrong chunk has no
        tokens, but its bytes count in the ends."""
        at = np.flatnonzero(joinable).tolist()
        sets = [at[low : low + JOINED] for low in range(0, len(at), JOINED)]
        sets += [[k] for k in np.flatnonzero(~joinable).tolist()]
        order = np.array([k for s in sets for k in s], np.int64)
        sizes = np.array([len(chunks[k]) for k in order.tolist()], np.int64)
        starts = np.cumsum(sizes) - sizes
        right = np.ones(len(chunks), bool)
        parts, done = [none()], 0
        for low in range(0, len(sets), 64):
            some = sets[low : low + 64]
            made = self.encode([b"".join([chunks[k] for k in s]) for s in some])
            for s, ids in zip(some, made):
                singles = [(s, ids)]
                if ids is None and len(s) > 1:
                    singles = list(zip([[k] for k in s], self.encode([chunks[k] for k in s])))
                for own, ids in singles:
                    if ids is None:
                        right[own] = False
                    else:
                        a, b = ids
                        ends = (np.cumsum(t.lengths[x]) + starts[done] for t, x in ((self.spell_a, a), (self.spell_b, b)))
                        parts.append(Tokens(a, next(ends), b, next(ends)))
                    done += len(own)
        joined = [np.concatenate(x) for x in zip(*((p.a, p.a_end, p.b, p.b_end) for p in parts))]
        place = np.empty(len(chunks), np.int64)
        place[order] = starts
        return Tokens(*joined), right, place


@lru_cache(maxsize=2)
def tokenizer_pair(byte_level: str, pieces: str) -> TokenizerPair:
    """One for each Python process; it keeps vocabularies and nothing of the texts."""
    return TokenizerPair(byte_level, pieces)


class Batch:
    """Texts with the tokens of each distinct chunk: which chunk stands where, and which texts are right."""

    def __init__(self, pair: TokenizerPair, data: np.ndarray, offsets: np.ndarray) -> None:
        self.offsets = offsets
        self.starts = pair.chunk_starts(data, offsets)
        ends = np.append(self.starts[1:], offsets[-1]) if len(self.starts) else self.starts
        keys = hash_slices(data, self.starts, ends)
        _, new, self.chunk = np.unique(keys, return_index=True, return_inverse=True)
        raw = data.tobytes()
        chunks = [raw[x:y] for x, y in zip(self.starts[new].tolist(), ends[new].tolist())]
        inside = ~np.isin(self.starts[new], offsets) & ~np.isin(ends[new], offsets)
        self.stream, right, self.chunk_start = pair.tokens(chunks, inside)
        self.chunk_size = (ends - self.starts)[new]
        self.row = np.searchsorted(offsets, self.starts, "right") - 1
        wrong = self.row[~right[self.chunk]]
        self.right = offsets[:-1] < offsets[1:]
        self.right[wrong] = False
        self.held = None

    def slices(self, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(first, count) in a sorted array of ends for each distinct chunk."""
        low = np.searchsorted(ends, self.chunk_start, "right")
        return low, np.searchsorted(ends, self.chunk_start + self.chunk_size, "right") - low

    def _bounds(self) -> list[tuple[np.ndarray, np.ndarray]]:
        if self.held is None:
            self.held = [self.slices(e) for e in (self.stream.a_end, self.stream.b_end)]
        return self.held

    def tokens_of(self, row: int) -> Tokens:
        """The tokens of one text, by the bytes of the text."""
        at = np.arange(*np.searchsorted(self.row, [row, row + 1]))
        chunk = self.chunk[at]
        shift = self.starts[at] - self.offsets[row] - self.chunk_start[chunk]
        lists = []
        for ids, ends, (low, count) in zip(
            (self.stream.a, self.stream.b), (self.stream.a_end, self.stream.b_end), self._bounds()
        ):
            taken = ragged(low[chunk], count[chunk])
            lists += [ids[taken], ends[taken] + np.repeat(shift, count[chunk])]
        return Tokens(*lists)


# --- texts of at most one range ---

BLOCK = (
    "block long, doc_id array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, "
    "digest array<string>, bounds array<int>, at array<int>, times array<int>, pairs array<long>, docs array<long>"
)


def _block(pair: TokenizerPair, number: int, ids: pa.Array, data: np.ndarray, offsets: np.ndarray) -> pa.RecordBatch:
    batch = Batch(pair, data, offsets)
    rows = len(offsets) - 1
    aligned = Aligned(batch.stream)
    text, text_ends = aligned.text()
    stream = batch.stream
    slices = [batch.slices(e) for e in (stream.a_end, stream.b_end, aligned.cuts, aligned.pair_end)]
    used = batch.right[batch.row]
    sums = [
        np.bincount(batch.row[used], weights=count[batch.chunk[used]], minlength=rows).astype(np.int64)
        for _, count in slices
    ]
    first, count = slices[2]
    edges = np.concatenate(([0], text_ends))
    texts = [text[x:y] for x, y in zip(edges[first].tolist(), edges[first + count].tolist())]
    bounds = np.searchsorted(batch.row, np.arange(rows + 1)).tolist()
    listed, digests = batch.chunk.tolist(), []
    for r in range(rows):
        groups = "".join([texts[k] for k in listed[bounds[r] : bounds[r + 1]]])[:-1] if batch.right[r] else ""
        digests.append(hashlib.sha256(groups.encode()).hexdigest() if groups else "")
    # Links of each document: first by its distinct chunks, then by pair of IDs.
    key, times = np.unique(batch.row[used] * max(1, len(texts)) + batch.chunk[used], return_counts=True)
    row, chunk = np.divmod(key, max(1, len(texts)))
    first, count = slices[3]
    pairs, place = np.unique(aligned.pairs, return_inverse=True)
    linked = place[ragged(first[chunk], count[chunk])]
    key = np.repeat(row, count[chunk]) * max(1, len(pairs)) + linked
    key, inverse = np.unique(key, return_inverse=True)
    weight = np.bincount(inverse, weights=np.repeat(times, count[chunk]), minlength=len(key)).astype(np.int64)
    row, at = np.divmod(key, max(1, len(pairs)))
    docs = np.bincount(at, minlength=len(pairs))
    out = [
        [number],
        [ids.to_pylist()],
        *([s] for s in sums),
        [digests],
        [np.searchsorted(row, np.arange(rows + 1))],
        [at],
        [weight],
        [pairs],
        [docs],
    ]
    kinds = [pa.int64(), *[_LONGS] * 5, pa.list_(pa.string()), *[pa.list_(pa.int32())] * 3, _LONGS, _LONGS]
    names = [f.split()[0] for f in BLOCK.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(out, kinds)], names)


def _short_blocks(docs: DataFrame, tokenizers: tuple[str, str]) -> DataFrame:
    """Batches of texts with their numbers, and the pairs of IDs linked in each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        pair = tokenizer_pair(*tokenizers)
        for batch in batches:
            for first, last, data, offsets in text_groups(batch.column(1)):
                yield _block(pair, number, batch.column(0).slice(first, last - first), data, offsets)
                number += 1

    return docs.mapInArrow(run, BLOCK)


SHORT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def _short_results(stored: DataFrame, counts: DataFrame) -> DataFrame:
    """The documents of each block with what the corpus says of their pairs."""
    asked = stored.select("block", F.posexplode("pairs").alias("place", "pair"))
    told = asked.join(counts, "pair").groupBy("block").agg(
        F.sort_array(F.collect_list(F.struct("place", "docs", "best"))).alias("told")
    )
    carried = stored.select("block", "doc_id", *NUMBERS, "digest", "bounds", "at", "times")
    joined = carried.join(told, "block", "left").withColumn("total", F.col("told.docs")).withColumn("best", F.col("told.best"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.schema.names
            for k in range(len(batch)):
                of = {n: batch.column(i)[k].values for i, n in enumerate(names) if n != "block"}
                at, times = of["at"].to_numpy(), of["times"].to_numpy()
                total = of["total"].to_numpy() if of["total"] is not None else np.zeros(0, np.int64)
                best = of["best"].to_numpy(zero_copy_only=False) if of["best"] is not None else np.zeros(0, bool)
                bounds = of["bounds"].to_numpy()
                sums = [np.concatenate(([0], np.cumsum(times * x[at])))[bounds] for x in (best.astype(np.int64), total)]
                yield pa.RecordBatch.from_arrays(
                    [of["doc_id"], *(of[n] for n in NUMBERS), *(pa.array(np.diff(s), pa.int64()) for s in sums), of["digest"]],
                    [f.split()[0] for f in SHORT.split(", ")],
                )

    return joined.drop("told").mapInArrow(run, SHORT)


# --- texts of several ranges ---


@dataclass
class Fragment:
    """A byte range of a document's tokens. Without a common end all its tokens are in ``prefix``. With
    one, ``prefix`` ends at the first and ``suffix`` begins at ``tail``, the last; the groups between
    them are closed. ``closed`` holds groups that composing has closed: (start, tokens)."""

    prefix: Tokens
    suffix: Tokens
    tail: int  # -1: no common end
    closed: list[tuple[int, Tokens]]

    @staticmethod
    def cut(tokens: Tokens) -> tuple[Fragment, Tokens, int]:
        """(the fragment of a range, tokens of its closed groups, where those start)."""
        cuts = tokens.a_end[_meeting(tokens)[1]]
        if not len(cuts):
            return Fragment(tokens, none(), -1, []), none(), -1
        a0, a1 = np.searchsorted(tokens.a_end, [cuts[0], cuts[-1]], "right").tolist()
        b0, b1 = np.searchsorted(tokens.b_end, [cuts[0], cuts[-1]], "right").tolist()
        prefix = tokens.part(slice(0, a0), slice(0, b0))
        suffix = tokens.part(slice(a1, None), slice(b1, None))
        return Fragment(prefix, suffix, int(cuts[-1]), []), tokens.part(slice(a0, a1), slice(b0, b1)), int(cuts[0])

    def __add__(self, right: Fragment) -> Fragment:
        if self.tail < 0:
            return Fragment(self.prefix + right.prefix, right.suffix, right.tail, self.closed + right.closed)
        middle = self.suffix + right.prefix
        if right.tail < 0:
            return Fragment(self.prefix, middle, self.tail, self.closed + right.closed)
        return Fragment(self.prefix, right.suffix, right.tail, [*self.closed, (self.tail, middle), *right.closed])

    def groups(self) -> list[tuple[int, Tokens]]:
        """The groups of a whole document that no range has closed: the first one, which starts with the
        text, and those closed on the way. The text's end is a common end, so nothing stays open."""
        return [(0, self.prefix), *self.closed]


_OPEN_NAMES = ["prefix", "suffix", "tail", "closed"]
_OPEN = (
    "prefix array<array<long>>, suffix array<array<long>>, tail long, "
    "closed array<struct<start:long,tokens:array<array<long>>>>"
)
_TOKENS = pa.list_(_LONGS)
_OPEN_TYPES = [_TOKENS, _TOKENS, pa.int64(), pa.list_(pa.struct([("start", pa.int64()), ("tokens", _TOKENS)]))]
_CLOSED_NAMES = ["start", *NUMBERS, "pairs", "times", "text"]
_CLOSED = "start long, n_a long, n_b long, n_groups long, n_links long, pairs array<long>, times array<long>, text string"
_CLOSED_TYPES = [*[pa.int64()] * 5, _LONGS, _LONGS, pa.string()]


def _open_values(f: Fragment) -> list:
    closed = [{"start": s, "tokens": t.lists()} for s, t in f.closed]
    return [f.prefix.lists(), f.suffix.lists(), f.tail, closed]


def _open_of(row: dict) -> Fragment:
    closed = [(c["start"], Tokens.of(c["tokens"])) for c in row["closed"]]
    return Fragment(Tokens.of(row["prefix"]), Tokens.of(row["suffix"]), row["tail"], closed)


def _closed_values(tokens: Tokens, start: int) -> list:
    aligned = Aligned(tokens)
    pairs, times = np.unique(aligned.pairs, return_counts=True)
    text, _ = aligned.text()
    return [start, len(tokens.a), len(tokens.b), len(aligned.cuts), len(aligned.pairs), pairs.tolist(), times.tolist(), text]


def _windows(docs: DataFrame, tokenizers: tuple[str, str], size: int) -> DataFrame:
    """Long texts cut at the first safe place after each multiple of the range."""
    names = ["row", "doc_id", "window", "low", "text"]
    kinds = [*[pa.int64()] * 4, pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = tokenizer_pair(*tokenizers)
        for batch in batches:
            for first, _, data, offsets in text_groups(batch.column(2), 1):
                length = int(offsets[-1])
                starts = pair.chunk_starts(data, offsets)
                wanted = np.searchsorted(starts, np.arange(0, length, size))
                edges = np.append(np.unique(starts[wanted[wanted < len(starts)]]), length).tolist()
                row, doc_id = batch.column(0)[first].as_py(), batch.column(1)[first].as_py()
                for k, (low, high) in enumerate(zip(edges, edges[1:])):
                    values = [row, doc_id, k, low, data[low:high].tobytes()]
                    yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(values, kinds)], names)

    fields = "row long, doc_id long, window long, low long, text binary"
    return docs.select("row", "doc_id", "text").mapInArrow(run, fields)


def _fragments(windows: DataFrame, tokenizers: tuple[str, str], size: int) -> DataFrame:
    """The fragments of each window; ``node`` is the byte range and ``window`` the order in it."""
    names = ["row", "node", "window", "right", *_OPEN_NAMES, *_CLOSED_NAMES]
    kinds = [*[pa.int64()] * 3, pa.bool_(), *_OPEN_TYPES, *_CLOSED_TYPES]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = tokenizer_pair(*tokenizers)
        for batch in batches:
            rows, numbers, lows = (batch.column(i).to_pylist() for i in (0, 1, 2))
            for first, last, data, offsets in text_groups(batch.column(3)):
                held = Batch(pair, data, offsets)
                for k in range(last - first):
                    tokens = held.tokens_of(k) if held.right[k] else none()
                    low = lows[first + k]
                    tokens = Tokens(tokens.a, tokens.a_end + low, tokens.b, tokens.b_end + low)
                    for node, part in _ranges(tokens, size):
                        fragment, closed, start = Fragment.cut(part)
                        values = [rows[first + k], node, numbers[first + k], bool(held.right[k])]
                        values += _open_values(fragment) + _closed_values(closed, start)
                        yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(values, kinds)], names)

    fields = f"row long, node long, window long, right boolean, {_OPEN}, {_CLOSED}"
    return windows.select("row", "window", "low", "text").mapInArrow(run, fields)


def _ranges(tokens: Tokens, size: int) -> list[tuple[int, Tokens]]:
    """Tokens by the byte range that they end in; one empty part if there are none."""
    if not len(tokens.a):
        return [(0, tokens)]
    of = [(ends - 1) // size for ends in (tokens.a_end, tokens.b_end)]
    out = []
    for n in np.union1d(*of).tolist():
        a, b = (np.searchsorted(x, [n, n + 1]).tolist() for x in of)
        out.append((n, tokens.part(slice(*a), slice(*b))))
    return out


def _reduced(parts: DataFrame, bits: int) -> DataFrame:
    """One level of the tree: fragments of a row whose nodes agree but for the last bits, composed in
    their order."""
    names = ["row", "node", "window", *_OPEN_NAMES]
    kinds = [*[pa.int64()] * 3, *_OPEN_TYPES]

    def emit(at: tuple[int, int], fragment: Fragment) -> pa.RecordBatch:
        values = [*at, 0, *_open_values(fragment)]
        return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(values, kinds)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, None
        for batch in batches:
            for row in rows_of(batch):
                here, own = (row["row"], row["parent"]), _open_of(row)
                if here != at and at is not None:
                    yield emit(at, held)
                held = held + own if here == at else own
                at = here
        if at is not None:
            yield emit(at, held)

    given = parts.withColumn("parent", F.shiftright("node", bits))
    dealt = given.repartition("row", "parent").sortWithinPartitions("row", "parent", "node", "window")
    return dealt.mapInArrow(run, f"row long, node long, window long, {_OPEN}")


def _loose(reduced: DataFrame) -> DataFrame:
    """The groups of each whole document that no range has closed."""
    names, kinds = ["row", *_CLOSED_NAMES], [pa.int64(), *_CLOSED_TYPES]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in rows_of(batch):
                for start, tokens in _open_of(row).groups():
                    values = [row["row"], *_closed_values(tokens, start)]
                    yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(values, kinds)], names)

    return reduced.mapInArrow(run, f"row long, {_CLOSED}")


def _digests(groups: DataFrame) -> DataFrame:
    """The digest of each row's groups in the order of the text, read piece by piece."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, digest, waiting = None, None, ""
        for batch in batches:
            for row, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if row != at:
                    if at is not None:
                        yield emit(at, digest, waiting)
                    at, digest, waiting = row, hashlib.sha256(), ""
                if text:  # the last mark of all belongs to no group
                    digest.update((waiting + text[:-1]).encode())
                    waiting = text[-1]
        if at is not None:
            yield emit(at, digest, waiting)

    def emit(row: int, digest, waiting: str) -> pa.RecordBatch:
        columns = [pa.array([row], pa.int64()), pa.array([digest.hexdigest() if waiting else ""])]
        return pa.RecordBatch.from_arrays(columns, ["row", "groups_sha256"])

    ordered = groups.select("row", "text", "start").repartition("row").sortWithinPartitions("row", "start")
    return ordered.select("row", "text").mapInArrow(run, "row long, groups_sha256 string")


class _Long:
    """The long texts' groups and pairs, written to the shared folder."""

    def __init__(self, docs: DataFrame, tokenizers: tuple[str, str], size: int, path: str) -> None:
        spark = docs.sparkSession
        numbered = docs.withColumn("row", F.monotonically_increasing_id())
        _windows(numbered, tokenizers, size).write.parquet(f"{path}/windows")
        windows = spark.read.parquet(f"{path}/windows")
        self.rows = windows.where("window = 0").select("row", "doc_id")
        tasks = max(-(-windows.count() // TASK_WINDOWS), spark.sparkContext.defaultParallelism)
        _fragments(windows.repartition(tasks), tokenizers, size).write.parquet(f"{path}/fragments")
        fragments = spark.read.parquet(f"{path}/fragments")
        wrong = fragments.where(~F.col("right")).select("row").distinct()
        kept = fragments.join(wrong, "row", "left_anti")
        reduced = _reduced(kept.select("row", "node", "window", *_OPEN_NAMES), 0)
        left = (fragments.agg(F.max("node")).first()[0] or 0) + 1
        while left > 1:
            reduced = _reduced(reduced, FANOUT_BITS)
            left = -(-left >> FANOUT_BITS)
        _loose(reduced).write.parquet(f"{path}/loose")
        self.groups = kept.select("row", *_CLOSED_NAMES).unionByName(spark.read.parquet(f"{path}/loose"))
        linked = self.groups.select("row", F.inline(F.arrays_zip("pairs", "times")))
        summed = linked.groupBy("row", F.col("pairs").alias("pair")).agg(F.sum("times").alias("times"))
        summed.write.parquet(f"{path}/pairs")
        self.pairs = spark.read.parquet(f"{path}/pairs")

    def results(self, counts: DataFrame) -> DataFrame:
        sums = self.groups.groupBy("row").agg(*[F.sum(n).alias(n) for n in NUMBERS])
        best = F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best")
        total = F.sum(F.col("times") * F.col("docs")).alias("count_sum")
        told = self.pairs.join(counts, "pair").groupBy("row").agg(best, total)
        found = sums.join(told, "row", "left").join(_digests(self.groups), "row", "left")
        numbers = [F.coalesce(c, F.lit(0)).alias(c) for c in (*NUMBERS, "n_best", "count_sum")]
        digest = F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256")
        return self.rows.join(found, "row", "left").select("doc_id", *numbers, digest)


def align(
    docs: DataFrame, byte_level: str, pieces: str, doc_id: str = "doc_id", text: str = "text", size: int = RANGE
) -> DataFrame:
    """doc_id with the counts of tokens, groups and links, the links with the pair of IDs that the most
    documents hold, the documents of all pairs summed over links, and the digest of the groups."""
    spark = docs.sparkSession
    tokenizers = (byte_level, pieces)
    path = fresh_folder(spark, "alignment")
    prefixed = F.when(F.length(text) > 0, F.concat(F.lit(" "), F.col(text)))
    given = docs.select(F.col(doc_id).cast("long").alias("doc_id"), prefixed.alias("text"))
    is_long = F.coalesce(F.octet_length("text") > size, F.lit(False))
    _short_blocks(given.where(~is_long), tokenizers).write.parquet(f"{path}/blocks")
    stored = spark.read.parquet(f"{path}/blocks")
    long = _Long(given.where(is_long), tokenizers, size, path)
    counted = stored.select(F.inline(F.arrays_zip(F.col("pairs").alias("pair"), F.col("docs").alias("docs"))))
    counted = counted.unionByName(long.pairs.select("pair", F.lit(1).cast("long").alias("docs")))
    counted.groupBy("pair").agg(F.sum("docs").alias("docs")).write.parquet(f"{path}/counts")
    counts = spark.read.parquet(f"{path}/counts").withColumn("a", F.shiftright("pair", 32))
    most = counts.groupBy("a").agg(F.max("docs").alias("most"))
    counts = counts.join(most, "a").select("pair", "docs", (F.col("docs") == F.col("most")).alias("best"))
    return _short_results(stored, counts).unionByName(long.results(counts))
