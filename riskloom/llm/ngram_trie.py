"""Language-model scoring with Elias-Fano n-gram tries of order three, one for each shard.

Words are runs between ASCII white space, A to Z in lower case, and each text ends in one end token.
Probabilities are interpolated with absolute discounting, trigram over bigram over a unigram with
half a count added. The trie of a shard holds the words w2 that precede a token, under each the
successors w3 and the words w1 before it, and under (w1, w2) its successors again, numbered by
their place among the successors of w2, so that they are searched in a small range. All levels are
Elias-Fano sequences with monotone pointers, probabilities and back-off weights are quantised to
steps of 1/2048 of their log10, alike in all shards, and the arrays are memory-mapped.

The job: (1) texts become blocks of up to ``BLOCK_TOKENS`` tokens, written once; (2) the blocks'
distinct words meet in vocabulary shards, which give back each word's training count and number;
(3) each token goes with its two predecessors to the shard of w2, which counts the training tokens,
builds its trie, scores all its tokens and gives back one sum for each document. No model is
broadcast or collected, and all that moves grows with the input.

A word with more than ``SHARD_TOKENS`` training tokens is split by the word before it. The blocks'
distinct bigrams after such words are counted over all blocks before, and each part gets the counts
of those it asks for. The distinct trigrams after a pair that fills a shard by itself are counted so
as well, and its tokens are scored from their block's own row. The words and pairs so frequent, less
than one for each ``SHARD_TOKENS`` tokens, are collected. The two discounts come from the counts of all
distinct bigrams and trigrams: the shards go over their tokens twice, first to tell how many they count
once and twice, then to score, and both read the same shuffle. So scores depend neither on shards nor
on blocks.

Defined results: a null or empty text is the end token alone; repeated rows are scored each on
their own; a row without ID trains or not as its hash says; without training text every token has
probability 1; an empty table has no rows; other columns are passed over. The first token of a
text has no predecessor and is scored by the unigram.
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, functions as F

from riskloom.llm.batches import LOWER, NOT_SPACE, by_shard, free_memory, hash_slices, mixed, run_starts, text_groups, words_of
from riskloom.llm.elias_fano import EliasFano
from riskloom.session import fresh_folder

BLOCK_TOKENS = 3_000_000
SHARD_TOKENS = 1_500_000
VOCABULARY_SHARD = 3_000_000
#: Quantised values to a power of ten.
STEPS = 2048
#: A document's sum in one shard is told in steps of this part of log10, far below those.
SUM_STEPS = 1 << 16
#: Hash of the end token, which no word's hash is made to equal.
END_HASH = np.uint64(0xE4D0F7EA7E4D0001)
#: Stands before a text's first token.
_BEFORE = np.uint64(0xB3F04E5C1D2A0003)
_SLICE = 1 << 18
_LONG_PLANE = 1 << 11
_K = np.uint64(0x9E3779B97F4A7C15)
_NONE = 0  # the place of "no word" there


# --- arrays as bytes ---------------------------------------------------------------------------


def pack(*arrays: np.ndarray) -> bytes:
    """Non-negative integers as byte planes, compressed: long planes each for itself, since their bytes
    are spread in different ways, the others together."""
    zip_, head, short, long = zstandard.ZstdCompressor(level=3).compress, [len(arrays)], [], []
    for a in arrays:
        a = a.astype("<u8")
        width = max(1, (int(a.max()).bit_length() + 7) // 8) if len(a) else 1
        head += len(a), width
        planes = np.ascontiguousarray(a.view(np.uint8).reshape(-1, 8)[:, :width].T)
        if len(a) < _LONG_PLANE:
            short.append(planes.tobytes())
        else:
            long += map(zip_, planes)
    head += map(len, long)
    first = zip_(b"".join([np.array(head, "<u4").tobytes(), *short]))
    return b"".join([len(first).to_bytes(4, "little"), first, *long])


def unpack(data: bytes) -> list[np.ndarray]:
    unzip, end = zstandard.ZstdDecompressor().decompress, 4 + int.from_bytes(data[:4], "little")
    raw = unzip(data[4:end])
    count = int(np.frombuffer(raw, "<u4", 1)[0])
    shapes = np.frombuffer(raw, "<u4", 2 * count, 4).reshape(-1, 2).tolist()
    sizes = np.frombuffer(raw, "<u4", sum(width for n, width in shapes if n >= _LONG_PLANE), 4 + 8 * count)
    at, size, out = 4 + 8 * count + 4 * len(sizes), iter(sizes.tolist()), []
    for n, width in shapes:
        planes = np.zeros((n, 8), np.uint8)
        if n < _LONG_PLANE:
            planes[:, :width] = np.frombuffer(raw, np.uint8, n * width, at).reshape(width, n).T
            at += n * width
        else:
            for k in range(width):
                begin, end = end, end + next(size)
                planes[:, k] = np.frombuffer(unzip(data[begin:end]), np.uint8)
        out.append(planes.view("<u8").reshape(-1))
    return out


def _ranked(places: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(how often each of n places occurs, the places by falling frequency), which packs well."""
    counts = np.bincount(places.ravel(), minlength=n)
    rank = np.empty(n, np.int64)
    rank[np.argsort(-counts, kind="stable")] = np.arange(n)
    return counts, rank[places]


def _unranked(counts: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    return np.argsort(-counts.astype(np.int64), kind="stable")[ranks.astype(np.int64)]


def _steps(values: np.ndarray) -> np.ndarray:
    """Differences of sorted values."""
    return np.diff(values, prepend=np.uint64(0)) if len(values) else values


def _sums(steps: np.ndarray) -> np.ndarray:
    return np.cumsum(steps, dtype=np.uint64)


# --- the trie ----------------------------------------------------------------------------------


def quantised(values: np.ndarray) -> np.ndarray:
    """Codes of numbers up to 1 by their log10."""
    return np.clip(np.rint(-STEPS * np.log10(np.maximum(values, 1e-30))), 0, 65535).astype(np.uint16)


def log_of(codes: np.ndarray) -> np.ndarray:
    return codes / -STEPS


def _discount(counts: np.ndarray) -> float:
    return _discount_of(int((counts == 1).sum()), int((counts == 2).sum()))


def _discount_of(ones: int, twos: int) -> float:
    return min(0.99, max(0.1, ones / (ones + 2 * twos))) if ones and twos else 0.75


@dataclass(frozen=True)
class Split:
    """The words that several shards share, with the kinds and the total of their successors in all
    training texts; and the bigrams (w2, w3) with their counts there."""

    words: np.ndarray
    kinds: np.ndarray
    totals: np.ndarray
    w2: np.ndarray
    w3: np.ndarray
    counts: np.ndarray

    @classmethod
    def none(cls) -> Split:
        return cls(*np.zeros((6, 0), np.int64))


class NGramTrie:
    """Levels as arrays by name; ``build`` makes them, ``save`` and ``open`` map them from a folder."""

    SEQUENCES = ("words", "successors", "successor_starts", "contexts", "thirds", "third_bases")

    def __init__(self, size: int, sequences: dict[str, EliasFano], tables: dict[str, np.ndarray]) -> None:
        self.size, self.sequences, self.tables = size, sequences, tables

    @classmethod
    def build(
        cls, w2: np.ndarray, w1: np.ndarray, w3: np.ndarray, counts: np.ndarray, log_p1: np.ndarray,
        discounts: tuple[float, float] | None = None, split: Split | None = None,
    ) -> NGramTrie:
        """From distinct trigrams sorted by (w2, w1, w3) with their counts; words are places in a
        vocabulary of which ``log_p1`` has the unigram log10 probabilities. ``split`` has the bigrams
        of words whose trigrams are not all here."""
        size = len(log_p1)
        p1 = 10.0**log_p1
        split = split or Split.none()
        words = np.union1d(w2, split.w2)
        of_word = np.searchsorted(words, w2)
        # Level two: successors of w2.
        given = np.searchsorted(words, split.w2) * size + split.w3
        pair_keys = np.union1d(of_word * size + w3, given)
        pair_of = np.searchsorted(pair_keys, of_word * size + w3)
        pair_counts = np.bincount(pair_of, weights=counts, minlength=len(pair_keys))
        pair_counts[np.searchsorted(pair_keys, given)] = split.counts
        pair_word, pair_w3 = pair_keys // size, pair_keys % size
        totals = np.bincount(pair_word, weights=pair_counts, minlength=len(words))
        held = np.bincount(pair_word, minlength=len(words))
        kinds = held.copy()
        at = np.searchsorted(words, split.words)
        kinds[at], totals[at] = split.kinds, split.totals
        d2, d3 = discounts or (_discount(pair_counts), _discount(counts))
        weight2 = d2 * kinds / np.maximum(totals, 1)
        p2 = (pair_counts - d2) / totals[pair_word] + weight2[pair_word] * p1[pair_w3]
        del pair_word, pair_w3, pair_counts, p1
        starts = np.concatenate(([0], np.cumsum(held)))
        # Contexts (w2, w1), and under each its successors by their place under w2.
        place = (pair_of - starts[of_word]).astype(np.int32)
        context_keys, context_of = np.unique(of_word * size + w1, return_inverse=True)
        context_of = context_of.astype(np.int32)
        del of_word
        context_totals = np.bincount(context_of, weights=counts)
        context_kinds = np.bincount(context_of)
        weight3 = d3 * context_kinds / np.maximum(context_totals, 1)
        p3 = (counts - d3) / context_totals[context_of] + weight3[context_of] * p2[pair_of]
        tables = {name: quantised(value) for name, value in {"p2": p2, "p3": p3, "weight2": weight2, "weight3": weight3}.items()}
        del p2, p3, pair_of, context_totals
        ranges = held[context_keys // size] if len(context_keys) else np.zeros(0, np.int64)
        bases = np.concatenate(([0], np.cumsum(ranges)))
        sequences = {
            "words": EliasFano.of(words, size),
            "successors": EliasFano.of(pair_keys, max(1, len(words) * size)),
            "successor_starts": EliasFano.of(starts, len(pair_keys) + 1),
            "contexts": EliasFano.of(context_keys, max(1, len(words) * size)),
            "thirds": EliasFano.of(bases[context_of] + place, int(bases[-1]) + 1),
            "third_bases": EliasFano.of(bases, int(bases[-1]) + 1),
        }
        return cls(size, sequences, tables)

    def _named(self) -> dict[str, np.ndarray]:
        out = dict(self.tables)
        for name in self.SEQUENCES:
            s = self.sequences[name]
            out[f"{name}.shape"] = np.array([s.n, s.width])
            out |= {f"{name}.{k}": v for k, v in s.arrays().items()}
        return out | {"size": np.array([self.size])}

    def save(self, folder: str) -> None:
        for name, values in self._named().items():
            np.save(os.path.join(folder, name), values)

    @classmethod
    def open(cls, folder: str) -> NGramTrie:
        """The levels mapped into memory, not read."""
        get = {n[:-4]: np.load(os.path.join(folder, n), mmap_mode="r") for n in os.listdir(folder)}
        sequences = {}
        for name in cls.SEQUENCES:
            n, width = get[f"{name}.shape"].tolist()
            sequences[name] = EliasFano(n, width, get[f"{name}.low"], get[f"{name}.high"], get[f"{name}.ones"])
        tables = {k: v for k, v in get.items() if "." not in k and k != "size"}
        return cls(int(get["size"][0]), sequences, tables)

    def _value(self, name: str, at: np.ndarray) -> np.ndarray:
        return log_of(self.tables[name][at])

    def score(self, w2: np.ndarray, w1: np.ndarray, w3: np.ndarray, log_p1: np.ndarray) -> np.ndarray:
        """log10 probability of each w3 after w1 w2, given its unigram's."""
        out = log_p1.astype(float).copy()
        word, known = self.sequences["words"].find(w2)
        at = np.flatnonzero(known)
        if not len(at):
            return out
        word = word[at]
        pair, seen = self.sequences["successors"].find(word * self.size + w3[at])
        out[at[seen]] = self._value("p2", pair[seen])
        out[at[~seen]] += self._value("weight2", word[~seen])
        context, inside = self.sequences["contexts"].find(word * self.size + w1[at])
        begin = np.zeros(len(at), np.int64)
        begin[seen] = self.sequences["successor_starts"].get(word[seen]).astype(np.int64)
        both = np.flatnonzero(inside & seen)
        base = self.sequences["third_bases"].get(context[both]).astype(np.int64)
        third, found = self.sequences["thirds"].find(base + pair[both] - begin[both])
        out[at[both[found]]] = self._value("p3", third[found])
        backed = inside.copy()
        backed[both[found]] = False
        out[at[backed]] += self._value("weight3", context[backed])
        return out


# --- the job -----------------------------------------------------------------------------------

_BLOCK = "block long, ids array<{id}>, trains array<boolean>, lengths array<int>, n_words long, n_tokens long, n_train long, words binary, tokens binary"


def _blocks(docs: DataFrame, kind: str, limit: int) -> DataFrame:
    """(doc_id, text, train) to blocks: the documents with their lengths, the distinct words' hashes
    with their training counts, and each token as a place among those."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        held: list[tuple[pa.Array, pa.Array, np.ndarray, np.ndarray]] = []
        size = 0
        for batch in batches:
            for first, last, data, offsets in text_groups(batch.column(1)):
                hashes, lengths = _tokens(data, offsets)
                n = last - first
                held.append((batch.column(0).slice(first, n), batch.column(2).slice(first, n), hashes, lengths))
                size += len(hashes)
                if size >= limit:
                    yield _block(number, held)
                    number, size = number + 1, 0
        if held:
            yield _block(number, held)
        free_memory()

    return docs.mapInArrow(run, _BLOCK.format(id=kind))


def _tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of the tokens with an end token after each text, tokens of each text)"""
    lowered = LOWER[data]
    rows, starts, ends = words_of(lowered, offsets, NOT_SPACE)
    lengths = np.bincount(rows, minlength=len(offsets) - 1) + 1
    out = np.full(int(lengths.sum()), END_HASH, np.uint64)
    is_word = np.ones(len(out), bool)
    is_word[np.cumsum(lengths) - 1] = False
    out[is_word] = hash_slices(lowered, starts, ends)
    return out, lengths


def _block(number: int, held: list[tuple[pa.Array, pa.Array, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    ids = pa.concat_arrays([h[0] for h in held])
    trains = pa.concat_arrays([h[1] for h in held])
    hashes, lengths = np.concatenate([h[2] for h in held]), np.concatenate([h[3] for h in held])
    held.clear()
    words = np.unique(hashes)
    places = np.empty(len(hashes), np.int32)
    for a in range(0, len(hashes), _SLICE):
        places[a : a + _SLICE] = np.searchsorted(words, hashes[a : a + _SLICE])
    train = np.repeat(trains.to_numpy(zero_copy_only=False), lengths)
    counts = np.bincount(places[train], minlength=len(words))
    one = lambda a: pa.ListArray.from_arrays(pa.array([0, len(a)], pa.int32()), a)
    columns = [
        pa.array([number], pa.int64()), one(ids), one(trains), one(pa.array(lengths.astype(np.int32))),
        pa.array([len(words)], pa.int64()), pa.array([len(hashes)], pa.int64()), pa.array([int(train.sum())], pa.int64()),
        pa.array([pack(_steps(words), counts)], pa.binary()), pa.array([pack(*_ranked(places, len(words)))], pa.binary()),
    ]
    return pa.RecordBatch.from_arrays(columns, [f.split()[0] for f in _BLOCK.split(", ")])


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[tuple]]]:
    """(key, rows) of consecutive rows with the same first column."""
    key, rows = None, []
    for batch in batches:
        for k in range(batch.num_rows):
            row = tuple(c[k].as_py() for c in batch.columns)
            if row[0] != key and rows:
                yield key, rows
                rows = []
            key = row[0]
            rows.append(row)
    if rows:
        yield key, rows


def _shard_of_word(hashes: np.ndarray, shards: int) -> np.ndarray:
    """Consecutive ranges of hashes."""
    return ((hashes >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)


def _vocabulary(blocks: DataFrame, shards: int, frequent: int) -> DataFrame:
    """block, shard, data (training count and number of each of the block's words in the shard), and
    on one row of each shard the number of its words with a training count and the hashes of those
    with more than ``frequent``."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                steps, counts = unpack(data.as_py())
                words = _sums(steps)
                of = _shard_of_word(words, shards)
                cuts = np.searchsorted(of, np.arange(shards + 1))
                some = np.flatnonzero(np.diff(cuts)).tolist()
                parts = [pack(_steps(words[cuts[s] : cuts[s + 1]]), counts[cuts[s] : cuts[s + 1]]) for s in some]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(some, pa.int64()), pa.array([block] * len(some), pa.int64()), pa.array(parts, pa.binary())],
                    ["shard", "block", "data"],
                )

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, rows in _runs(batches):
            parts = [unpack(r[2]) for r in rows]
            words = [_sums(p[0]) for p in parts]
            every, places = np.unique(np.concatenate(words), return_inverse=True)
            counts = np.bincount(places, weights=np.concatenate([p[1] for p in parts])).astype(np.uint64)
            cuts = np.cumsum([0, *map(len, words)])
            data = []
            for k in range(len(rows)):
                own = places[cuts[k] : cuts[k + 1]].astype(np.uint64)
                data.append(pack(counts[own], _steps(own)))
            known = [int((counts > 0).sum())] + [0] * (len(rows) - 1)
            often = [every[counts > frequent].tobytes()] + [b""] * (len(rows) - 1)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([r[1] for r in rows], pa.int64()), pa.array([shard] * len(rows), pa.int64()),
                    pa.array(known, pa.int64()), pa.array(data, pa.binary()), pa.array(often, pa.binary()),
                ],
                ["block", "shard", "known", "data", "often"],
            )

    sent = blocks.select("block", "words").mapInArrow(send, "shard long, block long, data binary")
    return by_shard(sent, shards).mapInArrow(answer, "block long, shard long, known long, data binary, often binary")


def _joint(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hashes of a word or pair with the word after it."""
    return mixed(mixed(a) * _K + b)


def _place(keys: np.ndarray, among: np.ndarray) -> np.ndarray:
    """The place of each key among sorted ones, -1 where it is not there."""
    if not len(among):
        return np.full(len(keys), -1)
    at = np.minimum(np.searchsorted(among, keys), len(among) - 1)
    return np.where(among[at] == keys, at, -1)


@dataclass(frozen=True)
class Frequent:
    """Sorted hashes of the words, and of the pairs, that do not fit a shard, with the kinds of their
    successors in the training texts; and how often such pairs occur there."""

    words: np.ndarray
    word_kinds: np.ndarray
    pairs: np.ndarray
    pair_kinds: np.ndarray
    pair_counts: np.ndarray

    def bigrams(self, words: np.ndarray, tokens: np.ndarray, firsts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(places of the tokens after such words, keys of the bigrams there, which words)"""
        which = np.empty(len(tokens), np.int32)
        which[1:] = _place(words, self.words).astype(np.int32)[tokens[:-1]]
        which[firsts] = _place(np.array([_BEFORE]), self.words)[0]
        at = np.flatnonzero(which >= 0)
        which = which[at]
        return at, _joint(self.words[which], words[tokens[at]]), which

    def trigrams(self, words: np.ndarray, tokens: np.ndarray, firsts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(places of the tokens after such pairs, keys of the trigrams there, which pairs)"""
        at, keys, _ = self.bigrams(words, tokens, firsts)
        which = _place(keys, self.pairs)
        first = np.zeros(len(tokens) + 1, bool)
        first[firsts] = first[-1] = True
        some = np.flatnonzero((which >= 0) & ~first[at + 1])
        at, which = at[some] + 1, which[some]
        return at, _joint(self.pairs[which], words[tokens[at]]), which


def _block_tokens(batch: pa.RecordBatch, k: int) -> tuple[np.ndarray, ...]:
    """(hashes of the words, tokens as places there, places of the texts' first ones, whether in a
    training text) of a row of words, tokens, lengths and trains."""
    words = _sums(unpack(batch.column("words")[k].as_py())[0])
    tokens = _unranked(*unpack(batch.column("tokens")[k].as_py())).astype(np.int32)
    lengths = batch.column("lengths")[k].values.to_numpy().astype(np.int64)
    trains = batch.column("trains")[k].values.to_numpy(zero_copy_only=False)
    return words, tokens, np.cumsum(lengths) - lengths, np.repeat(trains, lengths)


def _counted(
    blocks: DataFrame, grams: Callable[[np.ndarray, np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray, np.ndarray]], shards: int, frequent: int
) -> DataFrame:
    """block, shard, data (training counts of the block's distinct keys in the shard), and on one row of
    each shard ``often``: the keys with more than ``frequent``, their counts, and for each word or pair
    its kinds and how many of them occur once and twice."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                words, tokens, firsts, train = _block_tokens(batch, k)
                at, keys, which = grams(words, tokens, firsts)
                keys, first, of = np.unique(keys, return_index=True, return_inverse=True)
                counts = np.bincount(of[train[at]], minlength=len(keys))
                which = which[first]
                cuts = np.searchsorted(_shard_of_word(keys, shards), np.arange(shards + 1))
                some = np.flatnonzero(np.diff(cuts)).tolist()
                parts = [slice(cuts[s], cuts[s + 1]) for s in some]
                data = [pack(_steps(keys[x]), counts[x], which[x]) for x in parts]
                block = batch.column("block")[k].as_py()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(some, pa.int64()), pa.array([block] * len(some), pa.int64()), pa.array(data, pa.binary())],
                    ["shard", "block", "data"],
                )

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, rows in _runs(batches):
            parts = [unpack(r[2]) for r in rows]
            keys = [_sums(p[0]) for p in parts]
            every, first, places = np.unique(np.concatenate(keys), return_index=True, return_inverse=True)
            counts = np.bincount(places, weights=np.concatenate([p[1] for p in parts])).astype(np.int64)
            which = np.concatenate([p[2] for p in parts])[first].astype(np.int64)
            kinds = [np.bincount(which[some]) for some in (counts > 0, counts == 1, counts == 2)]
            big = np.flatnonzero(counts > frequent)
            cuts = np.cumsum([0, *map(len, keys)])
            data = [pack(counts[places[a:b]]) for a, b in zip(cuts[:-1], cuts[1:])]
            often = [pack(every[big], counts[big], *kinds)] + [b""] * (len(rows) - 1)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([r[1] for r in rows], pa.int64()), pa.array([shard] * len(rows), pa.int64()),
                    pa.array(data, pa.binary()), pa.array(often, pa.binary()),
                ],
                ["block", "shard", "data", "often"],
            )

    sent = blocks.select("block", "words", "tokens", "lengths", "trains").mapInArrow(send, "shard long, block long, data binary")
    return by_shard(sent, shards).mapInArrow(answer, "block long, shard long, data binary, often binary")


def _often(answers: DataFrame, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sorted keys, their counts, three rows of n words or pairs: their kinds, those that occur once and
    those that occur twice) that the shards noted."""
    parts = [unpack(r[0]) for r in answers.where("length(often) > 0").select("often").collect()]
    kinds = np.zeros((3, n), np.int64)
    for p in parts:
        for row, own in zip(kinds, p[2:]):
            row[: len(own)] += own.astype(np.int64)
    none = np.zeros(0, np.uint64)
    keys = np.concatenate([none, *(p[0] for p in parts)])
    order = np.argsort(keys)
    return keys[order], np.concatenate([none, *(p[1] for p in parts)])[order].astype(np.int64), kinds


def _sent(joined: DataFrame, kind: str, n: int, v: int, shards: int, shard_tokens: int, frequent: Frequent) -> DataFrame:
    """shard, block, data: each block's tokens by the shard of the word before, and under a shard of
    its own, below 0, what the block knows by itself; with it ``own``, the counts of its trigrams that no
    shard scores."""
    schema = f"shard long, block long, data binary, own binary, ids array<{kind}>, trains array<boolean>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                yield from messages(batch, k)
                free_memory()

    def messages(batch: pa.RecordBatch, k: int) -> Iterator[pa.RecordBatch]:
        block = batch.column(0)[k].as_py()
        ids, trains = batch.column(1).slice(k, 1), batch.column(2).slice(k, 1)
        lengths = batch.column(3)[k].values.to_numpy().astype(np.int64)
        answers = sorted((a["level"], a["shard"], a["data"]) for a in batch.column(5)[k].as_py())
        counts, numbers = _answers([a[1:] for a in answers if a[0] == 1])
        tokens = _unranked(*unpack(batch.column(4)[k].as_py())).astype(np.int32)
        log_p1 = np.log10((counts + 0.5) / (n + 0.5 * (v + 1)))
        doc = np.repeat(np.arange(len(lengths), dtype=np.int32), lengths)
        firsts = np.cumsum(lengths) - lengths
        base = np.bincount(doc, weights=log_p1[tokens], minlength=len(lengths))
        known = np.bincount(doc, weights=counts[tokens] > 0, minlength=len(lengths))
        start = log_p1[tokens[firsts]]
        at = np.ones(len(tokens), bool)
        at[firsts] = False
        kinds, count2, apart = np.zeros(len(counts), np.int64), None, b""
        if len(frequent.words):
            count2 = np.zeros(len(tokens), np.int64)
            words = _sums(unpack(batch.column(6)[k].as_py())[0])
            which = _place(words, frequent.words)
            kinds[which >= 0] = frequent.word_kinds[which[which >= 0]]
            near, keys, _ = frequent.bigrams(words, tokens, firsts)
            _, of = np.unique(keys, return_inverse=True)
            count2[near] = _counts_of(answers, 2)[of]
            if len(frequent.pairs):
                own, keys, which = frequent.trigrams(words, tokens, firsts)
                _, first, of = np.unique(keys, return_index=True, return_inverse=True)
                after, which = own[first], which[first]
                before = tokens[after - 1]
                per_doc = np.bincount(doc[own], minlength=len(lengths))
                often, ranks = _ranked(of, len(first))
                apart = pack(
                    _counts_of(answers, 3), frequent.pair_counts[which], frequent.pair_kinds[which], count2[after],
                    counts[before], kinds[before], counts[tokens[after]], often, ranks, per_doc,
                )
                at[own] = False
            del near, keys, of
        head = np.stack([base, known, lengths, start]).astype("<f8").tobytes()
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([-1 - block], pa.int64()), pa.array([block], pa.int64()), pa.array([head], pa.binary()),
                pa.array([apart], pa.binary()), ids, trains,
            ],
            ["shard", "block", "data", "own", "ids", "trains"],
        )
        at = np.flatnonzero(at).astype(np.int32)
        if not len(at):
            return
        # Two before each token, -1 where there is no such word.
        earlier = np.concatenate((np.full(2, -1, np.int32), tokens[:-2]))
        earlier[np.minimum(firsts + 1, len(tokens) - 1)[lengths > 1]] = -1
        of = np.empty(len(at), np.int32 if shards > 65536 else np.uint16)
        for a in range(0, len(at), _SLICE):
            some = at[a : a + _SLICE]
            of[a : a + _SLICE] = _token_shards(tokens[some - 1], earlier[some], numbers, counts, shards, shard_tokens)
        order = np.argsort(of, kind="stable").astype(np.int32)
        cuts = np.concatenate(([0], np.cumsum(np.bincount(of, minlength=shards))))
        del of
        some = np.flatnonzero(np.diff(cuts)).tolist()
        train = batch.column(2)[k].values.to_numpy(zero_copy_only=False)

        def split(used: np.ndarray, place: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            if not kinds[used].any():
                return np.zeros(0, np.int64), np.zeros(0, np.int64)
            _, first, _ = _split_pairs(kinds[used], place[0], place[2])
            return kinds[used], count2[own[first]]

        data = []
        for s in some:
            own = at[order[cuts[s] : cuts[s + 1]]]
            triple = np.concatenate((tokens[own - 1], earlier[own], tokens[own]))
            used, place = np.unique(triple, return_inverse=True)
            none = int(used[0] == -1)
            used = used[none:]
            place = (place + 1 - none).reshape(3, -1)  # 0 is no word
            # Of the block's documents only those with a token here, so that all messages grow with tokens.
            of_doc = doc[own]
            begins = run_starts(of_doc)
            docs = of_doc[begins]
            per_doc = np.diff(np.append(begins, len(own)))
            often, ranks = _ranked(place, len(used) + 1)
            asked = kinds[used] > 0  # only predicted words and split ones need their counts
            asked[place[2] - 1] = True
            data.append(
                pack(
                    _steps(numbers[used]), np.where(asked, counts[used], 0), often, *ranks, per_doc, train[docs],
                    *split(used, place, own), _steps(docs.astype(np.uint64)),
                )
            )
        m = len(some)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(some, pa.int64()), pa.array([block] * m, pa.int64()), pa.array(data, pa.binary()),
                pa.nulls(m, pa.binary()), pa.nulls(m, ids.type), pa.nulls(m, trains.type),
            ],
            ["shard", "block", "data", "own", "ids", "trains"],
        )

    return joined.select("block", "ids", "trains", "lengths", "tokens", "answers", "words").mapInArrow(run, schema)


def _counts_of(answers: list[tuple[int, int, bytes]], level: int) -> np.ndarray:
    return np.concatenate([np.zeros(0, np.int64), *(unpack(a[2])[0].astype(np.int64) for a in answers if a[0] == level)])


def _split_pairs(kinds: np.ndarray, w2: np.ndarray, w3: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sorted distinct keys, a place of each, w2 and w3 of each) of the bigrams of words with kinds, by
    places from 1."""
    at = np.flatnonzero(kinds[w2 - 1])
    keys, first = np.unique(w2[at] * (len(kinds) + 1) + w3[at], return_index=True)
    return keys, at[first], np.stack(np.divmod(keys, len(kinds) + 1))


def _frequent_scores(
    count3: np.ndarray, total3: np.ndarray, kinds3: np.ndarray, count2: np.ndarray, total2: np.ndarray, kinds2: np.ndarray,
    log_p1: np.ndarray, discounts: tuple[float, float],
) -> np.ndarray:
    """What a trie gives, from the counts."""
    d2, d3 = discounts
    weight2, weight3 = d2 * kinds2 / np.maximum(total2, 1), d3 * kinds3 / total3
    p2 = (count2 - d2) / np.maximum(total2, 1) + weight2 * 10.0**log_p1
    p3 = (count3 - d3) / total3 + weight3 * p2
    lower = np.where(count2 > 0, log_of(quantised(p2)), log_of(quantised(weight2)) + log_p1)
    return np.where(count3 > 0, log_of(quantised(p3)), log_of(quantised(weight3)) + lower)


def _answers(answers: list[tuple[int, bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """(training counts, numbers) of a block's words, in the order of their hashes."""
    counts, numbers = [], []
    for shard, data in answers:
        count, steps = unpack(data)
        counts.append(count)
        numbers.append(_sums(steps) + (np.uint64(shard) << np.uint64(40)))
    return np.concatenate(counts).astype(np.int64), np.concatenate(numbers)


def _token_shards(
    w2: np.ndarray, w1: np.ndarray, numbers: np.ndarray, counts: np.ndarray, shards: int, shard_tokens: int
) -> np.ndarray:
    """The shard of each token: by w2, and by w1 as well where w2 is too frequent for one shard."""
    key = mixed(numbers[w2] + np.uint64(1))
    parts = -(-counts[w2] // shard_tokens)
    hot = np.flatnonzero(parts > 1)
    if len(hot):
        before = np.where(w1[hot] < 0, np.uint64(0), numbers[np.maximum(w1[hot], 0)] + np.uint64(2))
        key[hot] += mixed(before) % parts[hot].astype(np.uint64) + np.uint64(1)
    return (mixed(key) % np.uint64(shards)).astype(np.int64)


def _by_shard(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[pa.RecordBatch]]]:
    """(shard, rows) of consecutive rows of one shard; blocks' own rows each for itself."""
    held: list[pa.RecordBatch] = []
    shard = None
    for batch in batches:
        for k in range(batch.num_rows):
            now = batch.column(0)[k].as_py()
            if held and (now != shard or now < 0):
                yield shard, held
                held = []
            shard = now
            held.append(batch.slice(k, 1))
    if held:
        yield shard, held


def _kinds_found(dealt: DataFrame) -> DataFrame:
    """ones2, twos2, ones3, twos3: how many distinct bigrams, but for those after words that several
    shards share, and trigrams of each shard occur once and twice in training texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, rows in _by_shard(batches):
            if shard >= 0:
                found = [pa.array([x], pa.int64()) for x in _shard_kinds(rows)]
                yield pa.RecordBatch.from_arrays(found, ["ones2", "twos2", "ones3", "twos3"])
        free_memory()

    # All columns, so that this reads the same shuffle as the scoring.
    return dealt.mapInArrow(run, "ones2 long, twos2 long, ones3 long, twos3 long")


def _once_and_twice(keys: np.ndarray) -> tuple[int, int]:
    """How many distinct keys occur once and twice."""
    keys.sort()
    starts = run_starts(keys)
    kinds = np.bincount(np.minimum(np.diff(np.append(starts, len(keys))), 3), minlength=3)
    return int(kinds[1]), int(kinds[2])


def _shard_kinds(rows: list[pa.RecordBatch]) -> tuple[int, int, int, int]:
    numbers, triples, shared = [], [], []
    for r in rows:
        p = unpack(r.column("data")[0].as_py())
        train = np.repeat(p[7].astype(bool), p[6].astype(np.int64))
        numbers.append(_sums(p[0]))
        triples.append(np.stack([_unranked(p[2], x[train]).astype(np.int32) for x in p[3:6]]))
        shared.append(p[8] > 0 if len(p[8]) else np.zeros(len(p[0]), bool))
    every, place = np.unique(np.concatenate(numbers), return_inverse=True)
    place = (place + 1).astype(np.int32)
    size = len(every) + 1
    split = np.zeros(size, bool)
    split[place[np.concatenate(shared)]] = True
    cuts = np.cumsum([0, *map(len, numbers)])
    for k, triple in enumerate(triples):
        triples[k] = np.concatenate((np.array([_NONE], np.int32), place[cuts[k] : cuts[k + 1]]))[triple]
    w2, w1, w3 = np.concatenate(triples, axis=1).astype(np.int64)
    del triples
    pairs = _once_and_twice((w2 * size + w3)[~split[w2]])
    contexts = w2 * size + w1
    if size**3 >= 1 << 63:
        contexts = np.unique(contexts, return_inverse=True)[1]
    return *pairs, *_once_and_twice(contexts * size + w3)


def _scored(dealt: DataFrame, found: DataFrame, kind: str, n: int, v: int) -> DataFrame:
    """block, data, ids, trains: each document's sum in each shard, and each block's own row. ``found``
    is one row with the numbers of all distinct bigrams and trigrams that occur once and twice."""
    schema = f"block long, data binary, ids array<{kind}>, trains array<boolean>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, rows in _by_shard(batches):
            ones2, twos2, ones3, twos3 = (rows[0].column(c)[0].as_py() or 0 for c in ("ones2", "twos2", "ones3", "twos3"))
            discounts = _discount_of(ones2, twos2), _discount_of(ones3, twos3)
            if shard < 0:
                (row,) = rows
                data = _with_own(row.column("data")[0].as_py(), row.column("own")[0].as_py(), n, v, discounts)
                columns = [row.column("block"), pa.array([data], pa.binary()), row.column("ids"), row.column("trains")]
                yield pa.RecordBatch.from_arrays(columns, ["block", "data", "ids", "trains"])
            else:
                yield _shard_scores(rows, n, v, discounts)
        free_memory()

    # A join's optimiser drops the order of its input.
    return dealt.crossJoin(F.broadcast(found)).sortWithinPartitions("shard").mapInArrow(run, schema)


def _with_own(head: bytes, own: bytes, n: int, v: int, discounts: tuple[float, float]) -> bytes:
    """A block's own row with the scores of the trigrams that no shard scores."""
    if not own:
        return head
    *counts, often, ranks, per_doc = (a.astype(np.int64) for a in unpack(own))
    log_p1 = np.log10((counts.pop() + 0.5) / (n + 0.5 * (v + 1)))
    values = _frequent_scores(*counts, log_p1, discounts)[_unranked(often, ranks)]
    rows = np.frombuffer(head, "<f8").reshape(4, -1).copy()
    rows[3] += np.bincount(np.repeat(np.arange(len(per_doc)), per_doc), weights=values, minlength=len(per_doc))
    return rows.tobytes()


def _distinct(w2: np.ndarray, w1: np.ndarray, w3: np.ndarray, size: int) -> tuple[np.ndarray, ...]:
    """The distinct trigrams of places below ``size``, sorted by (w2, w1, w3), and which one each is."""
    keys = w2.astype(np.int64) * size + w1
    if size**3 < 1 << 63:
        keys, inverse = np.unique(keys * size + w3, return_inverse=True)
        contexts, w3 = np.divmod(keys, size)
        return *np.divmod(contexts, size), w3, inverse
    contexts, of = np.unique(keys, return_inverse=True)
    keys, inverse = np.unique(of * size + w3, return_inverse=True)
    of, w3 = np.divmod(keys, size)
    return *np.divmod(contexts[of], size), w3, inverse


def _shard_scores(rows: list[pa.RecordBatch], n: int, v: int, discounts: tuple[float, float]) -> pa.RecordBatch:
    """The sum of log10 probabilities for each document with tokens in the shard, by its steps among
    those of its block."""
    parts = []
    for r in rows:
        p = unpack(r.column("data")[0].as_py())
        p[3:6] = [x.astype(np.int32) for x in p[3:6]]
        parts.append(p)
    numbers = [_sums(p[0]) for p in parts]
    every, place = np.unique(np.concatenate(numbers), return_inverse=True)
    counts = np.zeros(len(every) + 1, np.int64)
    told = np.concatenate([p[1] for p in parts]).astype(np.int64)
    counts[place[told > 0] + 1] = told[told > 0]
    cuts = np.cumsum([0, *map(len, numbers)])
    triples, trains, docs = [], [], []
    kinds, pairs = np.zeros(len(counts), np.int64), [np.zeros((3, 0), np.int64)]
    for k, p in enumerate(parts):
        to = np.concatenate(([_NONE], place[cuts[k] : cuts[k + 1]] + 1)).astype(np.int32)
        triple = [_unranked(p[2], x) for x in p[3:6]]
        triples.append(to[np.stack(triple)])
        if len(p[8]):
            own = p[8].astype(np.int64)
            kinds[to[1:]] = np.maximum(kinds[to[1:]], own)
            _, _, pair = _split_pairs(own, triple[0], triple[2])
            pairs.append(np.concatenate((to[pair], p[9].astype(np.int64)[None])))
        p[3:6] = [None] * 3
        per_doc = p[6].astype(np.int64)
        docs.append(np.repeat(np.arange(len(per_doc), dtype=np.int32), per_doc))
        trains.append(np.repeat(p[7].astype(bool), per_doc))
    triples = np.concatenate(triples, axis=1)
    w2, w1, w3, inverse = (x.astype(np.int32) for x in _distinct(*triples, len(counts)))
    del triples, place
    seen = np.bincount(inverse[np.concatenate(trains)], minlength=len(w2))
    del trains
    free_memory()
    log_p1 = np.log10((counts + 0.5) / (n + 0.5 * (v + 1)))
    some = seen > 0
    pair_w2, pair_w3, pair_counts = np.concatenate(pairs, axis=1)
    _, first = np.unique(pair_w2 * len(counts) + pair_w3, return_index=True)
    first = first[pair_counts[first] > 0]
    pair_w2 = pair_w2[first]
    words = np.unique(pair_w2)
    split = Split(words, kinds[words], counts[words], pair_w2, pair_w3[first], pair_counts[first])
    with tempfile.TemporaryDirectory() as folder:
        NGramTrie.build(w2[some], w1[some], w3[some], seen[some], log_p1, discounts, split).save(folder)
        del seen, some
        free_memory()
        trie, scores = NGramTrie.open(folder), np.empty(len(w2))
        for a in range(0, len(w2), _SLICE):
            part = slice(a, a + _SLICE)
            scores[part] = trie.score(w2[part], w1[part], w3[part], log_p1[w3[part]])
        del trie
    out, at = [], 0
    for p, own in zip(parts, docs):
        values = scores[inverse[at : at + len(own)]]
        at += len(own)
        out.append(_sums_message(p[10], np.bincount(own, weights=values, minlength=len(p[6]))))
    nothing = [pa.nulls(len(rows), rows[0].column(c).type) for c in ("ids", "trains")]
    block = pa.concat_arrays([r.column("block") for r in rows])
    return pa.RecordBatch.from_arrays(
        [block, pa.array(out, pa.binary()), *nothing], ["block", "data", "ids", "trains"]
    )


def _sums_message(steps: np.ndarray, sums: np.ndarray) -> bytes:
    """Steps between documents, and for each its sum, none above 0, to the next 1/65536."""
    return pack(steps, np.rint(np.maximum(-sums, 0) * SUM_STEPS))


def _sums_read(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(documents, their sums) of a message."""
    steps, sums = unpack(data)
    return _sums(steps).astype(np.int64), sums / -float(SUM_STEPS)


def _documents(scored: DataFrame, kind: str, n: int) -> DataFrame:
    """One row for each document, from its block's row and the shards' sums."""
    schema = (
        f"doc_id {kind}, trained boolean, n_tokens long, n_known long, train_tokens long, "
        "base_score double, score double"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, total = None, np.zeros(0)  # a block's own row comes first
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1)
                data = row.column(1)[0].as_py()
                if row.column(2)[0].is_valid:
                    if head is not None:
                        yield rows(head, total)
                    head, total = row, np.frombuffer(data, "<f8").reshape(4, -1)[3].copy()
                else:
                    docs, sums = _sums_read(data)
                    total[docs] += sums
        if head is not None:
            yield rows(head, total)

    def rows(head: pa.RecordBatch, total: np.ndarray) -> pa.RecordBatch:
        base, known, lengths, _ = np.frombuffer(head.column(1)[0].as_py(), "<f8").reshape(4, -1)
        return pa.RecordBatch.from_arrays(
            [
                head.column(2)[0].values, head.column(3)[0].values, pa.array(lengths.astype(np.int64)),
                pa.array(known.astype(np.int64)), pa.array(np.full(len(base), n)), pa.array(base), pa.array(total),
            ],
            ["doc_id", "trained", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
        )

    dealt = scored.repartition("block").sortWithinPartitions("block", F.col("ids").isNull())
    return dealt.mapInArrow(run, schema)


def score(
    docs: DataFrame,
    learn: Column,
    doc_id: str = "doc_id",
    text: str = "text",
    block_tokens: int = BLOCK_TOKENS,
    shard_tokens: int = SHARD_TOKENS,
    vocabulary_shard: int = VOCABULARY_SHARD,
) -> DataFrame:
    """doc_id, trained, n_tokens, n_known, train_tokens, base_score and score of all documents, by a
    model of those for which ``learn`` is true."""
    spark = docs.sparkSession
    kind = docs.schema[doc_id].dataType.simpleString()
    given = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.coalesce(learn, F.lit(False)).alias("train"))
    path = fresh_folder(spark, "lm-blocks")
    _blocks(given, kind, block_tokens).write.option("compression", "uncompressed").parquet(path)
    blocks = spark.read.parquet(path)
    sums = blocks.agg(F.sum("n_words"), F.sum("n_tokens"), F.sum("n_train"), F.sum(F.size("ids"))).head()
    n_words, n_tokens, n, n_texts = (int(x or 0) for x in sums)
    answers = _kept(_vocabulary(blocks, max(1, -(-n_words // vocabulary_shard)), shard_tokens), "lm-vocabulary")
    v = int(answers.agg(F.sum("known")).head()[0] or 0)
    columns = ["block", "shard", "data"]
    level = lambda rows, k: rows.select(F.lit(k).alias("level"), *columns)
    every = level(answers, 1)
    none = np.zeros(0, np.uint64)
    words = [np.frombuffer(r[0], np.uint64) for r in answers.where("length(often) > 0").select("often").collect()]
    words = np.sort(np.concatenate([none, *words, np.array([_BEFORE] if n_texts > shard_tokens else none, np.uint64)]))
    frequent = Frequent(words, none, none, none, none)
    counted_kinds = [0] * 4  # of the bigrams and trigrams that no shard has all of: those found once, twice
    if len(words):
        counted = max(1, -(-n_tokens // vocabulary_shard))
        found = _kept(_counted(blocks, frequent.bigrams, counted, shard_tokens), "lm-bigrams")
        pairs, pair_counts, word_kinds = _often(found, len(words))
        every = every.union(level(found, 2))
        counted_kinds[:2] = word_kinds[1:, words != _BEFORE].sum(axis=1).tolist()
        frequent = Frequent(words, word_kinds[0], pairs, none, pair_counts)
        if len(pairs):
            found = _kept(_counted(blocks, frequent.trigrams, counted, shard_tokens), "lm-trigrams")
            every = every.union(level(found, 3))
            pair_kinds = _often(found, len(pairs))[2]
            counted_kinds[2:] = pair_kinds[1:].sum(axis=1).tolist()
            frequent = Frequent(words, word_kinds[0], pairs, pair_kinds[0], pair_counts)
    grouped = every.groupBy("block").agg(F.collect_list(F.struct("level", "shard", "data")).alias("answers"))
    shards = max(1, -(-6 * n_tokens // (5 * shard_tokens)))
    kept = blocks if len(words) else blocks.withColumn("words", F.lit(b""))
    sent = _sent(kept.join(grouped, "block"), kind, n, v, shards, shard_tokens, frequent)
    dealt = by_shard(sent, shards)
    names = ("ones2", "twos2", "ones3", "twos3")
    kinds = _kinds_found(dealt).agg(*[(F.coalesce(F.sum(c), F.lit(0)) + k).alias(c) for c, k in zip(names, counted_kinds)])
    return _documents(_scored(dealt, kinds, kind, n, v), kind, n)


def _kept(rows: DataFrame, name: str) -> DataFrame:
    path = fresh_folder(rows.sparkSession, name)
    rows.write.option("compression", "uncompressed").parquet(path)
    return rows.sparkSession.read.parquet(path)
