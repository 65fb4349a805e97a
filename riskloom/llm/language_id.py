"""Language identification by interpolated Kneser-Ney character models, one per language.

A model is an array of sorted n-gram hashes with the n-gram's log probability and the log weight it
passes on as a context. Words are runs of letters in lower case, closed at both ends; characters
are predicted from at most ``ORDER - 1`` before them in the word. A text gets the language with the
lowest cross-entropy per character. What is calibrated on labelled texts that the models have not
seen: the temperature that turns the differences into a probability, the usual cross-entropy of a
language's texts, that of the same letters in random order, and how it varies with the length. A
text nearer to random letters than to its language is rejected; one of several languages is not.

The models learn from a bounded sample of distinct labelled texts: of each language the first ones
by hash, up to its share of ``SAMPLE_CHARS`` characters, but ``LEAST_TEXTS`` at least, cut to that
share together. Copies of a text count once. Each distinct word of a batch is scored once. There may
be any number of languages: words and texts are scored in groups, so that no more than
``HELD_SCORES`` scores are held beside the models. A run of letters of any length is one word; one of
more than ``PIECE_LETTERS`` is scored in pieces.

Defined results: a null text or one without a letter is ``und`` with score 0 and rejected; a row
without language is not learned from but predicted; repeated rows get the same result; without
any labelled text every row is ``und``. Other columns are passed over by ``predict`` and kept by
``accepted``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache
from itertools import groupby
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from riskloom.llm.batches import free_name, hash_slices, mixed, ragged
from riskloom.session import fresh_folder

UNKNOWN = "und"
ORDER = 5
SAMPLE_CHARS = 8_000_000
LEAST_TEXTS = 5
GROUP_CHARS = 1 << 20
KNOWN_WORDS = 1 << 20
#: Scores, of words or texts under each model, that are held at once.
HELD_SCORES = 1 << 23
#: A longer run of letters is scored in pieces of so many, each after the letters before it.
PIECE_LETTERS = 1 << 17
#: Bound on the characters that any language's model keeps some probability for.
ALPHABET = 1 << 12
#: A text is rejected when its cross-entropy lies beyond this part of the way from a language's usual
#: one to that of its letters in random order, and beyond so many standard errors for its length.
REJECT_AT = 0.65
ERRORS = 4.0
_BUCKET_BITS = 12
_BEGIN, _END = 2, 3
_K = np.uint64(0x9E3779B97F4A7C15)


@cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def words_of_texts(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(code points, row, start, end) of the words of lower-cased texts."""
    joined = "\x00".join((t or "").replace("\x00", " ") for t in texts).lower()
    points = np.frombuffer(joined.encode("utf-32-le") + bytes(8), "<u4")
    size = len(points) - 2
    flags = _letters()[points[:size]]
    none = np.zeros(1, bool)
    edges = np.flatnonzero(np.concatenate((flags, none)) != np.concatenate((none, flags)))
    starts, ends = edges[::2], edges[1::2]
    rows = np.searchsorted(np.flatnonzero(points[:size] == 0), starts)
    return points, rows, starts, ends


def _grams(points: np.ndarray, starts: np.ndarray, ends: np.ndarray, order: int):
    """Closed words as one array, and for n = 1 .. order the hashes of the n-grams ending at each
    place; 0 where the word has not so many characters there."""
    sizes = ends - starts + 2
    firsts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    flat = np.full(int(sizes.sum()), _END, np.uint64)
    flat[firsts] = _BEGIN
    flat[ragged(firsts + 1, sizes - 2)] = points[ragged(starts, ends - starts)]
    place = np.arange(len(flat)) - np.repeat(firsts, sizes)
    return flat, place, firsts, sizes, _gram_hashes(flat, place, order)


def _gram_hashes(flat: np.ndarray, place: np.ndarray, order: int) -> list[np.ndarray]:
    hashes = [mixed(flat * _K + np.uint64(1))]
    for n in range(2, order + 1):
        h = np.zeros(len(flat), np.uint64)
        valid = np.flatnonzero(place >= n - 1)
        h[valid] = mixed(hashes[-1][valid] * _K + flat[valid - n + 1] * np.uint64(n) + np.uint64(n))
        hashes.append(h)
    return hashes


@dataclass
class CharModel:
    keys: np.ndarray
    log_p: np.ndarray
    log_weight: np.ndarray

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(self.keys, hashes)
        at[at == len(self.keys)] = 0
        return at, self.keys[at] == hashes


def train(points: np.ndarray, starts: np.ndarray, ends: np.ndarray, counts: np.ndarray, order: int = ORDER) -> CharModel:
    """The interpolated Kneser-Ney model of words with their counts."""
    _, place, _, sizes, hashes = _grams(points, starts, ends, order)
    weight = np.repeat(counts.astype(float), sizes)
    predicted = place >= 1
    kept_keys, kept_p, contexts, weights = [], [], [], []
    lower_keys, lower_p = np.zeros(0, np.uint64), np.zeros(0)
    for n in range(1, order + 1):
        valid = np.flatnonzero(predicted & (place >= n - 1))
        if not len(valid):
            break
        keys, first, inverse = np.unique(hashes[n - 1][valid], return_index=True, return_inverse=True)
        at = valid[first]
        seen = np.bincount(inverse, weights=weight[valid])
        if n < order:
            # Distinct characters before the n-gram; one that begins a word has none and keeps its count.
            inner = np.flatnonzero(predicted & (place >= n))
            _, distinct = np.unique(hashes[n][inner], return_index=True)
            before = np.bincount(np.searchsorted(keys, hashes[n - 1][inner[distinct]]), minlength=len(keys))
            seen = np.where(place[at] == n - 1, seen, before)
        ones, twos = (seen == 1).sum(), (seen == 2).sum()
        discount = ones / (ones + 2 * twos) if ones and twos else 0.5
        context = hashes[n - 2][at - 1] if n > 1 else np.zeros(len(at), np.uint64)
        context_keys, group = np.unique(context, return_inverse=True)
        total = np.bincount(group, weights=seen)
        passed = discount * np.bincount(group) / total
        if n > 1:
            below = lower_p[np.searchsorted(lower_keys, hashes[n - 2][at])]
        else:
            below = np.full(len(at), 1 / ALPHABET)
        p = np.maximum(seen - discount, 0) / total[group] + passed[group] * below
        kept_keys.append(keys)
        kept_p.append(np.log(p))
        contexts.append(context_keys)
        weights.append(np.log(passed))
        lower_keys, lower_p = keys, p
    # A context may never be predicted itself (the word's begin), so both sets of keys are joined.
    keys = np.unique(np.concatenate(kept_keys + contexts))
    log_p, log_weight = np.full(len(keys), np.nan), np.zeros(len(keys))
    for k, p in zip(kept_keys, kept_p):
        log_p[np.searchsorted(keys, k)] = p
    for k, w in zip(contexts, weights):
        log_weight[np.searchsorted(keys, k)] = w
    return CharModel(keys, log_p.astype(np.float32), log_weight.astype(np.float32))


def _gram_scores(models: list[CharModel], hashes: list[np.ndarray], place: np.ndarray, at: np.ndarray, order: int) -> Iterator[np.ndarray]:
    """Log probability of the character at each place ``at``, under one model after the other."""
    longest = np.minimum(place[at] + 1, order)
    window = np.zeros(len(at), np.uint64)
    for n in range(2, order + 1):
        here = longest == n
        window[here] = hashes[n - 1][at[here]]
    _, first, inverse = np.unique(window, return_index=True, return_inverse=True)
    at, longest = at[first], longest[first]
    for model in models:
        passed, value = np.zeros(len(at)), np.full(len(at), np.nan)
        for n in range(order, 0, -1):
            todo = np.flatnonzero((longest >= n) & np.isnan(value))
            slot, found = model.find(hashes[n - 1][at[todo]])
            found &= ~np.isnan(model.log_p[slot])
            value[todo[found]] = passed[todo[found]] + model.log_p[slot[found]]
            rest = todo[~found]
            context = hashes[n - 2][at[rest] - 1] if n > 1 else np.zeros(len(rest), np.uint64)
            slot, found = model.find(context)
            passed[rest[found]] += model.log_weight[slot[found]]
        unseen = np.isnan(value)
        value[unseen] = passed[unseen] - np.log(ALPHABET)
        yield value[inverse]


def word_scores(models: list[CharModel], points: np.ndarray, starts: np.ndarray, ends: np.ndarray, order: int = ORDER) -> np.ndarray:
    """Log probability of each word under each model: words x models."""
    _, place, _, sizes, hashes = _grams(points, starts, ends, order)
    out = np.empty((len(starts), len(models)), np.float32)
    cuts = np.concatenate(([0], np.cumsum(sizes - 1)[:-1]))
    for m, value in enumerate(_gram_scores(models, hashes, place, np.flatnonzero(place >= 1), order)):
        out[:, m] = np.add.reduceat(value, cuts)
    return out


def long_word_scores(models: list[CharModel], points: np.ndarray, start: int, end: int, order: int = ORDER) -> np.ndarray:
    """The same of one word of any length, in pieces."""
    out = np.zeros(len(models))
    size = end - start + 2
    for low in range(1, size, PIECE_LETTERS):
        high = min(size, low + PIECE_LETTERS)
        begin = max(0, low - order + 1)
        flat = np.full(high - begin, _END, np.uint64)
        inner = points[start + max(begin, 1) - 1 : min(end, start + high - 1)]
        first = int(begin == 0)
        flat[first : first + len(inner)] = inner
        if first:
            flat[0] = _BEGIN
        place = np.arange(len(flat))
        hashes = _gram_hashes(flat, place, order)
        for m, value in enumerate(_gram_scores(models, hashes, place, np.arange(low - begin, len(flat)), order)):
            out[m] += value.sum()
    return out


class WordScorer:
    """Scores texts, keeping the scores of a bounded number of words."""

    def __init__(self, models: list[CharModel]) -> None:
        self.models = models
        self._forget()

    def _forget(self) -> None:
        self.keys, self.scores = np.zeros(0, np.uint64), np.zeros((0, len(self.models)), np.float32)

    def __call__(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(log probability of each text under each model, characters predicted)."""
        points, rows, starts, ends = words_of_texts(texts)
        out, n = np.zeros((len(texts), len(self.models))), np.zeros(len(texts), np.int64)
        if not len(starts):
            return out, n
        n[:] = np.bincount(rows, weights=ends - starts + 1, minlength=len(texts))
        long = ends - starts > PIECE_LETTERS
        for k in np.flatnonzero(long).tolist():
            out[rows[k]] += long_word_scores(self.models, points, int(starts[k]), int(ends[k]))
        rows, starts, ends = rows[~long], starts[~long], ends[~long]
        hashes = hash_slices(points.view(np.uint8), 4 * starts, 4 * ends)
        keys, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        step = max(1, HELD_SCORES // len(self.models))
        for low in range(0, len(keys), step):
            own = slice(low, low + step)
            scores = self._scores(keys[own], points, starts[first[own]], ends[first[own]], min(step, KNOWN_WORDS))
            here = slice(None) if step >= len(keys) else np.flatnonzero((inverse >= low) & (inverse < low + step))
            for m in range(len(self.models)):
                out[:, m] += np.bincount(rows[here], weights=scores[inverse[here] - low, m], minlength=len(texts))
        return out, n

    def _scores(self, keys: np.ndarray, points: np.ndarray, starts: np.ndarray, ends: np.ndarray, limit: int) -> np.ndarray:
        """Of words with sorted hashes, keeping those of up to ``limit`` words, or of these alone."""
        known = np.isin(keys, self.keys, assume_unique=True)
        if len(self.keys) + int((~known).sum()) > limit:
            self._forget()
            known[:] = False
        if not known.all():
            scores = word_scores(self.models, points, starts[~known], ends[~known])
            order = np.argsort(np.concatenate((self.keys, keys[~known])), kind="stable")
            self.keys = np.concatenate((self.keys, keys[~known]))[order]
            self.scores = np.concatenate((self.scores, scores))[order]
        return self.scores[np.searchsorted(self.keys, keys)]


@dataclass
class Identifier:
    """The models with what was calibrated."""

    languages: list[str]
    models: list[CharModel]
    temperature: float
    usual: np.ndarray  # cross-entropy of a language's texts
    noise: np.ndarray  # that of their letters in random order
    spread: np.ndarray  # standard deviation of one character

    def judge(self, scorer: WordScorer, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """(language, probability, rejected) of each text."""
        if not self.models:
            return [UNKNOWN] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool)
        log_p, n = scorer(texts)
        best = log_p.argmax(axis=1)
        score = _posterior(log_p, n, self.temperature)[np.arange(len(texts)), best]
        empty = n == 0
        rejected = empty | (self.excess(log_p, n, best) > 0)
        names = [UNKNOWN if e else self.languages[b] for b, e in zip(best.tolist(), empty.tolist())]
        return names, np.where(empty, 0.0, score), rejected

    def excess(self, log_p: np.ndarray, n: np.ndarray, best: np.ndarray) -> np.ndarray:
        """How far a text's cross-entropy lies beyond what is accepted for its length."""
        chars = np.maximum(n, 1)
        entropy = -log_p[np.arange(len(n)), best] / chars
        limit = self.usual[best] + REJECT_AT * (self.noise[best] - self.usual[best])
        return entropy - limit - ERRORS * self.spread[best] / np.sqrt(chars)


def _posterior(log_p: np.ndarray, n: np.ndarray, temperature: float) -> np.ndarray:
    """Differences of the cross-entropy, by the square root of the length."""
    scaled = temperature * log_p / np.sqrt(np.maximum(n, 1))[:, None]
    scaled -= scaled.max(axis=1, keepdims=True)
    e = np.exp(scaled)
    return e / e.sum(axis=1, keepdims=True)


def _sample(docs: DataFrame, learn: Column, text: str, lang: str, chars: int) -> list[tuple[str, str, bool]]:
    """(language, text, for calibration) of a sample of at most ``chars`` characters in all."""
    usable = learn & F.col(lang).isNotNull() & (F.length(text) > 0)
    labelled = docs.where(usable).select(
        F.col(lang).alias("lang"), F.col(text).alias("text"), F.length(text).alias("size"), F.xxhash64(text).alias("hash")
    )
    # Only lengths are grouped; a bucket of hashes holds about as many distinct texts as the others.
    distinct = labelled.groupBy("lang", "hash").agg(F.max("size").alias("size"))
    bucket = F.shiftrightunsigned(F.col("hash"), 64 - _BUCKET_BITS).alias("bucket")
    path = fresh_folder(docs.sparkSession, "language-hashes")
    distinct.select("*", bucket).write.parquet(path)
    distinct = docs.sparkSession.read.parquet(path)
    sizes = distinct.groupBy("lang", "bucket").agg(F.count("*").alias("texts"), F.sum("size").alias("n"))
    languages = sizes.select("lang").distinct().count()
    if not languages:
        return []
    share = max(LEAST_TEXTS, chars // languages)
    before = Window.partitionBy("lang").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    start = sizes.select(
        "lang", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("n_before"),
        F.coalesce(F.sum("texts").over(before), F.lit(0)).alias("texts_before"),
    )
    start = start.where((F.col("n_before") < share) | (F.col("texts_before") < LEAST_TEXTS))
    inside = distinct.join(F.broadcast(start), ["lang", "bucket"])
    order = Window.partitionBy("lang").orderBy("hash_order")
    inside = inside.withColumn("hash_order", F.struct("bucket", "hash"))
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    placed = inside.withColumn("n_before", F.coalesce(F.sum("size").over(earlier), F.lit(0))).withColumn("k", F.row_number().over(order))
    chosen = placed.where((F.col("n_before") < share) | (F.col("k") <= LEAST_TEXTS)).select("lang", "hash", "size", "k")
    picked = {(r["lang"], r["hash"]): r for r in chosen.collect()}
    room: dict[str, list[tuple[int, int, int]]] = {}
    for (name, key), r in picked.items():
        room.setdefault(name, []).append((r["k"], r["size"], key))
    limits = [(name, key, n) for name, own in room.items() for key, n in _shares(sorted(own), share)]
    wanted = docs.sparkSession.createDataFrame(limits, "lang string, hash long, take int")
    found = labelled.join(F.broadcast(wanted), ["lang", "hash"])
    held = F.pmod(F.xxhash64("text", F.lit("calibrate")), F.lit(5)) == 0
    # Copies are cut alike, so that one of them is kept on each side before the shuffle.
    cut = found.select("lang", "hash", F.substring("text", F.lit(1), F.col("take")).alias("text"), held.alias("held"))
    rows = cut.groupBy("lang", "hash").agg(F.min(F.struct("text", "held")).alias("one")).select("lang", "one.*").collect()
    return sorted((r[0], r[1], r[2]) for r in rows)


def _shares(own: list[tuple[int, int, int]], share: int) -> list[tuple[int, int]]:
    """(hash, characters) of a language's texts, given their place, size and hash: whole in their order
    while the rest of the first ``LEAST_TEXTS`` still have an equal part each."""
    out, left = [], share
    for k, size, key in own:
        take = min(size, left // max(1, min(LEAST_TEXTS, len(own)) - k + 1))
        if take:
            out.append((key, take))
            left -= take
    return out


def fit(docs: DataFrame, learn: Column, text: str = "text", lang: str = "lang", chars: int = SAMPLE_CHARS) -> Identifier:
    """Models and calibration from labelled documents for which ``learn`` is true."""
    sample = _sample(docs, learn, text, lang, chars)
    models, languages = [], []
    for name, rows in groupby(sample, key=lambda x: x[0]):  # sorted by language
        texts = [(t, held) for _, t, held in rows]
        own = [t for t, held in texts if not held] or [t for t, _ in texts]
        points, _, starts, ends = words_of_texts(own)
        if not len(starts):
            continue
        _, first, counts = np.unique(
            hash_slices(points.view(np.uint8), 4 * starts, 4 * ends), return_index=True, return_counts=True
        )
        models.append(train(points, starts[first], ends[first], counts))
        languages.append(name)
    learned = set(languages)
    held = [(x, t) for x, t, is_held in sample if is_held and x in learned]
    return _calibrated(languages, models, held)


def _calibrated(languages: list[str], models: list[CharModel], held: list[tuple[str, str]]) -> Identifier:
    k = len(models)
    out = Identifier(languages, models, 1.0, np.zeros(k), np.full(k, np.inf), np.ones(k))
    if not models or not held:
        return out
    scorer, number = WordScorer(models), {x: k for k, x in enumerate(languages)}
    grid = np.geomspace(0.01, 10, 61)
    losses = np.zeros(len(grid))
    parts = []
    for low, high in _groups([t for _, t in held], len(models)):
        log_p, n = scorer([t for _, t in held[low:high]])
        mixed_up, m = scorer([_shuffled(t, low + k) for k, (_, t) in enumerate(held[low:high])])
        keep = n > 0
        truth = np.array([number[x] for x, _ in held[low:high]])[keep]
        log_p, n, mixed_up, m = log_p[keep], n[keep], mixed_up[keep], m[keep]
        row = np.arange(len(n))
        losses += [-np.log(np.maximum(_posterior(log_p, n, t)[row, truth], 1e-12)).sum() for t in grid]
        parts.append((truth, n, -log_p[row, truth] / n, -mixed_up[row, truth] / m))
    truth, n, entropy, noise = (np.concatenate(x) for x in zip(*parts))
    if not len(n):
        return out
    out.temperature = float(grid[int(np.argmin(losses))])
    for k in range(len(models)):
        own = truth == k if (truth == k).any() else np.ones(len(n), bool)
        out.usual[k], out.noise[k] = np.median(entropy[own]), np.median(noise[own])
        out.spread[k] = max(1.0, float(np.median(np.abs(entropy[own] - out.usual[k]) * np.sqrt(n[own])) * 1.48))
    return out


def _shuffled(text: str, seed: int) -> str:
    """The text with its letters in random order."""
    letters = [c for c in text if c.isalpha()]
    np.random.default_rng(seed).shuffle(letters)
    left = iter(letters)
    return "".join(next(left) if c.isalpha() else c for c in text)


def predict(docs: DataFrame, identifier: Identifier, text: str = "text", name: str = "language") -> DataFrame:
    """The documents' columns and one more under ``name``, which it replaces: a struct of name, score
    and rejected."""
    docs = docs.drop(name)
    held = docs.sparkSession.sparkContext.broadcast(identifier)
    schema = docs.withColumn(name, F.lit(None).cast("struct<name:string,score:double,rejected:boolean>")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        identifier = held.value
        scorer = WordScorer(identifier.models)
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text)).to_pylist()
            names: list[str] = []
            scores, rejected = [np.zeros(0)], [np.zeros(0, bool)]
            for low, high in _groups(texts, len(identifier.models)):
                a, b, c = identifier.judge(scorer, texts[low:high])
                names += a
                scores.append(b)
                rejected.append(c)
            value = pa.StructArray.from_arrays(
                [pa.array(names, pa.string()), pa.array(np.concatenate(scores)), pa.array(np.concatenate(rejected))],
                ["name", "score", "rejected"],
            )
            yield batch.append_column(name, value)

    return docs.mapInArrow(run, schema)


def _groups(texts: list[str | None], models: int) -> Iterator[tuple[int, int]]:
    """Rows of about ``GROUP_CHARS`` characters and at most ``HELD_SCORES`` scores."""
    most = max(1, HELD_SCORES // max(models, 1))
    low, size = 0, 0
    for k, t in enumerate(texts):
        size += len(t or "")
        if size >= GROUP_CHARS or k + 1 - low >= most:
            yield low, k + 1
            low, size = k + 1, 0
    if low < len(texts):
        yield low, len(texts)


def accepted(docs: DataFrame, identifier: Identifier, **options: Any) -> DataFrame:
    """The documents that are not rejected."""
    name = free_name(docs.columns, "language")
    judged = predict(docs, identifier, name=name, **options)
    return judged.where(~F.col(name)["rejected"]).select(*docs.columns)
