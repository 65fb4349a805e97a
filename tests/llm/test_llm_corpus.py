"""Operators on whole tables against plain versions."""

from __future__ import annotations

import collections
import math

import llm_brute as brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.llm import elias_fano, language_id, ngram_trie, simhash, suffix_dedup, url_filter, warc
from riskloom.llm.queries import remainder_of_id

from helpers import final_plan


def by_id(rows, names):
    return sorted((tuple(r[n] for n in names) for r in rows), key=repr)


# --- language-model scoring ---


@pytest.mark.parametrize("n, universe", [(0, 5), (1, 1), (5, 5), (1000, 1200), (1000, 1 << 20), (300, 1 << 60)])
def test_elias_fano_against_a_list(n, universe):
    rng = np.random.default_rng(n)
    values = np.sort(rng.integers(0, universe, n).astype(np.uint64))
    coded = elias_fano.EliasFano.of(values, universe)
    if n:
        at = rng.integers(0, n, 500)
        assert (coded.get(at) == values[at]).all()
    asked = np.concatenate((values, rng.integers(0, universe, 200).astype(np.uint64)))
    place, found = coded.find(asked)
    assert (found == np.isin(asked, values)).all()
    assert (place == np.searchsorted(values, asked)).all()
    if n == 1000 and universe == 1 << 20:
        assert coded.low.nbytes + coded.high.nbytes < n * 2  # about log2(universe / n) + 2 bits each


def test_trie_against_dictionaries(tmp_path):
    rng = np.random.default_rng(3)
    size = 40
    log_p1 = np.log10(rng.dirichlet(np.ones(size)))
    triples = np.unique(rng.zipf(1.5, (4000, 3)) % size, axis=0)
    triples = triples[np.lexsort((triples[:, 2], triples[:, 1], triples[:, 0]))]
    counts = rng.integers(1, 6, len(triples))
    w2, w1, w3 = triples.T
    ngram_trie.NGramTrie.build(w2, w1, w3, counts, log_p1).save(str(tmp_path))
    trie = ngram_trie.NGramTrie.open(str(tmp_path))
    assert isinstance(trie.sequences["thirds"].high, np.memmap)
    pair, third = collections.Counter(), collections.Counter()
    for (a, b, c), n in zip(triples.tolist(), counts.tolist()):
        pair[a, c] += n
        third[a, b, c] += n
    d2, d3 = (ngram_trie._discount(np.array(list(x.values()))) for x in (pair, third))

    def prob(a, b, c):
        p = 10 ** log_p1[c]
        own = {k: n for k, n in pair.items() if k[0] == a}
        if own:
            p = max(pair[a, c] - d2, 0) / sum(own.values()) + d2 * len(own) / sum(own.values()) * p
        own = {k: n for k, n in third.items() if k[:2] == (a, b)}
        if own:
            p = max(third[a, b, c] - d3, 0) / sum(own.values()) + d3 * len(own) / sum(own.values()) * p
        return p

    asked = rng.integers(0, size, (3000, 3))
    got = trie.score(*asked.T, log_p1[asked[:, 2]])
    expected = [math.log10(prob(*q)) for q in asked.tolist()]
    assert np.abs(got - expected).max() < 0.15 and abs((got - expected).mean()) < 0.01
    assert sum(prob(1, 1, c) for c in range(size)) == pytest.approx(1)


def scored(docs, **options):
    return ngram_trie.score(docs, remainder_of_id() != 1, **options)


@pytest.mark.parametrize("options", [{}, {"block_tokens": 500, "shard_tokens": 400, "vocabulary_shard": 900}])
def test_scores_of_awkward_texts(edge, options):
    rows, docs = edge
    found = scored(docs, **options).collect()
    tokens = [brute.WORD.findall(brute.low(t)) + [None] for _, t in rows]
    counts = collections.Counter(w for (i, _), ws in zip(rows, tokens) if brute.remainder(i) != 1 for w in ws)
    n, v = sum(counts.values()), len(counts)
    expected = []
    for (i, _), ws in zip(rows, tokens):
        base = sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws)
        expected.append((i, brute.remainder(i) != 1, len(ws), sum(counts[w] > 0 for w in ws), n, round(base, 6)))
    got = [(r["doc_id"], r["trained"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in found]
    assert sorted(got, key=repr) == sorted(expected, key=repr)
    held = [r for r in found if not r["trained"]]
    assert all(r["score"] < 0 for r in found) and held
    assert sum(r["score"] for r in found) > sum(r["base_score"] for r in found)


def test_held_out_text_is_likelier_than_by_words(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    held = scored(docs).where("not trained").agg(F.sum("score"), F.sum("base_score")).head()
    assert held[0] > held[1]


def test_distinct_trigrams_of_any_number_of_words():
    rng = np.random.default_rng(1)
    w2, w1, w3 = rng.integers(0, 9, (3, 2000))
    for size in (9, 1 << 21, 1 << 30):
        step = (size - 1) // 8
        *found, inverse = ngram_trie._distinct(w2 * step, w1 * step, w3 * step, size)
        assert np.stack(found).T.tolist() == sorted([a * step, b * step, c * step] for a, b, c in {*zip(w2.tolist(), w1.tolist(), w3.tolist())})
        assert (np.stack(found)[:, inverse] == np.stack([w2, w1, w3]) * step).all()


def test_shards_of_distinct_words(spark):
    words = F.transform(F.sequence(F.col("id") * 2000, F.col("id") * 2000 + 1999), F.hex)
    docs = spark.range(0, 1245, numPartitions=8).select(F.col("id").alias("doc_id"), F.concat_ws(" ", words).alias("text"))
    whole, parts = (
        {r["doc_id"]: r for r in scored(docs, **options).collect()} for options in ({}, {"shard_tokens": 200_000})
    )  # 2.5 million words over 2 and 15 shards
    assert len(whole) == len(parts) == 1245 and {r["n_tokens"] for r in whole.values()} == {2001}
    for k, r in whole.items():
        assert r["n_known"] == (2001 if r["trained"] else 1)
        assert r["score"] == pytest.approx(parts[k]["score"], rel=1e-3)
        assert (r["score"] > r["base_score"]) == r["trained"] or not r["trained"]


def test_scores_do_not_depend_on_shards_and_blocks(spark, edge):
    rng = np.random.default_rng(5)
    texts = [" ".join(f"w{k}" for k in rng.zipf(1.3, 60) % 50) for _ in range(60)] + ["w1 w1 w1 w1 " * 30] * 4 + ["", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").unionByName(edge[1].select("doc_id", "text"))
    found = []
    for parts, options in (
        (1, {}), (5, {"block_tokens": 300}), (3, {"shard_tokens": 2000}), (7, {"block_tokens": 500, "shard_tokens": 40, "vocabulary_shard": 300}),
    ):
        rows = scored(docs.repartition(parts), **options).collect()
        found.append(sorted((str(r["doc_id"]), r["n_tokens"], round(r["base_score"], 6), r["score"]) for r in rows))
    for other in found[1:]:
        assert [r[:3] for r in other] == [r[:3] for r in found[0]]
        assert [r[3] for r in other] == pytest.approx([r[3] for r in found[0]], abs=0.002, rel=1e-5)


def plain_scores(rows):
    """log10 probability of each text by interpolated absolute discounting with plain dictionaries."""
    tokens = [brute.WORD.findall(brute.low(t)) + [None] for _, t in rows]
    train = [ws for (i, _), ws in zip(rows, tokens) if brute.remainder(i) != 1]
    one = collections.Counter(w for ws in train for w in ws)
    two = collections.Counter(p for ws in train for p in zip(ws, ws[1:]))
    three = collections.Counter(p for ws in train for p in zip(["before", *ws], ws, ws[1:]))
    n, v = sum(one.values()), len(one)
    levels = []
    for grams in (two, three):
        kinds = collections.Counter(grams.values())
        total, distinct = collections.Counter(), collections.Counter()
        for gram, count in grams.items():
            total[gram[:-1]] += count
            distinct[gram[:-1]] += 1
        levels.append((grams, total, distinct, ngram_trie._discount_of(kinds[1], kinds[2])))
    out = []
    for ws in tokens:
        score = 0.0
        for k, w in enumerate(ws):
            p = (one[w] + 0.5) / (n + 0.5 * (v + 1))
            gram = tuple(["before", *ws][max(0, k - 1) : k + 2])
            for order, (grams, total, distinct, d) in enumerate(levels, 2) if k else ():
                before = gram[-order:-1]
                if total[before]:
                    p = (max(grams[gram[-order:]] - d, 0) + d * distinct[before] * p) / total[before]
            score += math.log10(p)
        out.append((score, len(ws)))
    return out


@pytest.mark.parametrize("options", [{}, {"block_tokens": 500, "shard_tokens": 40, "vocabulary_shard": 300}])
def test_scores_against_dictionaries(spark, edge, options):
    rng = np.random.default_rng(8)
    texts = [" ".join(f"W{k}" for k in rng.zipf(1.2, rng.integers(0, 80)) % 90) for _ in range(150)] + ["a b a b c"] * 5 + ["", None]
    rows = [*enumerate(texts), *((i, t) for i, t in edge[0] if i is not None and i >= len(texts))]
    found = scored(spark.createDataFrame(rows, "doc_id long, text string"), **options).collect()
    got = {r["doc_id"]: r["score"] for r in found}
    assert len(found) == len(rows)
    for (i, _), (expected, tokens) in zip(rows, plain_scores(rows)):
        assert got[i] == pytest.approx(expected, abs=0.002 + tokens * 0.001)


@pytest.mark.parametrize("options", [{}, {"block_tokens": 500, "shard_tokens": 40, "vocabulary_shard": 300}])
def test_discounts_come_from_all_bigrams_and_trigrams(spark, monkeypatch, options):
    rng = np.random.default_rng(11)
    rows = [(k, " ".join(f"w{x}" for x in rng.zipf(1.3, rng.integers(0, 60)) % 200)) for k in range(200)] + [(900 + k, "a b c a b") for k in range(80)]
    kept, made = [], ngram_trie._scored
    monkeypatch.setattr(ngram_trie, "_scored", lambda dealt, found, *a: kept.append(found) or made(dealt, found, *a))
    docs = scored(spark.createDataFrame(rows, "doc_id long, text string"), **options)
    train = [[*t.split(), None] for i, t in rows if brute.remainder(i) != 1]
    two = collections.Counter(p for ws in train for p in zip(ws, ws[1:]))
    three = collections.Counter(p for ws in train for p in zip(["before", *ws], ws, ws[1:]))
    kinds = [collections.Counter(grams.values()) for grams in (two, three)]
    assert tuple(kept[0].head()) == tuple(k[n] for k in kinds for n in (1, 2))
    assert docs.count() == len(rows)


def test_discounts_and_scores_read_one_shuffle(spark):
    docs = spark.createDataFrame([(k, f"a b c{k} a b") for k in range(40)], "doc_id long, text string")
    found = scored(docs, block_tokens=50, shard_tokens=40, vocabulary_shard=300)
    found.collect()
    plan = final_plan(found)
    assert "ReusedExchange" in plan.split("Initial Plan")[0]


def test_messages_are_bounded_by_tokens(spark, monkeypatch):
    kept = {}
    for name in ("_scored", "_documents"):
        made = getattr(ngram_trie, name)
        monkeypatch.setattr(ngram_trie, name, lambda rows, *a, name=name, made=made: kept.setdefault(name, rows) and made(rows, *a))
    found = []
    for n in (2_000, 8_000):
        kept.clear()
        text = F.concat_ws(" ", *(F.concat(F.lit("w"), F.pmod(F.xxhash64("id", F.lit(k)), F.lit(5000))) for k in range(19)))
        docs = spark.range(0, n, numPartitions=n // 500).select(F.col("id").alias("doc_id"), text.alias("text"))
        assert scored(docs, block_tokens=20_000, shard_tokens=4_000, vocabulary_shard=20_000).count() == n
        own = [kept[name].where("ids is null").agg(F.count("*"), F.sum(F.length("data"))).head() for name in ("_scored", "_documents")]
        found.append(own)
        assert own[1][1] <= 12 * 20 * n + 40 * own[1][0]  # a document and a sum for each token at most
    (sent, answered), (more, more_answered) = found
    assert more[0] > 8 * sent[0]  # blocks times shards
    assert more_answered[1] < 9 * answered[1]  # four times the tokens, less often two of a document together


def test_scoring_an_empty_table(no_docs):
    assert scored(no_docs).count() == 0


def test_scoring_without_training_text(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    rows = ngram_trie.score(docs, F.lit(False)).collect()
    assert [(r["train_tokens"], r["base_score"], r["n_known"]) for r in rows] == [(0, 0.0, 0)] * 2


# --- language identification ---


def test_character_model_against_a_plain_one():
    words = ["the", "then", "hen", "to", "été"]
    points, _, starts, ends = language_id.words_of_texts([" ".join(words)])
    counts = np.array([5, 2, 1, 3, 1])
    model = language_id.train(points, starts, ends, counts, order=3)
    padded = [(f"\2{w}\3", int(n)) for w, n in zip(words, counts)]
    seen = [collections.Counter() for _ in range(4)]
    for w, n in padded:
        for k in range(1, len(w)):
            for size in range(1, min(3, k + 1) + 1):
                seen[size][w[k - size + 1 : k + 1]] += n
    for size in (1, 2):  # continuation counts, but for n-grams that begin a word
        for g in seen[size]:
            if g[0] != "\2":
                seen[size][g] = len({h for h in seen[size + 1] if h[1:] == g})

    def discount(size):
        ones, twos = (sum(n == k for n in seen[size].values()) for k in (1, 2))
        return ones / (ones + 2 * twos) if ones and twos else 0.5

    def prob(context, c):
        size = len(context) + 1
        below = 1 / language_id.ALPHABET if size == 1 else prob(context[1:], c)
        own = {g: n for g, n in seen[size].items() if g[:-1] == context}
        if not own:
            return below
        d, total = discount(size), sum(own.values())
        return max(own.get(context + c, 0) - d, 0) / total + d * len(own) / total * below

    asked = ["the", "ten", "ohé", "zzz"]
    points, _, starts, ends = language_id.words_of_texts([" ".join(asked)])
    got = language_id.word_scores([model], points, starts, ends, order=3)[:, 0]
    expected = [
        sum(math.log(prob(w[max(0, k - 2) : k], w[k])) for k in range(1, len(w))) for w in (f"\2{x}\3" for x in asked)
    ]
    assert np.allclose(got, expected, atol=1e-4)


def test_held_out_accuracy_and_rejection(spark, tables, edge):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    remainder = remainder_of_id()
    models = language_id.fit(docs, remainder != 0)
    judged = language_id.predict(docs, models).where(remainder == 0).collect()
    right = sum(r["language"]["name"] == r["lang"] for r in judged)
    assert right >= 0.97 * len(judged) and sum(r["language"]["rejected"] for r in judged) <= 0.02 * len(judged)
    rows, awkward = edge
    found = language_id.predict(awkward.select("doc_id", "text", "score"), models).collect()
    assert len(found) == len(rows) and found[0]["score"] == 7
    letters = sum(any(c.isalpha() for c in t or "") for _, t in rows)
    assert {r["language"] for r in language_id.accepted(awkward, models).collect()} == {7}
    assert language_id.accepted(awkward, models).count() <= letters
    for r in found:
        letters = any(c.isalpha() for c in r["text"] or "")
        assert (r["language"]["name"] == "und") == (not letters) and 0 <= r["language"]["score"] <= 1
        assert letters or r["language"]["rejected"]
    strange = spark.createDataFrame([(1, "qxzj wvkq zzxq jjqx " * 40), (2, "日本語のテキスト " * 40)], "doc_id long, text string")
    assert language_id.accepted(strange, models).count() == 0


def own_words(k, n):
    """A text in the k-th of many languages, each with ten letters of its own."""
    rng = np.random.default_rng([k, n])
    letters = [chr(0x4E00 + 10 * k + j) for j in range(10)]
    return " ".join("".join(rng.choice(letters, 4)) for _ in range(6)) + " the same words"


def test_any_number_of_languages(spark, monkeypatch):
    rows = [(1001 * n + k, own_words(k, n), f"l{k:04}") for n in range(3) for k in range(1001)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    monkeypatch.setattr(language_id, "HELD_SCORES", 1 << 18)  # some groups of texts and words
    identifier = language_id.fit(docs.where("doc_id < 2002"), F.lit(True))
    assert len(identifier.models) == 1001
    found = language_id.predict(docs, identifier).select("lang", "language.name").collect()
    assert len(found) == 3003 and sum(r[0] == r[1] for r in found) > 2990


def small_models():
    models = []
    for text in ("the then hen to été ten to the", "abba aba bab baa"):
        points, _, starts, ends = language_id.words_of_texts([text])
        models.append(language_id.train(points, starts, ends, np.ones(len(starts))))
    return models


@pytest.mark.parametrize("held", [1, 5, 1000])
def test_scores_do_not_depend_on_groups(monkeypatch, held):
    models, texts = small_models(), ["the hen", None, "", "ten abba été the hen xyz", "q", "Ababa " * 9]
    expected, n = language_id.WordScorer(models)(texts)
    monkeypatch.setattr(language_id, "HELD_SCORES", held)
    groups = list(language_id._groups(texts, len(models)))
    assert [k for low, high in groups for k in range(low, high)] == list(range(6))
    scorer = language_id.WordScorer(models)
    got = [scorer(texts[low:high]) for low, high in groups]
    assert np.allclose(np.concatenate([x for x, _ in got]), expected) and np.concatenate([x for _, x in got]).tolist() == n.tolist()


@pytest.mark.parametrize("piece", [1, 3, 4, 7, 29, 30, 31, 32])
def test_long_words_in_pieces(monkeypatch, piece):
    models, texts = small_models(), ["thenabbahentotheabatenxyzthehen the", "x", "abbaabbaabbaabbaabbaabbaabbaab hen"]
    expected, n = language_id.WordScorer(models)(texts)
    monkeypatch.setattr(language_id, "PIECE_LETTERS", piece)
    got, m = language_id.WordScorer(models)(texts)
    assert np.allclose(got, expected) and n.tolist() == m.tolist()


def test_a_very_long_run_of_letters_stays_small():
    import tracemalloc

    text = "".join(np.random.default_rng(0).choice(list("abent"), 1000)) * 10_000
    scorer = language_id.WordScorer(small_models())
    tracemalloc.start()
    _, n = scorer([text])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n.tolist() == [10_000_001] and peak < 500 << 20


def test_language_without_labels(spark, no_docs, edge):
    models = language_id.fit(edge[1], F.lit(False))
    assert {r["language"]["name"] for r in language_id.predict(edge[1].select("text"), models).collect()} == {"und"}
    assert language_id.predict(no_docs, language_id.fit(no_docs, F.lit(True))).count() == 0


def test_copies_of_a_text_do_not_crowd_out_a_language(spark):
    en = [("en", brute.prose(k, 60)) for k in range(40)]
    hot = [("xx", "lorem ipsum " * 400)] * 400 + [("xx", f"żółw {k} gęś jaźń łódź " * 12) for k in range(40)]
    docs = spark.createDataFrame(en + hot, "lang string, text string").repartition(5)
    for chars in (6000, 20_000):
        sample = language_id._sample(docs, F.lit(True), "text", "lang", chars)
        assert sum(len(t) for _, t, _ in sample) <= chars
        own = [t for name, t, _ in sample if name == "xx"]
        assert len(own) == len(set(own)) >= language_id.LEAST_TEXTS and any("gęś" in t for t in own)
    models = language_id.fit(docs, F.lit(True), chars=6000)
    asked = spark.createDataFrame([("żółw gęś jaźń łódź",)], "text string")
    assert language_id.predict(asked, models).head()["language"]["name"] == "xx"


# --- suffix arrays ---


@pytest.mark.parametrize("text", [b"", b"a", b"abracadabra" * 40, b"a" * 700, bytes(range(256)) * 3, b"\0\0\0b\0\0\0b"])
def test_suffix_array_and_prefixes(text):
    data, depth = np.frombuffer(text, np.uint8), 50
    order = suffix_dedup.suffix_array(data, depth)
    padded = text + bytes(depth + 8)
    assert [padded[k : k + depth] for k in order] == sorted(padded[k : k + depth] for k in range(len(text)))
    assert sorted(order.tolist()) == list(range(len(text)))

    def shared(a, b):
        n = 0
        while n < depth and a + n < len(text) and b + n < len(text) and text[a + n] == text[b + n]:
            n += 1
        return n

    got = suffix_dedup.common_prefixes(data, order, depth, lanes=7)
    assert got.tolist() == [shared(a, b) if k else 0 for k, (a, b) in enumerate(zip([0, *order[:-1]], order))]


@pytest.mark.parametrize("options", [{}, {"block_bytes": 3000, "shard_hashes": 500}])
def test_repeats_of_awkward_texts(edge, options):
    rows, docs = edge
    found = suffix_dedup.remove_repeats(docs, **options).collect()
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    expected = [(i, *r) for (i, _), r in zip(rows, brute.repeats(rows))]
    assert by_id(found, names) == sorted(expected, key=repr)


def test_repeats_of_an_empty_table(no_docs):
    assert suffix_dedup.remove_repeats(no_docs).count() == 0


# --- SimHash ---


def test_near_duplicates_of_awkward_texts(edge):
    rows, docs = edge
    found = simhash.near_duplicates(docs).collect()
    values = [brute.simhash(t) for _, t in rows]
    roots = brute.components(values, 2)
    lowest = {}
    for (i, _), root in zip(rows, roots):
        ids = [x for x in (lowest.get(root), i) if x is not None]
        lowest[root] = min(ids) if ids else None
    expected = [(i, v, lowest[root]) for (i, _), v, root in zip(rows, values, roots)]
    got = [(r["doc_id"], r["fp"] % (1 << 64), r["component_id"]) for r in found]
    assert sorted(got, key=repr) == sorted(expected, key=repr)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns and kept.count() == len(set(roots))
    assert {r["riskloom_text_key"] for r in kept.collect()} == {7}


@pytest.mark.parametrize("limit", [4096, 64])
def test_links_of_dense_groups(spark, limit):
    rng = np.random.default_rng(5)
    centres = rng.integers(0, 1 << 63, 6, dtype=np.uint64)
    values = {int(c) ^ (1 << a) ^ (1 << b) for c in centres[:3] for a, b in rng.integers(0, 64, (120, 2)).tolist()}
    values |= {int(c) ^ int(rng.integers(0, 16)) for c in centres for _ in range(30)}
    values |= {int(x) for x in rng.integers(0, 1 << 63, 200, dtype=np.uint64)}
    values = sorted(v - (1 << 64) if v >> 63 else v for v in values)
    fps = spark.createDataFrame([(v,) for v in values], "fp long")
    got = {r["node"]: r["root"] for r in simhash.components(simhash.links(fps, 2, limit)).collect()}
    roots = brute.components([v % (1 << 64) for v in values], 2)
    expected = {v: values[r] for v, r in zip(values, roots) if values[r] != v}
    assert {k: v for k, v in got.items() if k != v} == expected


def test_gray_rank():
    rank = np.arange(64, dtype=np.uint64)
    assert (simhash.gray_rank(rank ^ (rank >> np.uint64(1))) == rank).all()


def test_simhash_of_an_empty_table(no_docs):
    assert simhash.near_duplicates(no_docs).count() == 0 and simhash.keep_one(no_docs).count() == 0


# --- WARC ---


def test_derivatives_round_trip(spark):
    page = "<html><head><title>A &amp; b</title><script>x</script></head><body><p>One<br>two <a href='/x?a=1&amp;b'>l</a></p><!-- no --></body></html>"
    rows = [(1, "http://h.org/a/b", page), (2, None, "<p>é"), (3, "http://h.org/", None), (3, "http://h.org/", None), (None, "no url", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("record", F.lit("x"))
    sources = warc.responses(pages)
    made = warc.derivatives(sources).collect()
    assert collections.Counter(r["record_type"] for r in made) == {"metadata": 5, "conversion": 5}
    originals = {r["id"]: list(warc.parse(bytes(r["record"])))[0] for r in sources.collect()}
    for r in made:
        (record,) = warc.parse(bytes(r["record"]))
        assert record.dump() == bytes(r["record"]) and list(warc.parse(record.member()))[0] == record
        source = originals[r["id"]]
        assert record.get("WARC-Refers-To") == source.get("WARC-Record-ID") == r["refers_to"]
        assert record.get("WARC-Target-URI") == source.get("WARC-Target-URI")
        assert record.get("WARC-Payload-Digest") == source.get("WARC-Payload-Digest")
        assert record.get("WARC-Block-Digest") == warc.digest(record.block)
        assert source.get("WARC-Payload-Digest") == warc.digest(warc.http_parts(source.block)[2])
    blocks = {(r["id"], r["record_type"]): list(warc.parse(bytes(r["record"])))[0].block.decode() for r in made}
    assert blocks[1, "conversion"] == "One\ntwo l"
    assert '"title": "A & b"' in blocks[1, "metadata"] and "http://h.org/x?a=1&b" in blocks[1, "metadata"]
    assert '["Content-Type", "text/html; charset=utf-8"]' in blocks[1, "metadata"]
    assert blocks[2, "conversion"] == "é" and blocks[3, "conversion"] == ""
    whole = b"".join(bytes(r["member"]) for r in warc.members(sources).collect())
    assert len(list(warc.parse(whole))) == 5
    assert warc.derivatives(warc.responses(pages.limit(0))).count() == 0
    with pytest.raises(ValueError):
        list(warc.parse(b"GET / HTTP/1.1\r\n\r\n"))


# --- URL filters ---

RULES = [
    url_filter.Rule("allow", "org", "/"),
    url_filter.Rule("block", "example.org", "/es/"),
    url_filter.Rule("allow", "com", "/fr/"),
]


def test_url_rules_and_mining(spark):
    good = [(f"http://www.site{k % 5}.net/en/{k}", False) for k in range(100)]
    bad = [(f"http://spam-farm.net/{k % 3}/x?utm_source=a", True) for k in range(40)]
    labelled = spark.createDataFrame(good + bad, "url string, blocked boolean")
    cases = {
        "http://a.org/x": ("a.org", "/x", "org/", "allow"),
        "http://EXAMPLE.org/es/1?q#f": ("example.org", "/es/1", "example.org/es/", "block"),
        "http://xexample.org/es/1": ("xexample.org", "/es/1", "org/", "allow"),
        "https://spam-farm.net/9/x?utm_source=b": ("spam-farm.net", "/9/x", None, "block"),
        "https://www.site1.net/en/7": ("www.site1.net", "/en/7", None, "allow"),
        "http://b.com?x=/fr/": ("b.com", "", None, "allow"),
        "x://y://z/fr/": ("y:", "//z/fr/", None, "allow"),
        "no url": ("", "", None, "allow"),
        "": ("", "", None, "allow"),
    }
    pages = spark.createDataFrame([*enumerate(cases), (99, None), (0, "http://a.org/x")], "page_id long, url string")
    pages = pages.select("*", *[F.lit("x").alias(c) for c in ("host", "path", "tokens", "set", "rule", "fixed")])
    found = url_filter.judge(pages, labelled, RULES).collect()
    urls = {**dict(enumerate(cases)), 99: ""}
    assert len(found) == len(cases) + 2
    for r in found:
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == cases[urls[r["page_id"]]], urls[r["page_id"]]
    none = url_filter.judge(pages, labelled.limit(0), []).collect()
    assert {r["verdict"] for r in none} == {"allow"} and {r["rule"] for r in none} == {None}
    assert url_filter.judge(pages.limit(0), labelled, RULES).count() == 0


def test_mined_rules_are_the_confident_ones(spark):
    rows = [(["a", "b"], True)] * 8 + [(["a", "c"], False)] * 6 + [(["b", "c"], True)] * 3 + [(["c"], False)] * 3
    found = url_filter.mine(spark.createDataFrame(rows, "tokens array<string>, blocked boolean"), 0.1, 0.55).collect()
    # a alone blocks 8 of 14, b always; a and b together are no better than b.
    assert {tuple(r["tokens"]): round(r["confidence"], 3) for r in found} == {("a",): round(8 / 14, 3), ("b",): 1.0}


def test_a_small_blocked_host_has_a_rule_at_any_size(spark):
    bad = [(f"http://rare-spam.net/x/{k}", True) for k in range(6)] + [("http://once.net/y/1", True)]
    for n in (60, 6000):  # 10 % and 0.1 % of the labels
        good = [(f"http://site{k % 7}.net/x/{k}", k % 3 == 0) for k in range(n)]
        labelled = spark.createDataFrame(good + bad, "url string, blocked boolean")
        pages = spark.createDataFrame(
            [(1, "http://rare-spam.net/z/9"), (2, "http://site1.net/x/1"), (3, "http://once.net/y/2")], "page_id long, url string"
        )
        found = url_filter.judge(pages, labelled, []).collect()
        assert {r["page_id"]: r["verdict"] for r in found} == {1: "block", 2: "allow", 3: "allow"}, n


def test_mined_rules_beat_the_base_rate(spark):
    rows = [(["all", "a"], True)] * 70 + [(["all", "a"], False)] * 30 + [(["all", "b"], True)] * 90 + [(["all", "b"], False)] * 10
    found = url_filter.mine(spark.createDataFrame(rows, "tokens array<string>, blocked boolean")).collect()
    assert [(r["tokens"], r["confidence"]) for r in found] == [(["b"], 0.9)]


def test_copies_of_a_long_url_end_in_time(spark):
    """Every word of six copies goes with the label; the sets of words are two to the power of forty."""
    words = [f"word{chr(97 + k // 26)}{chr(97 + k % 26)}" for k in range(40)]
    rows = [(f"http://x.org/{'/'.join(words)}", True)] * 6 + [(f"http://y.org/{w}x", False) for w in words]
    labelled = spark.createDataFrame(rows, "url string, blocked boolean")
    pages = spark.createDataFrame([(1, f"http://z.com/{words[7]}/a"), (2, "http://z.com/other")], "page_id long, url string")
    found = {r["page_id"]: r["verdict"] for r in url_filter.judge(pages, labelled, []).collect()}
    assert found == {1: "block", 2: "allow"}


def plain_rules(rows, confidence=0.6, count=5):
    """All sets of tokens, one by one."""
    import itertools

    base = sum(b for _, b in rows) / len(rows)
    general = set.intersection(*[set(t) for t, _ in rows]) if not all(b for _, b in rows) else set()
    rules = {}
    for tokens, blocked in rows:
        own = sorted(set(tokens) - general)
        for n in range(1, len(own) + 1) if blocked else ():
            for part in itertools.combinations(own, n):
                fits = [b for t, b in rows if set(part) <= set(t)]
                share = sum(fits) / len(fits)
                if sum(fits) >= count and share >= confidence and (share / base > 1 or share == 1):
                    rules[part] = share
    return {p: c for p, c in rules.items() if not any(set(q) < set(p) and rules[q] >= c for q in rules)}


@pytest.mark.parametrize("seed", range(3))
def test_mining_against_all_sets(spark, seed):
    rng = np.random.default_rng(seed)
    names = "abcdefg"
    rows = []
    for _ in range(60):
        own = [t for t in names if rng.random() < 0.45]
        own += ["twin " + t for t in own if t in "ab"]  # always go together
        rows.append((["every", *own], bool(rng.random() < (0.85 if "a" in own or {"c", "d"} <= {*own} else 0.2))))
    found = url_filter.mine(spark.createDataFrame(rows, "tokens array<string>, blocked boolean")).collect()
    expected = plain_rules(rows)
    assert {tuple(r["tokens"]) for r in found} == set(expected) and expected
    assert all(abs(r["confidence"] - expected[tuple(r["tokens"])]) < 1e-12 for r in found)
    assert len({r["rule"] for r in found}) == len(found)


def plain_page(page):
    """(text, title, links) by patterns that may look to the end of the page from every tag."""
    import html
    import re

    dropped = re.compile(r"<!--.*?-->|<(script|style|template|noscript|head)\b[^>]*>.*?</\1\s*>|<!doctype[^>]*>", re.S | re.I)
    link = re.compile(r"<(a|area|link|img|script|iframe)\b[^>]*?\s(href|src)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
    body = re.sub("<[^>]+>", "", warc._BREAKS.sub("\n", dropped.sub(" ", page).replace("\n", " ")))
    body = re.sub(r"[^\S\n]+", " ", html.unescape(body))
    named = re.search(r"<title\b[^>]*>(.*?)</title\s*>", page, re.S | re.I)
    found = [
        {"path": f"{m[1].lower()}@/{m[2].lower()}", "url": html.unescape(next(x for x in m.groups()[2:] if x is not None))}
        for m in link.finditer(page)
    ]
    return re.sub(r"[^\S\n]*\n\s*", "\n", body).strip(), " ".join(html.unescape(named[1]).split()) if named else "", found


def test_pages_in_one_pass_equal_the_patterns():
    rng = np.random.default_rng(11)
    bits = (
        "<|>|<a |<a href=x|<a href=\"b>c\" |<img src='d' x>|</a>|<!--|-->|<script>|<script src=e>|</script >|</SCRIPT>|<style|</style>|"
        "<head>|</head>|<title>|</title>|<TITLE x>|<!doctype html>|<!DOCTYPE|<p>|</div>|<br/>| href=|\"|'| src = f|text|&amp;|\n| |head"
    ).split("|")
    for _ in range(6000):
        page = "".join(rng.choice(bits, rng.integers(1, 25)))
        assert (warc.plain_text(page), warc.title(page), warc.links(page, None)) == plain_page(page), page


@pytest.mark.parametrize("bit", ["<a ", "<", "<script>", "<!--", "<title>", "<a href=", "<style x", "<!doctype ", "<p ", "</script ", "&", "<a href='"])
def test_a_megabyte_of_one_opening_ends_in_time(bit):
    import time

    begun = time.process_time()
    page = bit * ((1 << 20) // len(bit))
    for whole in (page, page + ">"):
        warc.plain_text(whole), warc.title(whole), warc.links(whole, "http://x.org/")
    assert time.process_time() - begun < 20
