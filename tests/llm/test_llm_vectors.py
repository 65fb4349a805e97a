"""Searches over vectors against plain versions."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.llm import hard_negatives, pivot_index, vectors

SCHEMA = "vec_id long, embedding array<float>, label int"


def whole(vector):
    """floor(256 x) of each component, or None if the vector takes no part."""
    if vector is None or any(x is None or not math.isfinite(x) or not abs(256.0 * x) < 2.0**63 for x in vector):
        return None
    return [math.floor(256.0 * x) for x in vector]


def dot(a, b):
    return max(-(2**63), min(2**63 - 1, sum(x * y for x, y in zip(a, b))))


def order(pair):
    score, vec_id = pair[0], pair[1]
    return (-score, vec_id is None, vec_id)


def plain_top(rows, k=5, every=50):
    kept = [(i, v) for i, vec, _ in rows if (v := whole(vec)) is not None]
    out = []
    for n, (i, v) in enumerate(kept):
        if i is None or i % every:
            continue
        found = sorted(((dot(v, w), j) for m, (j, w) in enumerate(kept) if m != n), key=order)
        out += [(i, r + 1, j, s) for r, (s, j) in enumerate(found[:k])]
    return sorted(out, key=repr)


def plain_negatives(rows, mining=hard_negatives.Mining(), every=50):
    kept = [(i, v, c) for i, vec, c in rows if c is not None and (v := whole(vec)) is not None]
    out = []
    for n, (i, v, c) in enumerate(kept):
        if i is None or i % every:
            continue
        scored = sorted(((dot(v, w), j, d) for m, (j, w, d) in enumerate(kept) if m != n), key=order)
        for ps, p, _ in [x for x in scored if x[2] == c][: mining.positives]:
            fit = [x for x in scored if x[2] != c and mining.least * ps <= 100 * x[0] <= mining.most * ps]
            out += [(i, p, r + 1, j, ps, ns) for r, (ns, j, _) in enumerate(fit[: mining.negatives])]
    return sorted(out, key=repr)


def awkward_rows():
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(6, 12))
    rows = [
        (k, (centres[k % 6] + 0.4 * rng.normal(size=12)).astype(np.float32).tolist(), int(k % 4)) for k in range(300)
    ]
    hot = rng.normal(size=12).astype(np.float32).tolist()
    rows += [(1000 + k, hot, k % 3) for k in range(150)]  # a third of all rows
    rows += [(350, hot, 1), (350, hot, 1), (350, rows[3][1], 2), (400, [0.0] * 12, 0), (450, [], 1), (500, hot[:5], 1)]
    rows += [(550, None, 1), (600, [1.0, None], 1), (650, [math.nan], 1), (700, [math.inf], 2), (None, hot, 1)]
    rows += [(None, hot, None), (750, hot, None), (-50, hot, 0), (800, [-x for x in hot], 1), (850, [200.0] * 12, 3)]
    rows += [(900, [3e4] * 12, 2), (950, [-3e6] * 12 + [1.0], 2)]
    return rows


@pytest.fixture(scope="module")
def awkward(spark):
    rows = awkward_rows()
    clashing = "score query distance pivot shard kind block ids numbers least v x w l rank".split()
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    return rows, df.select(*[F.lit("z").alias(c) for c in clashing], "*")


def answers(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("shard, directory", [(16_384, 100_000), (60, 100_000), (60, 0)])
def test_top_k_of_awkward_vectors(awkward, monkeypatch, shard, directory):
    rows, df = awkward
    monkeypatch.setattr(pivot_index, "SHARD_ROWS", shard)
    monkeypatch.setattr(pivot_index, "DIRECTORY_ROWS", directory)
    assert answers(pivot_index.top_k(df, F.pmod("vec_id", F.lit(50)) == 0)) == plain_top(rows)


def test_top_k_of_few_and_no_rows(spark):
    rows = [(0, [1.0, 2.0], 0), (50, [1.0, -2.0], 0), (51, [0.5, 0.5], 1)]
    query = F.pmod("vec_id", F.lit(50)) == 0
    assert answers(pivot_index.top_k(spark.createDataFrame(rows, SCHEMA), query)) == plain_top(rows)
    for few in (rows[:1], [], [(0, None, 1)]):
        df = pivot_index.top_k(spark.createDataFrame(few, SCHEMA), query)
        assert df.dtypes == [("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"), ("score", "bigint")]
        assert answers(df) == []


def test_scores_beyond_doubles(spark):
    rows = [(50 * k, [2.0**40 + 2.0**17 * k, 1.0 + k], k % 2) for k in range(4)] + [(201, [1e300], 0), (202, [1e17], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    assert answers(pivot_index.top_k(df, F.pmod("vec_id", F.lit(50)) == 0)) == plain_top(rows)


def test_annuli_bound_every_score():
    rng = np.random.default_rng(2)
    values = rng.integers(-300, 300, (2000, 8))
    pivots = pivot_index.find_pivots(values[:200].astype(float), 16)
    at, distance = vectors.nearest(values, pivots)
    by = np.lexsort((distance, at))
    annuli = pivot_index.Annuli(at[by], distance[by], vectors.norms(values[by]), most=32)
    queries = rng.integers(-300, 300, (50, 8))
    limit = pivot_index.bounds(queries, pivots, annuli.pivot, annuli.low, annuli.high, annuli.norm)
    scores = queries @ values[by].T
    for a, (low, high) in enumerate(zip(annuli.starts, annuli.ends)):
        assert (scores[:, low:high].max(axis=1) <= limit[:, a]).all()
        assert len(set(at[by][low:high])) == 1 and high - low <= 32


def test_search_stops_by_its_bounds(spark):
    """On clustered vectors most annuli are never scored."""
    rng = np.random.default_rng(4)
    centres = 40 * rng.normal(size=(32, 16))
    values = np.floor(256 * (centres[np.arange(6400) % 32] + rng.normal(size=(6400, 16)))).astype(np.int64)
    pivots = pivot_index.find_pivots(values[:1024].astype(float), 32)
    at, distance = vectors.nearest(values, pivots)
    by = np.lexsort((distance, at))
    row = {
        "ids": by.tolist(), "wanted": b"\0" * 6400, "labels": np.zeros(6400, "<i8").tobytes(),
        "keys": np.array([at[by], distance[by]]).astype("<f8").tobytes(), "block": 0,
        "vectors": values[by].astype("<i4").tobytes(), "dim": 16, "width": 4,
    }
    shard = vectors.Shard([row])
    annuli = pivot_index._annuli(shard)
    made = []
    real = vectors.products
    pivot_index.vectors.products = lambda a, b: made.append(len(a) * len(b)) or real(a, b)
    try:
        best = pivot_index.expand(shard, annuli, pivots, values[:64], np.full(64, np.iinfo(np.int64).min), 5)
    finally:
        pivot_index.vectors.products = real
    assert sum(made) < 0.2 * 64 * 6400
    for q in range(64):
        scores = values @ values[q]
        wanted = sorted(zip((-scores).tolist(), range(6400)))[:5]
        mine = best.held[0][0] == q
        assert [(-s, i) for s, i in zip(best.held[0][1][mine].tolist(), best.held[0][2][mine].tolist())] == wanted


@pytest.mark.parametrize("blocks", [4, 1])
def test_negatives_of_awkward_vectors(awkward, monkeypatch, blocks):
    rows, df = awkward
    monkeypatch.setattr(hard_negatives, "SHARD_BLOCKS", blocks)
    monkeypatch.setattr(hard_negatives, "STEP", 7)
    monkeypatch.setattr(hard_negatives, "GROUP", 5)
    monkeypatch.setattr(hard_negatives, "SLAB", 2)
    found = answers(hard_negatives.mine(df, F.pmod("vec_id", F.lit(50)) == 0, F.col("label")))
    assert found == plain_negatives(rows) and found


def test_other_shares_and_counts(awkward):
    rows, df = awkward
    mining = hard_negatives.Mining(positives=2, negatives=7, least=10, most=100)
    found = answers(hard_negatives.mine(df, F.pmod("vec_id", F.lit(50)) == 0, F.col("label"), mining=mining))
    assert found == plain_negatives(rows, mining) and found


def test_negatives_of_few_and_no_rows(spark):
    query = F.pmod("vec_id", F.lit(50)) == 0
    rows = [(0, [1.0, 2.0], 0), (1, [1.0, 2.1], 0), (2, [0.9, 0.9], 1), (50, [5.0, 5.0], 2)]
    found = answers(hard_negatives.mine(spark.createDataFrame(rows, SCHEMA), query, F.col("label")))
    assert found == plain_negatives(rows) and len(found) == 1
    for few in ([], rows[:1], rows[1:3], [(0, [1.0], None)]):
        df = hard_negatives.mine(spark.createDataFrame(few, SCHEMA), query, F.col("label"))
        assert [c.split()[0] for c in hard_negatives.RESULT.split(", ")] == df.columns and answers(df) == []


def test_shared_list_bounds_its_members():
    rng = np.random.default_rng(9)
    values = rng.integers(-400, 400, (1500, 6))
    row = {
        "ids": list(range(1500)), "wanted": b"\0" * 1500, "labels": np.zeros(1500, "<i8").tobytes(), "keys": b"",
        "block": 0, "vectors": values.astype("<i4").tobytes(), "dim": 6, "width": 4,
    }
    members = np.floor(256 * (rng.normal(size=6) + 0.1 * rng.normal(size=(40, 6)))).astype(np.int64)
    listed = hard_negatives.SharedList(vectors.Shard([row]), members)
    assert (np.diff(listed.bound) <= 0).all()
    scores = members @ values[listed.order].T
    assert (scores <= listed.own[:, None] * listed.bound + listed.slack[:, None]).all()
    best = vectors.Best(np.full((40, 1), -(2**62)), np.full((40, 1), 2**62), 5)
    listed.walk(best, np.arange(40), listed.order, listed.bound, lambda m, at: True)
    assert listed.visited < 0.7 * 40 * 1500  # certified before the end of the list
    assert (np.sort(scores, axis=1)[:, -5] == best.least()).all()
