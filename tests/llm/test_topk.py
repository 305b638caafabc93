import math

import numpy as np
import pytest
from helpers_llm import CLASH

from tidemark.llm import topk
from tidemark.llm.topk import LONG, NOBODY, SortedLists, search, top_inner_products


def brute(rows, k=5, every=50):
    def whole(v):
        if v is None or any(x is None or not math.isfinite(x) for x in v):
            return None
        return [min(max(math.floor(256 * x), LONG.min), LONG.max) for x in v]

    vectors = [(i, n, whole(v)) for n, (i, v) in enumerate(rows)]
    vectors = [r for r in vectors if r[2] is not None]
    out = []
    for i, n, q in vectors:
        if i is not None and i % every == 0:
            scores = [(-min(max(sum(a * b for a, b in zip(q, v)), LONG.min + 1), LONG.max), j is None, j or 0) for j, m, v in vectors if m != n]
            out += [(i, rank + 1, None if null else j, -s) for rank, (s, null, j) in enumerate(sorted(scores)[:k])]
    return sorted(out, key=str)


def got(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    for name in [*CLASH, "v", "query_id", "rank", "x"]:
        df = df.selectExpr("*", f"'x' as {name}")
    found = top_inner_products(df)
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    return sorted(map(tuple, found.collect()), key=str)


def test_brute_force_with_awkward_vectors(spark):
    pick = np.random.default_rng(3)
    rows = [(i, pick.normal(0, 0.1, 8).astype("f4").tolist()) for i in range(230)]
    rows += [(i, [0.25] * 8) for i in range(300, 360)] + [(350, [0.25] * 8), (100, [0.5]), (None, [0.25] * 8), (None, None)]
    rows += [(400, None), (401, [None] * 8), (402, [float("nan")] * 8), (450, [float("inf")] + [0.0] * 7), (500, []), (501, [0.0, -1.0])]
    assert got(spark, rows) == brute(rows)


def test_numbers_beyond_floats(spark):
    rows = [(i, [2.0 ** (i % 60), -(2.0 ** (i % 41)), float(i)]) for i in range(130)]
    assert got(spark, rows) == brute(rows)


def test_few_and_no_rows(spark):
    assert got(spark, [(0, [1.0]), (1, [2.0])]) == [(0, 1, 1, 256 * 512)]
    assert got(spark, [(0, [1.0])]) == []
    assert got(spark, [(0, None)]) == [] and top_inner_products(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


@pytest.mark.parametrize("copies", [0, 2_500])
def test_lists_stopped_early_give_the_same(monkeypatch, copies):
    monkeypatch.setattr(topk, "SHARD", 2_000)
    resolved = []
    plain = topk._resolve
    monkeypatch.setattr(topk, "_resolve", lambda k, few, *rest: (resolved.append(len(few[0])), plain(k, few, *rest)))
    pick = np.random.default_rng(4)
    vectors = np.floor(pick.normal(0, 32, (7_000, 24))).astype(np.int64)
    vectors[pick.choice(7_000, copies, replace=False)] = vectors[0]
    rows = pick.permutation(7_000)
    asked = np.arange(0, 7_000, 9)
    scores, places = search(5, rows, vectors, rows[asked], vectors[asked], rows)
    exact = vectors[asked] @ vectors.T
    exact[np.arange(len(asked)), asked] = LONG.min
    best = np.lexsort((np.broadcast_to(np.arange(7_000), exact.shape), ~exact), axis=1)[:, :5]
    assert (places == best).all() and (scores == np.take_along_axis(exact, best, 1)).all()
    assert sum(resolved) > len(asked)  # and few of the 7,000 per query
    assert sum(resolved) < 0.1 * 7_000 * len(asked)


def test_bounds_hold_the_score_and_meet_at_the_end():
    pick = np.random.default_rng(5)
    vectors, query = pick.integers(-9, 9, (50, 6)).astype(float), pick.integers(-9, 9, 6).astype(float)
    lists, score = SortedLists(vectors), vectors @ query
    plus, minus = np.maximum(query, 0), np.minimum(query, 0)
    for depth in (0.1, 0.5, 0.9, 1.0):
        high_most, high_least, low_most, low_least = lists.read(depth)
        upper, lower = high_most @ plus + low_most @ minus, high_least @ plus + low_least @ minus
        assert (upper >= score).all() and (lower <= score).all()
    assert (upper == score).all() and (lower == score).all()
    assert NOBODY > 0
