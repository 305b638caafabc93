"""The largest keys per parent by a sketch, held against full counts."""

import random
from collections import Counter

import pytest

from tidemark.operators import rollups


def brute(rows, dims, size, within=0):
    """Buckets of tuples: ``within`` leading fields are never cut, then ``size`` keys a level."""
    rows = [r for r in rows if all(v is not None for v in r[within:])]
    kept = {r[:within] for r in rows}
    for depth in range(1, dims + 1):
        end = within + depth
        counts = Counter(r[:end] for r in rows if r[:end - 1] in kept)
        groups = {}
        for path, n in counts.items():
            groups.setdefault(path[:-1], []).append((-n, path[-1]))
        kept = {parent + (key,): -n for parent, keys in groups.items() for n, key in sorted(keys)[:size]}
    return sorted(((*path, n) for path, n in kept.items()), key=str)


def found(df, dims, size, within=()):
    return [sorted(map(tuple, rollups.nested_terms(df, dims, size, within, most_counts=m).collect()), key=str) for m in (0, 10**9)]


@pytest.mark.parametrize("skew", [1, 4])
def test_same_buckets_as_full_counts(spark, skew):
    pick = random.Random(skew)
    rows = [(pick.choice([None, "x", "y"]), pick.choice("abcdef"), int(3_000 * pick.random() ** skew), None if pick.random() < 0.02 else f"k{int(50 * pick.random() ** skew)}")
            for _ in range(20_000)]
    df = spark.createDataFrame(rows, "w string, a string, b long, c string").repartition(3)
    plain, full = found(df, ["a", "b", "c"], 3, ("w",))
    assert plain == full == brute(rows, 3, 3, 1)
    plain, full = found(df, ["b"], 40)
    assert plain == full == brute([r[2:3] for r in rows], 1, 40)


def test_frequent_keys_leave_the_rest_uncounted(spark, monkeypatch):
    rows = [(0, k) for k in range(5) for _ in range(2_000 - k)] + [(0, 100 + i) for i in range(20_000)]
    df = spark.createDataFrame(rows, "p long, k long")
    fixed = []
    plain_cut = rollups.cut_lineage
    monkeypatch.setattr(rollups, "cut_lineage", lambda d: fixed.append(plain_cut(d)) or fixed[-1])
    got = sorted(map(tuple, rollups.frequent_keys(df, ["p"], "k", 5, cells=256).collect()))
    assert got == [(0, k, 2_000 - k) for k in range(5)]
    counted, open_cells = fixed
    assert open_cells.count() == 0 and counted.count() <= 20 + 256  # 20,005 keys, of which the candidates alone are counted


def test_edges(spark):
    empty = spark.createDataFrame([], "a string, b long")
    assert found(empty, ["a", "b"], 3) == [[], []]
    ties = [("a", i) for i in range(300) for _ in range(2)]
    assert found(spark.createDataFrame(ties, "a string, b long"), ["a", "b"], 4) == [brute(ties, 2, 4)] * 2
    assert found(spark.createDataFrame(ties, "a string, b long"), ["a", "b"], 1_000) == [brute(ties, 2, 1_000)] * 2
    zeros = spark.createDataFrame([(0.0,), (-0.0,), (0.0,), (1.5,), (1.5,), (float("nan"),)], "x double")
    assert [[r[1] for r in rows] for rows in found(zeros, ["x"], 2)] == [[3, 2]] * 2
