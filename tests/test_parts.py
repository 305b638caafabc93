"""Greedy part numbers against the plain loop."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.operators import parts


def loop(sizes, cap, held=0, part=1):
    out = []
    for size in sizes:
        if held > 0 and held + size > cap:
            part, held = part + 1, 0
        held += size
        out.append(part)
    return out, held


SIZES = st.lists(st.integers(0, 30), min_size=1, max_size=60)


@settings(max_examples=400, deadline=None)
@given(SIZES, st.integers(1, 40), st.integers(0, 60))
def test_numbers_of_a_run(sizes, cap, held):
    expected, left = loop(sizes, cap, held, 5)
    numbers, after = parts.part_numbers(np.array(sizes), cap, held, 5)
    assert (numbers.tolist(), after) == (expected, left)


@settings(max_examples=400, deadline=None)
@given(st.lists(SIZES, min_size=1, max_size=5), st.integers(1, 40), st.integers(0, 60))
def test_chained_steps_tell_what_the_loop_does(runs, cap, held):
    steps = None
    for run in runs:
        one = parts.steps_of(np.array(run), cap)
        steps = one if steps is None else parts.chain(steps, one, cap)
    expected, left = loop([s for run in runs for s in run], cap, held, 0)
    opened, filled = steps.after(np.array([held]), cap)
    assert (int(opened[0]), int(filled[0])) == (expected[-1], left)


@pytest.mark.parametrize("large", [False, True])
def test_streams_in_chunks(spark, large):
    rng = np.random.default_rng(7)
    rows = [("hot", i, int(s)) for i, s in enumerate(rng.integers(0, 90, 3000))]
    rows += [("small", i, int(s)) for i, s in enumerate(rng.integers(1, 300, 40))]
    rows += [(None, i, 50) for i in range(30)] + [("one", 0, 999)]
    df = spark.createDataFrame(rows, "stream string, seq long, bytes long").repartition(5)
    limits = dict(max_rows=100, fan_in=3) if large else {}
    got = parts.assign_parts(df, "stream", ["seq"], "bytes", 250, **limits).collect()
    found = {(r.stream, r.seq): r.part for r in got}
    assert len(got) == len(rows)
    for stream in ("hot", "small", None, "one"):
        mine = sorted((i, s) for n, i, s in rows if n == stream)
        expected, _ = loop([s for _, s in mine], 250)
        assert [found[(stream, i)] for i, _ in mine] == expected


def test_oversize_exact_fit_and_empty(spark):
    rows = [("a", 0, 10), ("a", 1, 90), ("a", 2, 500), ("a", 3, 100), ("a", 4, 1)]
    df = spark.createDataFrame(rows, "stream string, seq long, bytes long")
    got = parts.assign_parts(df, "stream", ["seq"], "bytes", 100).orderBy("seq").collect()
    assert [r.part for r in got] == [1, 1, 2, 3, 4]
    assert parts.assign_parts(df.limit(0), "stream", ["seq"], "bytes", 100).count() == 0


@pytest.mark.parametrize("max_rows", [1000, 3])
def test_large_keys_beside_nulls(spark, max_rows):
    big = 2**60 + 1
    rows = [(None, i, 10, None) for i in range(5)] + [(big, i, 10, big) for i in range(5)] + [(big + 1, 0, 10, None)]
    df = spark.createDataFrame(rows, "stream long, seq long, bytes int, note long")
    got = parts.assign_parts(df, "stream", ["seq"], "bytes", 20, max_rows=max_rows).collect()
    assert {(r.stream, r.seq, r.note): r.part for r in got} == {(k, i, n): 1 + i // 2 for k, i, _, n in rows}
