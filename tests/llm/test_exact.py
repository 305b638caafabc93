import hashlib
from collections import Counter

import pytest
from helpers_llm import AWKWARD, frame

from tidemark.llm.exact import exact_dedup, frequent_digests, keep_one_copy

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def expected(rows):
    digest = [hashlib.sha256((t or "").translate(LOWER).encode()).hexdigest() for _, t in rows]
    sizes, best = Counter(digest), {}
    for (i, _), d in zip(rows, digest):
        best[d] = i if best.get(d) is None else best[d] if i is None else max(best[d], i)
    return sorted(((i, best[d], sizes[d], i == best[d], d) for (i, _), d in zip(rows, digest)), key=str)


@pytest.mark.parametrize("counters", [1, 2, 1024])
def test_brute_force_for_any_number_of_counters(spark, counters):
    rows = AWKWARD + [(100 + n, "Hot copy" if n % 3 else f"text {n % 7}") for n in range(300)]
    got = exact_dedup(frame(spark, rows, clash=True).repartition(5), counters=counters).collect()
    assert sorted(map(tuple, got), key=str) == expected(rows)


def test_one_row_of_each_group_stays(spark):
    rows = AWKWARD + [(200, "Hot")] * 40 + [(199, "hot")] * 40
    kept = keep_one_copy(frame(spark, rows, clash=True), counters=2)
    assert kept.columns == frame(spark, rows, clash=True).columns
    assert Counter((r.text or "").translate(LOWER) for r in kept.collect()) == Counter({(t or "").translate(LOWER) for _, t in rows})
    assert {r.doc_id for r in kept.collect()} == {3, 5, 2, 6, 7, 8, None, 200}


def test_misra_gries_holds_every_frequent_digest(spark):
    rows = [(bytes([n % 4]) if n % 2 else n.to_bytes(3, "big"),) for n in range(2000)]
    found = {r.digest for r in frequent_digests(spark.createDataFrame(rows, "digest binary").repartition(6), 3).collect()}
    assert len(found) <= 3
    assert {bytes([1]), bytes([3])} <= found  # 500 rows each, over 2000 / 4 at least one may stand on the line


def test_empty_table(spark):
    assert exact_dedup(frame(spark, [])).count() == 0
    assert keep_one_copy(frame(spark, [])).count() == 0
