import pyarrow.parquet as pq
from helpers_llm import AWKWARD, frame

from tidemark.llm.common import fold_of_id
from tidemark.llm.quality import learn, score_quality

FOLDER = "/root/testdata/sf0.1"


def tables(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet"), spark.read.parquet(f"{FOLDER}/labels.parquet")


def test_held_out_ranking(spark):
    docs, labels = tables(spark)
    truth = {r["doc_id"]: r["quality"] for r in pq.read_table(f"{FOLDER}/labels.parquet").to_pylist()}
    held = [r for r in score_quality(docs, labels).collect() if r.held_out and r.doc_id in truth]
    good, bad = ([r.score for r in held if truth[r.doc_id] == v] for v in (1, 0))
    assert len(bad) > 5
    assert sum((g > b) + (g == b) / 2 for g in good for b in bad) / len(good) / len(bad) > 0.9
    assert sum(r.predicted == truth[r.doc_id] for r in held) / len(held) > 0.9
    assert all(r.predicted == (r.score >= 0.7) for r in held)


def test_held_out_labels_are_not_used(spark):
    docs, labels = tables(spark)
    rows = [tuple(r) for r in labels.collect()]
    spoiled = spark.createDataFrame([(i, 1 - q if fold_of_id(i, 4) == 2 else q, t) for i, q, t in rows], labels.schema)
    assert learn(docs, labels) == learn(docs, spoiled)


def test_awkward_rows(spark):
    docs, labels = tables(spark)
    rows = docs.unionByName(frame(spark, [(None if i is None else 10**6 + i, t) for i, t in AWKWARD])).selectExpr("*", "'x' as score", "1 as predicted", "2 as spread")
    got = [r for r in score_quality(rows, labels.selectExpr("*", "'y' as label", "0 as spread")).collect() if r.doc_id is None or r.doc_id > 10**6]
    assert len(got) == len(AWKWARD)
    assert all(0 <= r.score <= 1 for r in got)
    empty = [r.score for r in got if r.doc_id in (10**6 + 1, 10**6 + 2)]
    assert empty[0] == empty[1] >= 0.7  # most shortest texts are good ones


def test_one_class_none_and_empty(spark):
    docs = frame(spark, [(i, f"text {i}") for i in range(20)])
    for labels in ([(1, 1), (2, 1)], [(1, None)], []):
        got = score_quality(docs, spark.createDataFrame(labels, "doc_id long, quality int")).collect()
        assert len({r.score for r in got}) == 1
    assert score_quality(frame(spark, []), spark.createDataFrame([], "doc_id long, quality int")).count() == 0
