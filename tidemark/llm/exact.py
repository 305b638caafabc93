"""Exact dedup with a heavy-hitter split.

Misra-Gries summaries of every task's digests are merged into one bounded summary, which holds every
digest of more than n / (counters + 1) rows. Those candidates are verified by an exact count, and the
verified winners are broadcast, so that copies in large groups are settled where they are read. All other
digests are few per key and go through an ordinary shuffle.
"""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import ascii_lower, text_of
from tidemark.session import cut_lineage

#: Counters of a Misra-Gries summary; also the most rows that are ever broadcast.
COUNTERS = 1024


def _shrink(counts: dict[bytes, int], counters: int) -> dict[bytes, int]:
    """Subtract the (counters + 1)-th largest count from all: the mergeable form of Misra-Gries."""
    if len(counts) <= counters:
        return counts
    cut = sorted(counts.values(), reverse=True)[counters]
    return {k: n - cut for k, n in counts.items() if n > cut}


def _summary(counters: int, counted: bool):
    """Digests, or rows of an earlier summary, to the summary of a whole task."""

    def run(batches):
        counts: dict[bytes, int] = {}
        for batch in batches:
            if counted:
                pairs = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
            else:
                seen = pc.value_counts(batch.column(0))
                pairs = zip(seen.field("values").to_pylist(), seen.field("counts").to_pylist())
            for digest, n in pairs:
                counts[digest] = counts.get(digest, 0) + n
            counts = _shrink(counts, counters)
        yield pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.binary()), pa.array(counts.values(), pa.int64())], names=["digest", "n"])

    return run


def frequent_digests(digests: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """At most ``counters`` rows (digest, n): all digests of more than rows / (counters + 1) rows, and maybe others.

    ``digests`` has one binary column. Summaries are merged in two steps, so that no task reads more than
    the summaries of a share of the tasks.
    """
    schema = "digest binary, n bigint"
    first = digests.mapInArrow(_summary(counters, False), schema)
    shares = max(2, int(digests.sparkSession.conf.get("spark.sql.shuffle.partitions")) // 8)
    second = first.repartition(shares).mapInArrow(_summary(counters, True), schema)
    return second.coalesce(1).mapInArrow(_summary(counters, True), schema)


def heavy_winners(rows: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """(heavy, heavy_keep, heavy_size) of the frequent digests, exactly counted; at most ``counters`` rows.

    ``rows`` has the columns digest and doc_id. The count is added up before the shuffle, so a group of any
    size costs one row per task.
    """
    candidates = frequent_digests(rows.select("digest"), counters).select("digest")
    return (
        rows.join(F.broadcast(candidates), "digest", "left_semi")
        .groupBy("digest").agg(F.max("doc_id").alias("heavy_keep"), F.count(F.lit(1)).alias("heavy_size"))
        .where("heavy_size > 1")
        .withColumnRenamed("digest", "heavy")
    )


def digest_of(text: str) -> Column:
    return F.unhex(F.sha2(ascii_lower(text_of(text)).cast("binary"), 256))


def exact_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", counters: int = COUNTERS) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after lower-casing A-Z; null counts as empty. The largest doc_id of a
    group is kept; a null id is smaller than any, and a group of null ids only keeps its rows. Rows that
    repeat a doc_id and its text are marked alike. An empty table gives no rows.
    """
    rows = cut_lineage(docs.select(F.col(f"`{doc_id}`").alias("doc_id"), digest_of(text).alias("digest")))  # read three times; without texts
    winners = F.broadcast(heavy_winners(rows, counters))
    marked = rows.join(winners, rows.digest == winners.heavy, "left")
    same = Window.partitionBy("digest")
    heavy = marked.where("heavy is not null").select("doc_id", "digest", F.col("heavy_keep").alias("keep_id"), F.col("heavy_size").alias("group_size"))
    light = marked.where("heavy is null").select(
        "doc_id", "digest", F.max("doc_id").over(same).alias("keep_id"), F.count(F.lit(1)).over(same).alias("group_size"),
    )
    return heavy.unionByName(light).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def keep_one_copy(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", counters: int = COUNTERS) -> DataFrame:
    """The kept rows themselves, with all columns of ``docs``; exactly one row of each group of equal texts.

    Losers of the heavy groups go where they are read. The others meet by digest in one shuffle, reduced
    on both sides of it; ties of the id fall to the largest of the remaining columns.
    """
    names = docs.columns
    packed = docs.select(
        F.struct(F.col(f"`{doc_id}`").alias("k"), *[F.col(f"`{n}`").alias(f"c{i}") for i, n in enumerate(names)]).alias("row"),
        F.col(f"`{doc_id}`").alias("doc_id"), digest_of(text).alias("digest"),
    )
    rows = cut_lineage(docs.select(F.col(f"`{doc_id}`").alias("doc_id"), digest_of(text).alias("digest")))
    winners = F.broadcast(heavy_winners(rows, counters))
    left = packed.join(winners, packed.digest == winners.heavy, "left").where("heavy is null or doc_id <=> heavy_keep")
    best = left.groupBy("digest").agg(F.max("row").alias("row"))
    return best.select(*[F.col(f"row.c{i}").alias(n) for i, n in enumerate(names)])
