"""Exact top-k inner products by no-random-access aggregation over sorted lists.

Candidates lie in shards. A shard keeps, for every component, the list of its candidates in the order of that
component. A block of queries reads all lists together, from the high end for its positive components and from
the low end for its negative ones. What is not read yet lies between the frontier of a list and its other end, so
each candidate has an upper and a lower bound of its score. A query stops reading when few candidates have an
upper bound that reaches its threshold: its k-th best score or lower bound so far. The scores of these are then
resolved, all outsiders cannot qualify. Where too many stay, reading goes on to the end, where both bounds meet.

Every candidate's task meets every query, in files of bounded size from the shared folder; no rows are paired.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import filesystem
from tidemark.session import cut_lineage, scratch_path

#: Components that a task's candidates have in all at most (about), candidates of a shard, and of the first shard.
TASK_CELLS, SHARD, FIRST_SHARD = 1 << 24, 16_384, 1_024
#: Queries of a file, and queries whose bounds are held at a time.
QUERY_FILE, QUERY_BLOCK = 8_192, 512
#: How far the lists are read before bounds are looked at, and the share of a shard that is few enough to be resolved.
DEPTHS, FEW = (0.5, 0.75, 0.9), 0.02
#: Pairs resolved at a time; scores whose size is beyond FLOAT are added up as Python integers.
PAIRS, FLOAT = 1 << 17, float(1 << 45)
LONG = np.iinfo(np.int64)
NOBODY = np.int64(LONG.max)


class SortedLists:
    """The lists of a shard: per component the candidates' places and values, ascending."""

    def __init__(self, vectors: np.ndarray):
        self.vectors = vectors
        self.places = np.argsort(vectors, axis=0, kind="stable")
        self.values = np.take_along_axis(vectors, self.places, axis=0)

    def read(self, depth: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(most, least) of every candidate's component after reading that share from the high end, and from the low end.

        An entry that was read is known. Of the others, those of a list read from its high end lie between the
        list's smallest value and the last value read, and the other way round.
        """
        count = max(1, int(len(self.vectors) * depth))
        out = []
        for from_high in (True, False):
            unread = slice(0, -count) if from_high else slice(count, None)
            frontier = self.values[-count] if from_high else self.values[count - 1]
            end = self.values[0] if from_high else self.values[-1]
            for bound in (frontier, end):
                known = self.values.copy()
                known[unread] = bound
                spread = np.empty_like(known)
                np.put_along_axis(spread, self.places, known, axis=0)
                out.append(spread)
        return tuple(out)


def _best(k: int, rows: np.ndarray, scores: np.ndarray, places: np.ndarray, top_scores: np.ndarray, top_places: np.ndarray) -> None:
    """Put (row, score, place) triples among the rows' k best so far; ties fall to the smaller place."""
    touched, local = np.unique(rows, return_inverse=True)
    row = np.concatenate([local, np.repeat(np.arange(len(touched)), k)])
    score = np.concatenate([scores, top_scores[touched].ravel()])
    place = np.concatenate([places, top_places[touched].ravel()])
    order = np.lexsort((place, ~score, row))  # ~ turns the order round without overflow
    row, score, place = row[order], score[order], place[order]
    rank = np.arange(len(row)) - np.searchsorted(row, row, "left")
    chosen = rank < k
    top_scores[touched[row[chosen]], rank[chosen]] = score[chosen]
    top_places[touched[row[chosen]], rank[chosen]] = place[chosen]


def _resolve(k, few, base, queries, vectors, kind, top_scores, top_places):
    """Exact scores of the pairs ``few`` of queries and a shard's candidates."""
    for start in range(0, len(few[0]), PAIRS):
        q, c = few[0][start:start + PAIRS], few[1][start:start + PAIRS]
        scores = np.einsum("ij,ij->i", queries[q], vectors[c], dtype=kind).astype(np.int64)
        _best(k, q, scores, base + c, top_scores, top_places)


def _search_shard(k: int, base: int, lists: SortedLists, own: np.ndarray, queries: np.ndarray, top_scores, top_places) -> None:
    """Bring the k best of all queries up to date with one shard."""
    size, kind = len(lists.vectors), lists.vectors.dtype
    plus, minus = np.maximum(queries, 0), np.minimum(queries, 0)
    open_ = np.arange(len(queries))
    for depth in DEPTHS if size > FIRST_SHARD else ():
        high_most, high_least, low_most, low_least = lists.read(depth)
        ceiling, floor = np.concatenate([high_most, low_most], 1).T, np.concatenate([high_least, low_least], 1).T
        still = []
        for at in range(0, len(open_), QUERY_BLOCK):
            block = open_[at:at + QUERY_BLOCK]
            signed = np.concatenate([plus[block], minus[block]], 1)
            upper = signed @ ceiling
            inside = (own[block] >= base) & (own[block] < base + size)
            upper[np.flatnonzero(inside), own[block][inside] - base] = -np.inf
            threshold = top_scores[block, -1].astype(np.float64)
            none_yet = np.flatnonzero(top_scores[block, -1] == LONG.min)
            if len(none_yet) and size > k:
                lower = signed[none_yet] @ floor
                mine = np.flatnonzero(inside[none_yet])
                lower[mine, own[block][none_yet][mine] - base] = -np.inf
                threshold[none_yet] = np.partition(lower, size - k, axis=1)[:, size - k]
            reach = upper >= threshold[:, None].astype(kind)
            done = reach.sum(1) <= max(k, FEW * size)
            few = np.nonzero(reach & done[:, None])
            _resolve(k, (block[few[0]], few[1]), base, queries, lists.vectors, kind, top_scores, top_places)
            still.append(block[~done])
        open_ = np.concatenate(still) if still else open_
    for at in range(0, len(open_), QUERY_BLOCK):  # the lists are read to their end: bounds are scores
        block = open_[at:at + QUERY_BLOCK]
        scores = queries[block] @ lists.vectors.T
        inside = (own[block] >= base) & (own[block] < base + size)
        scores[np.flatnonzero(inside), own[block][inside] - base] = -np.inf
        keep = min(k, size)
        cut = np.partition(scores, size - keep, axis=1)[:, size - keep]
        cut = np.maximum(cut, top_scores[block, -1].astype(kind))
        better, ties = np.nonzero(scores > cut[:, None]), scores == cut[:, None]
        ties &= np.cumsum(ties, axis=1, dtype=np.int32) <= k  # places ascend, so the first are the smallest
        ties &= np.isfinite(cut)[:, None]
        tied = np.nonzero(ties)
        rows, columns = np.concatenate([better[0], tied[0]]), np.concatenate([better[1], tied[1]])
        _best(k, block[rows], scores[rows, columns].astype(np.int64), base + columns, top_scores, top_places)


def _search_exactly(k, own, queries, vectors, top_scores, top_places):
    """Scores beyond what floats hold: whole numbers of any size, cut to 64 bits."""
    whole = vectors.astype(object)
    for i, query in enumerate(queries):
        scores = np.array([min(max(int(s), LONG.min + 1), LONG.max) for s in whole @ query.astype(object)], np.int64)
        places = np.flatnonzero(np.arange(len(vectors)) != own[i])
        _best(k, np.full(len(places), i), scores[places], places, top_scores, top_places)


def search(k: int, ids: np.ndarray, vectors: np.ndarray, query_rows: np.ndarray, queries: np.ndarray, rows: np.ndarray):
    """(scores, places) of the k best of ``vectors`` for each query; places follow the order of the vectors.

    ``rows`` and ``query_rows`` tell rows apart, so that a query does not find its own. Missing results have the
    smallest score there is.
    """
    top_scores = np.full((len(queries), k), LONG.min, np.int64)
    top_places = np.full((len(queries), k), NOBODY, np.int64)
    by_row = np.argsort(rows)
    at = np.minimum(np.searchsorted(rows, query_rows, sorter=by_row), len(rows) - 1)
    own = np.where(rows[by_row[at]] == query_rows, by_row[at], -1)
    width = vectors.shape[1]
    most = float(np.abs(vectors).max(initial=0).astype(np.float64)) * float(np.abs(queries).max(initial=0).astype(np.float64)) * max(1, width)
    if most >= FLOAT:
        _search_exactly(k, own, queries, vectors, top_scores, top_places)
        return top_scores, top_places
    kind = np.float32 if most < 1 << 23 else np.float64
    vectors, queries = vectors.astype(kind), queries.astype(kind)
    start = 0
    while start < len(vectors):
        stop = start + (SHARD if start else FIRST_SHARD)
        _search_shard(k, start, SortedLists(vectors[start:stop]), own, queries, top_scores, top_places)
        start = stop
    return top_scores, top_places


def _matrix(column: pa.ListArray, width: int) -> np.ndarray:
    """Lists of whole numbers as rows, short ones filled up with zeros."""
    lengths = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if len(lengths) and (lengths == width).all():
        return flat.reshape(len(lengths), width)
    out = np.zeros((len(lengths), width), np.int64)
    row = np.repeat(np.arange(len(lengths)), lengths)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    return out


def _search_task(k: int, width: int, files: list[str]):
    def run(batches):
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        mine = pa.Table.from_batches(held)
        ids, null = mine.column(0).fill_null(0).to_numpy(), mine.column(0).is_null().to_numpy()
        rows = mine.column(1).to_numpy()
        order = np.lexsort((rows, ids, null))
        ids, null, rows = ids[order], null[order], rows[order]
        vectors = _matrix(mine.column(2).combine_chunks(), width)[order]
        for address in files:
            store, path = filesystem(address)
            with store.open_input_file(path) as source:
                for asked in pq.ParquetFile(source).iter_batches(QUERY_FILE):
                    query_ids, query_rows = asked.column("vec_id").to_numpy(), asked.column("row").to_numpy()
                    scores, places = search(k, ids, vectors, query_rows, _matrix(asked.column("v"), width), rows)
                    q, rank = np.nonzero(places != NOBODY)
                    found = places[q, rank]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(query_ids[q]), pa.array(query_rows[q]), pa.array(ids[found], pa.int64(), mask=null[found]), pa.array(rows[found]),
                         pa.array(scores[q, rank])], names=["query_id", "query_row", "vec_id", "row", "score"])

    return run


def whole_vectors(embeddings: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", scale: int = 256) -> DataFrame:
    """(vec_id, v): floor(scale * component) as whole numbers, of the vectors that are neither null nor hold null, NaN or infinity."""
    numbers = F.transform(F.col(f"`{vector}`"), lambda x: x.cast("double"))
    bad = F.exists("x", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = embeddings.select(F.col(f"`{vec_id}`").cast("long").alias("vec_id"), numbers.alias("x")).where(F.col("x").isNotNull() & ~bad)
    return rows.select("vec_id", F.transform("x", lambda x: F.floor(x * scale).cast("long")).alias("v"))


def top_inner_products(embeddings: DataFrame, k: int = 5, every: int = 50, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """The ``k`` highest integer inner products of every query: query_id, rank (from 1), vec_id, score.

    Queries are the rows whose id is divisible by ``every``; candidates all rows but the query's own. Ties go to
    the smaller vec_id, a null id last. Rows that repeat an id are rows of their own: a repeated query has its
    results as often, and its other row is a candidate. A shorter vector counts as filled up with zeros; numbers
    and scores beyond 64 bits as the largest or smallest of them. An empty table gives no rows.
    """
    spark = embeddings.sparkSession
    rows = cut_lineage(whole_vectors(embeddings, vec_id, vector)).withColumn("row", F.monotonically_increasing_id()).select("vec_id", "row", "v")
    total, width = rows.agg(F.count(F.lit(1)), F.max(F.size("v"))).first()
    schema = "query_id long, query_row long, vec_id long, row long, score long"
    if not total:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    path = scratch_path(spark, "queries")
    rows.where(F.col("vec_id") % every == 0).write.option("maxRecordsPerFile", QUERY_FILE).parquet(path)
    files = [r[0] for r in spark.read.parquet(path).select("_metadata.file_path").distinct().collect()]
    width = max(1, width)
    spread = max(-(-total * width // TASK_CELLS), min(spark.sparkContext.defaultParallelism, -(-total // SHARD)))
    found = rows.repartition(int(spread)).mapInArrow(_search_task(k, width, files), schema)
    order = Window.partitionBy("query_id", "query_row").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "row")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
