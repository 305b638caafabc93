"""Rows met with time windows that may be short, many and overlapping: counted per window, or joined to each.

Window bounds part the time line into slots. Where the bounds fit a broadcast, a row finds its slot by binary
search, and a window is a run of slots. Where they do not, rows and bounds are sorted together by range: counts
are running totals over that order, and a join sweeps it, each range starting with the windows still open there.
Either way a row is met with the windows that hold it and with no other.
"""

from __future__ import annotations

from collections.abc import Iterator
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.ordered import running_total, small_side
from tidemark.session import cut_lineage

#: Distinct bounds that are broadcast at most (8 bytes each), and (slot, window) pairs.
MAX_BOUNDS, MAX_PAIRS = 1_000_000, 500_000
#: Rows that one range of a sweep has, about.
SWEEP_ROWS = 1_000_000


def _micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def _spans(windows: DataFrame, key: str, start: str, end: str, closed: str) -> DataFrame:
    """(key, lo, hi): non-empty windows in microseconds, ``hi`` exclusive. Fixed, since it is read several times."""
    if closed not in ("left", "both"):
        raise ValueError(f"closed must be 'left' or 'both', not {closed!r}")
    past = 1 if closed == "both" else 0
    spans = windows.select(key, _micros(F.col(start)).alias("lo"), (_micros(F.col(end)) + past).alias("hi"))
    return cut_lineage(spans.filter("lo < hi"))


def _bounds(spans: DataFrame) -> DataFrame:
    return spans.select(F.explode(F.array("lo", "hi")).alias("at")).distinct()


def _broadcast_bounds(bounds: DataFrame) -> np.ndarray:
    return np.sort(np.array([r.at for r in bounds.collect()], np.int64))


def _slot(bounds: np.ndarray, side: str = "right"):
    """Bounds at or before an instant (``right``), or before it (``left``)."""
    from pyspark.sql import SparkSession

    shared = SparkSession.getActiveSession().sparkContext.broadcast(bounds)

    @F.arrow_udf("long")
    def slot(at: pa.Array) -> pa.Array:
        return pa.array(np.searchsorted(shared.value, at.to_numpy(zero_copy_only=False), side))

    return slot


def _near(rows: DataFrame, ts: str, spans: DataFrame) -> DataFrame | None:
    """Rows in the span of all windows, by a filter that reaches the scan, or None without a window."""
    low, high = spans.agg(F.min("lo"), F.max("hi")).first()
    if low is None:
        return None
    kind = rows.schema[ts].dataType
    first, last = (F.timestamp_micros(F.lit(v)) for v in (low, high))
    if not isinstance(kind, T.TimestampType):
        first, last = first.cast("timestamp_ntz"), last.cast("timestamp_ntz")
    return rows.filter((F.col(ts) >= first) & (F.col(ts) < last))


def count_in_windows(rows: DataFrame, ts: str, windows: DataFrame, key: str, amounts: dict[str, Column], start: str = "window_start",
                     end: str = "window_end", closed: str = "left", max_bounds: int = MAX_BOUNDS) -> DataFrame:
    """Per window its key and the sums of whole-number ``amounts`` over the rows it holds, 0 for none.

    A row counts in every window that holds it. Windows that are empty or lack a bound hold nothing.
    """
    spans = _spans(windows, key, start, end, closed)
    near = _near(rows, ts, spans)
    none = windows.select(key, *[F.lit(0).cast("bigint").alias(n) for n in amounts])
    if near is None:
        return none
    bounds, names = _bounds(spans), list(amounts)
    timed = near.select(_micros(F.col(ts)).alias("at"), *[a.cast("bigint").alias(n) for n, a in amounts.items()])
    if bounds.count() <= max_bounds:
        counted = _count_by_slot(timed, spans, key, _broadcast_bounds(bounds), names)
    else:
        counted = _count_by_order(timed, spans, key, bounds, names)
    empty = windows.filter(~F.coalesce(_micros(F.col(start)) < _micros(F.col(end)) + (1 if closed == "both" else 0), F.lit(False)))
    return counted.unionByName(empty.select(key, *[F.lit(0).cast("bigint").alias(n) for n in names]))


def _count_by_slot(timed: DataFrame, spans: DataFrame, key: str, bounds: np.ndarray, names: list[str]) -> DataFrame:
    slots = timed.withColumn("slot", _slot(bounds)("at")).groupBy("slot").agg(*[F.sum(n).alias(n) for n in names])
    before = np.zeros((len(names), len(bounds) + 1), np.int64)
    for r in slots.collect():  # one row per bound at most
        before[:, r.slot] = [r[n] or 0 for n in names]
    before = np.cumsum(before, axis=1)  # at a bound's place: the rows before it
    shared = spans.sparkSession.sparkContext.broadcast((bounds, before))

    def held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places, sums = shared.value
        for batch in batches:
            low, high = (np.searchsorted(places, batch.column(i).to_numpy()) for i in (1, 2))
            columns = [pa.array(sums[i][high] - sums[i][low]) for i in range(len(names))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=[key, *names])

    schema = T.StructType([spans.schema[key], *[T.StructField(n, T.LongType()) for n in names]])
    return spans.select(key, "lo", "hi").mapInArrow(held, schema)


def _count_by_order(timed: DataFrame, spans: DataFrame, key: str, bounds: DataFrame, names: list[str]) -> DataFrame:
    """Running totals over rows (reduced by instant) and bounds, in one order that is cut by range where it is long."""
    reduced = timed.groupBy("at").agg(*[F.sum(n).alias(n) for n in names]).withColumn("kind", F.lit(1))
    marks = bounds.select("at", *[F.lit(0).cast("bigint").alias(n) for n in names], F.lit(0).alias("kind"))
    line = cut_lineage(reduced.unionByName(marks).withColumn("all", F.lit(0)))
    out = spans
    for name in names:
        totals = running_total(line.select("all", "at", "kind", name), ["all"], ["at", "kind"], F.coalesce(name, F.lit(0)), "before")
        totals = cut_lineage(totals.filter("kind = 0").select("at", "before"))
        for side in ("lo", "hi"):
            out = out.join(totals.select(F.col("at").alias(side), F.col("before").alias(f"{name}_{side}")), side)
        out = out.withColumn(name, F.col(f"{name}_hi") - F.col(f"{name}_lo"))
    return out.select(key, *[F.col(n).cast("bigint").alias(n) for n in names])


def join_windows(rows: DataFrame, ts: str, windows: DataFrame, key: str, start: str = "window_start", end: str = "window_end",
                 closed: str = "left", max_bounds: int = MAX_BOUNDS, max_pairs: int = MAX_PAIRS, sweep_rows: int = SWEEP_ROWS) -> DataFrame:
    """Rows with the ``key`` of the window that holds them: once per window, not at all without one."""
    spans = _spans(windows, key, start, end, closed)
    near = _near(rows, ts, spans)
    if near is None:
        return rows.withColumn(key, F.lit(None).cast(windows.schema[key].dataType)).limit(0)
    bounds = _bounds(spans)
    if bounds.count() <= max_bounds:
        places = _broadcast_bounds(bounds)
        first, last = _slot(places, "right")("lo"), _slot(places, "left")("hi")
        runs = cut_lineage(spans.select(key, first.alias("first"), last.alias("last")))
        if runs.agg(F.sum(F.col("last") - F.col("first") + 1)).first()[0] <= max_pairs:
            held = small_side(runs.select(key, F.explode(F.sequence("first", "last")).alias("_slot")))
            return near.withColumn("_slot", _slot(places)(_micros(F.col(ts)))).join(held, "_slot").drop("_slot")
    return _sweep(near, ts, spans, key, sweep_rows)


def _sweep(rows: DataFrame, ts: str, spans: DataFrame, key: str, sweep_rows: int) -> DataFrame:
    """Rows and windows in one order of time, cut into ranges at quantiles of the rows.

    A window is handed to every range it reaches into. A range of more rows than its share (many at one
    instant) is dealt to several tasks, each of which gets that range's windows.
    """
    fields = rows.columns
    timed = rows.select(F.struct(*fields).alias("row"), _micros(F.col(ts)).alias("at"))
    total = timed.count()
    ranges = min(10_000, 1 + total // sweep_rows)
    steps = [i / ranges for i in range(1, ranges)]
    found = timed.agg(F.percentile_approx("at", steps, 10 * ranges)).first()[0] if steps else []
    cut = _slot(np.unique(np.array(found or [], np.int64)))
    timed = timed.withColumn("range", cut("at"))
    sizes = small_side(timed.groupBy("range").agg(F.ceil(F.count(F.lit(1)) / sweep_rows).cast("long").alias("tasks")))
    dealt = timed.join(sizes, "range").withColumn("task", F.monotonically_increasing_id() % F.col("tasks"))
    # Looked up before they are exploded: a generator takes no Python function.
    reach = cut_lineage(spans.select(key, "lo", "hi", cut("lo").alias("from"), cut(F.col("hi") - 1).alias("to")))
    reach = reach.select(key, "lo", "hi", F.explode(F.sequence("from", "to")).alias("range")).join(sizes, "range")
    opened = reach.withColumn("task", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tasks") - 1)))
    no_key, no_row = F.lit(None).cast(spans.schema[key].dataType), F.lit(None).cast(timed.schema["row"].dataType)
    line = dealt.select("range", "task", "at", F.lit(1).alias("kind"), F.lit(None).cast("long").alias("hi"), no_key.alias("key"), "row").unionByName(
        opened.select("range", "task", F.col("lo").alias("at"), F.lit(0).alias("kind"), "hi", F.col(key).alias("key"), no_row.alias("row")))
    ordered = line.repartition("range", "task").sortWithinPartitions("range", "task", "at", "kind")
    schema = T.StructType([T.StructField("row", timed.schema["row"].dataType), spans.schema[key]])

    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, still, pushed = None, [], 0
        for batch in batches:
            taken, keys = [], []
            columns = [batch.column(i).to_pylist() for i in range(6)]
            for i, (number, task, at, kind, hi, name) in enumerate(zip(*columns)):
                if (number, task) != place:
                    place, still = (number, task), []
                if kind == 0:
                    pushed += 1  # tells windows of one end apart
                    heappush(still, (hi, pushed, name))
                    continue
                while still and still[0][0] <= at:
                    heappop(still)
                taken += [i] * len(still)
                keys += [name for *_, name in still]
            kept = batch.column(6).take(pa.array(taken, pa.int64()))
            yield pa.RecordBatch.from_arrays([kept, pa.array(keys, batch.column(5).type)], names=["row", key])

    return ordered.mapInArrow(sweep, schema).select("row.*", key)
