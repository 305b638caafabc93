"""Packing timed jobs into lanes, and start times within a lane."""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.ordered import GROUP_ROWS, as_of, dealt, null_safe_join, running_total
from tidemark.session import cut_lineage


def clock_offsets(start_min: Column) -> tuple[Column, Column]:
    """Cron minute and second of a start in minutes; 60 seconds carry into the minute."""
    minute = F.floor(start_min)
    second = F.bround((start_min - minute) * 60).cast("int")
    carry = second == 60
    return (
        F.pmod(minute + F.when(carry, 1).otherwise(0), F.lit(60)).cast("int"),
        F.when(carry, 0).otherwise(second),
    )


def _with_clock(df: DataFrame) -> DataFrame:
    minute, second = clock_offsets(F.col("start_min"))
    return df.withColumns({"cron_minute": minute, "second_offset": second})


def lane_schedule(df: DataFrame, lane: str, order: list[str], dur: str, max_rows: int = GROUP_ROWS) -> DataFrame:
    """Start of each job after all earlier ones of its lane, its end, cron minute and second."""
    timed = running_total(df, [lane], order, F.col(dur), "start_min", max_rows)
    return _with_clock(timed.withColumn("end_min", F.col("start_min") + F.col(dur)))


def lane_load(df: DataFrame, lane: str, dur: str, horizon: float = 60.0) -> DataFrame:
    used = F.sum(dur)
    return df.groupBy(lane).agg(
        F.count(F.lit(1)).alias("jobs"), used.alias("used_min"), (used / F.lit(float(horizon))).alias("load_share")
    )


_load = itemgetter(0)


class _Lanes:
    """Lanes of one group as runs of equal load, in list order.

    A run is ``[load, first id, step, count]``. Jobs of one length are placed a run at a time, so
    the work depends on the number of different lengths, not on the number of jobs.
    """

    def __init__(self, horizon: int):
        self.horizon = horizon
        self.runs: list[list[int]] = []
        self.made = 0
        self.events: list[dict] = []

    def _note(self, dur, rank, count, per_lane, first, step, start):
        self.events.append(dict(dur=dur, lo=rank, hi=rank + count, per_lane=per_lane, first=first, step=step, start=start))

    def _insert_before_equals(self, run):
        self.runs.insert(bisect_left(self.runs, run[0], key=_load), run)

    def _insert_after_equals(self, run):
        self.runs.insert(bisect_right(self.runs, run[0], key=_load), run)

    def place(self, dur: int, rank: int, count: int):
        """Place ``count`` jobs of length ``dur``, the first of which has number ``rank``."""
        while count:
            fits = bool(self.runs) and self.runs[0][0] + dur <= self.horizon
            if fits and dur == 0:
                load, first = self.runs[0][:2]
                self._note(dur, rank, count, count, first, 1, load)
                return
            if fits:
                load, first, step, lanes = self.runs[0]
                taken = min(count, lanes)
                self._note(dur, rank, taken, 1, first, step, load)
                self.runs.pop(0)
                if taken < lanes:
                    self.runs.insert(0, [load, first + step * taken, step, lanes - taken])
                # Each filled lane leaves the front and sorts ahead of the lanes it now equals.
                self._insert_before_equals([load + dur, first + step * (taken - 1), -step, taken])
            else:
                deep = self.horizon // dur if dur else count
                if deep <= 1:
                    taken = count
                    self._note(dur, rank, taken, 1, self.made, 1, 0)
                    self._insert_after_equals([dur, self.made, 1, taken])
                    self.made += taken
                else:
                    whole = count // deep
                    taken = whole * deep if whole else count
                    lanes = whole or 1
                    self._note(dur, rank, taken, deep if whole else count, self.made, 1, 0)
                    load = (deep if whole else count) * dur
                    self._insert_before_equals([load, self.made + lanes - 1, -1, lanes])
                    self.made += lanes
            rank, count = rank + taken, count - taken


def _pieces(lengths: list[tuple[int, int]], horizon: int, long_lanes: int) -> tuple[list[dict], int]:
    """Placement of the jobs of one group: lane numbers by runs of job ranks, and lanes ahead of long jobs.

    Lane numbers are list positions at the last sort, which precedes the last job. ``lengths`` are
    (length, count) pairs, longest first.
    """
    lanes = _Lanes(horizon)
    for dur, count in lengths[:-1]:
        lanes.place(dur, 0, count)
    dur, count = lengths[-1]
    lanes.place(dur, 0, count - 1)
    listed = [list(run) for run in lanes.runs]
    ahead = sum(run[3] for run in listed)
    before = lanes.made
    lanes.place(dur, count - 1, 1)
    spans, position = [], 1
    for _, first, step, number in listed:
        low = first if step > 0 else first - number + 1
        spans.append((low, low + number, position if step > 0 else position + number - 1, step))
        position += number
    if lanes.made > before:
        spans.append((before, before + 1, ahead + long_lanes + 1, 1))
    spans.sort()
    lows = [s[0] for s in spans]
    out = []
    for e in lanes.events:
        count = -(-(e["hi"] - e["lo"]) // e["per_lane"])
        done = 0
        while done < count:
            ident = e["first"] + e["step"] * done
            low, high, at_low, step = spans[bisect_right(lows, ident) - 1]
            room = high - ident if e["step"] > 0 else ident - low + 1
            taken = min(count - done, room)
            out.append({
                "dur": e["dur"], "lo": e["lo"] + done * e["per_lane"],
                "hi": min(e["hi"], e["lo"] + (done + taken) * e["per_lane"]), "per_lane": e["per_lane"],
                "lane": at_low + step * (ident - low), "step": step * e["step"], "start": e["start"],
            })
            done += taken
    return out, ahead


_PIECE = pa.struct([(name, pa.int64()) for name in ("lo", "hi", "per_lane", "lane", "step", "start")])
_PLAN = ("_len long, _ahead long, _short boolean, "
         "_pieces array<struct<lo:long,hi:long,per_lane:long,lane:long,step:long,start:long>>")


def pack_lanes(df: DataFrame, group: str, seq: list[str], dur: str, horizon: int = 3600,
               max_rows: int = GROUP_ROWS) -> DataFrame:
    """Add ``lane``, ``start_s`` and ``end_s``: longest job first, into the least loaded lane that fits.

    ``dur`` is whole seconds (any integer unit) and ``seq`` the input order, which breaks ties.
    Jobs are counted per (group, length) in a first pass; at most ``horizon`` lengths share lanes, so the
    sequential part sees a bounded list per group however many jobs the group has. Jobs then look
    up their place by their rank among jobs of the same length. A job longer than the horizon has a
    lane of its own, after the others; one without a length takes no time.
    """
    if not isinstance(df.schema[dur].dataType, (T.IntegerType, T.LongType, T.ShortType)):
        raise TypeError(f"{dur} must hold whole units, not {df.schema[dur].dataType.simpleString()}")
    jobs = df.withColumn("_len", F.coalesce(F.col(dur).cast("long"), F.lit(0).cast("long")))
    is_long = F.col("_len") > F.lit(int(horizon))
    lengths = cut_lineage(jobs.groupBy(group, F.when(~is_long, F.col("_len")).alias("_len")).agg(
        F.count(F.lit(1)).alias("n")
    ))
    long = F.col("_len").isNull()
    sizes = lengths.groupBy(long.alias("long")).agg(
        F.max("n").alias("most"), F.sum("n").alias("all"), F.count(F.lit(1)).alias("pairs")).collect()
    counted = {r.long: r["all"] for r in sizes}
    chunks = {r.long: 2 * -(-r["all"] // max_rows) if r.most > max_rows else 0 for r in sizes}
    # At most horizon + 1 lengths per group, so the gathered list is bounded whatever the group's size.
    listed = dealt(lengths, [group], sum(r.pairs for r in sizes)).groupBy(group).agg(
        F.collect_list(F.when(~long, F.struct("_len", "n"))).alias("pairs"),
        F.coalesce(F.sum(F.when(long, F.col("n"))), F.lit(0)).alias("long_lanes"),
    )
    schema = T.StructType([df.schema[group], *T.StructType.fromDDL(_PLAN).fields])

    def simulate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for name, pairs, long_lanes in zip(*(batch.column(c).to_pylist() for c in (group, "pairs", "long_lanes"))):
                pairs = sorted(((p["_len"], p["n"]) for p in pairs), reverse=True)
                pieces, ahead = _pieces(pairs, horizon, long_lanes) if pairs else ([], 0)
                by_length: dict[int, list[dict]] = {}
                for piece in pieces:
                    by_length.setdefault(piece.pop("dur"), []).append(piece)
                rows += [(name, length, ahead, True, p) for length, p in by_length.items()]
                if long_lanes:
                    rows.append((name, None, ahead, bool(pairs), None))
            if rows:
                kinds = [batch.schema.field(group).type, pa.int64(), pa.int64(), pa.bool_(), pa.list_(_PIECE)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(values, kind) for values, kind in zip(zip(*rows), kinds)], names=schema.names)

    plan = listed.mapInArrow(simulate, schema)
    short = running_total(jobs.filter(~is_long), [group, "_len"], seq, F.lit(1).cast("long"), "_rank",
                          max_rows, chunks.get(False, 0), rows=counted.get(False, 0))
    pieces = plan.filter(~long).select(group, "_len", F.explode("_pieces").alias("_p")).withColumn("_rank", F.col("_p.lo"))
    # The pieces of a length cover all its ranks, so a job's piece is the last one that begins at or before its rank.
    placed = as_of(short, pieces, [group, "_len"], "_rank", "_p", chunks.get(False, 0), counted.get(False, 0))
    at = F.col("_rank") - F.col("_p.lo")
    nth = F.call_function("div", at, F.col("_p.per_lane"))
    placed = placed.withColumns({
        "lane": (F.col("_p.lane") + F.col("_p.step") * nth).cast("long"),
        "start_s": (F.col("_p.start") + (at % F.col("_p.per_lane")) * F.col("_len")).cast("long"),
    })
    out = placed.select(*df.columns, "lane", "start_s")
    if True in chunks:
        wide = _long_jobs(jobs.filter(is_long), plan.filter(long), group, seq, max_rows, chunks[True], counted[True])
        out = out.unionByName(wide.select(*out.columns))
    return out.withColumn("end_s", F.col("start_s") + F.coalesce(F.col(dur), F.lit(0)))


def _long_jobs(jobs: DataFrame, plan: DataFrame, group: str, seq: list[str], max_rows: int, chunks: int, rows: int) -> DataFrame:
    """Jobs over the horizon: one lane each, shortest first, after the shared lanes.

    In a group of only such jobs the last one placed stays at the end of the list.
    """
    ranked = running_total(jobs, [group], ["_len", *seq], F.lit(1).cast("long"), "_rank", max_rows, chunks, rows=rows)
    by_length = jobs.groupBy(group, "_len").agg(F.count(F.lit(1)).alias("n"))
    shortest = by_length.groupBy(group).agg(F.min_by("n", "_len").alias("_ties"), F.sum("n").alias("_n"))
    both = null_safe_join(null_safe_join(ranked, plan.select(group, "_ahead", "_short"), [group]), shortest, [group])
    last = F.col("_ties") - 1
    moved = (
        F.when(F.col("_short") | (F.col("_rank") < last), F.col("_rank"))
        .when(F.col("_rank") == last, F.col("_n") - 1)
        .otherwise(F.col("_rank") - 1)
    )
    return both.withColumns({"lane": F.col("_ahead") + moved + 1, "start_s": F.lit(0).cast("long")})


def pack_schedule(df: DataFrame, group: str, seq: list[str], dur: str, horizon: int = 3600, **limits) -> DataFrame:
    """``pack_lanes`` with starts and ends in minutes, cron minute and second."""
    packed = pack_lanes(df, group, seq, dur, horizon, **limits).withColumns({
        "start_min": F.col("start_s") / 60.0, "end_min": F.col("end_s") / 60.0, "duration_min": F.col(dur) / 60.0,
    })
    return packed.withColumns({
        "cron_minute": (F.floor(F.col("start_s") / 60) % 60).cast("int"),
        "second_offset": (F.col("start_s") % 60).cast("int"),
    }).drop("start_s", "end_s")
