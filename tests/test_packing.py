"""Lane packing against the plain loop and the golden schedule; running totals of large groups."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.functions import clock
from tidemark.operators import packing
from tidemark.operators.ordered import running_total

# 17 hourly run times in listed order, and their known schedule as (lane, start, length) in seconds.
RUN_TIMES = [
    "1m:40s", "2m:30s", "7m:40s", "2m:10s", "22m:30s", "18m:30s", "20m:40s", "2m:30s", "1m:50s",
    "12m:50s", "1m:50s", "3m:10s", "2m:40s", "2m:40s", "1m:10s", "2m:40s", "1m:50s",
]
SCHEDULE = [
    (1, 0, 1110), (1, 1110, 770), (1, 1880, 460), (1, 2340, 190), (1, 2530, 160), (1, 2690, 160),
    (1, 2850, 150), (1, 3000, 110), (1, 3110, 110), (1, 3220, 70), (2, 0, 1350), (2, 1350, 1240),
    (2, 2590, 160), (2, 2750, 150), (2, 2900, 130), (2, 3030, 110), (2, 3140, 100),
]


def loop(durations, horizon):
    """Job by job: order the lanes by load, ties as they stood; the first takes the job if it fits, else a new one."""
    load, order, took = [], [], {}
    for job in sorted(range(len(durations)), key=lambda j: (-durations[j], j)):
        order = sorted(order, key=load.__getitem__)
        if not order or load[order[0]] + durations[job] > horizon:
            order.append(len(load))
            load.append(0)
            chosen = order[-1]
        else:
            chosen = order[0]
        took[job] = (chosen, load[chosen])
        load[chosen] += durations[job]
    return [(order.index(lane) + 1, start) for lane, start in (took[j] for j in range(len(durations)))]


def by_pieces(durations, horizon):
    """The same placement from run lengths, for jobs within the horizon."""
    counts, ranks = {}, []
    for dur in durations:
        ranks.append(counts.get(dur, 0))
        counts[dur] = counts.get(dur, 0) + 1
    pieces, _ = packing._pieces(sorted(counts.items(), reverse=True), horizon, 0)
    out = []
    for dur, rank in zip(durations, ranks):
        p = next(p for p in pieces if p["dur"] == dur and p["lo"] <= rank < p["hi"])
        at = rank - p["lo"]
        out.append((p["lane"] + p["step"] * (at // p["per_lane"]), p["start"] + at % p["per_lane"] * dur))
    return out


@settings(max_examples=1500, deadline=None)
@given(st.integers(1, 24).flatmap(lambda h: st.tuples(st.just(h), st.lists(st.integers(0, h), min_size=1, max_size=45))))
def test_run_lengths_place_as_the_loop_does(case):
    horizon, durations = case
    assert by_pieces(durations, horizon) == loop(durations, horizon)


@pytest.mark.parametrize("large", [False, True])
def test_groups_with_long_jobs(spark, large):
    rng = np.random.default_rng(3)
    groups = {
        "hot": rng.integers(1, 20, 600).tolist(),
        "mixed": rng.integers(0, 90, 80).tolist(),
        "over": [70, 80, 70, 90, 70],
        "lone": [75],
        None: [10, 70, 20, 40, 60, 60],
    }
    groups["unknown"] = [0, 30, 50]
    rows = [(g, i, None if (g, i) == ("unknown", 0) else int(d)) for g, ds in groups.items() for i, d in enumerate(ds)]
    df = spark.createDataFrame(rows, "grp string, seq long, dur long").repartition(4)
    limits = dict(max_rows=20) if large else {}
    got = packing.pack_lanes(df, "grp", ["seq"], "dur", 60, **limits).collect()
    assert len(got) == len(rows)
    found = {(r.grp, r.seq): (r.lane, r.start_s) for r in got}
    for g, durations in groups.items():
        assert [found[(g, i)] for i in range(len(durations))] == loop(durations, 60), g


def test_known_schedule(spark):
    jobs = spark.createDataFrame(list(enumerate(RUN_TIMES)), "seq long, runtime string")
    jobs = jobs.withColumn("dur", clock.duration_s(F.col("runtime"))).withColumn("hour", F.lit(1))
    got = packing.pack_schedule(jobs, "hour", ["seq"], "dur").orderBy("lane", "start_min").collect()
    assert [(r.lane, round(r.start_min * 60), r.dur) for r in got] == SCHEDULE
    for ours, (_, start, length) in zip(got, SCHEDULE):
        assert (ours.cron_minute, ours.second_offset) == divmod(start, 60)
        assert (ours.end_min, ours.duration_min) == (pytest.approx((start + length) / 60), pytest.approx(length / 60))
    loads = {r.lane: r.used_min for r in packing.lane_load(
        packing.pack_schedule(jobs, "hour", ["seq"], "dur"), "lane", "duration_min").collect()}
    assert loads == {1: pytest.approx(54.8333333), 2: pytest.approx(54.0)}


def test_whole_units_only(spark):
    df = spark.createDataFrame([(1, 1, 1.5)], "grp int, seq int, dur double")
    with pytest.raises(TypeError):
        packing.pack_lanes(df, "grp", ["seq"], "dur", 60)


def test_second_sixty_carries(spark):
    df = spark.createDataFrame([(1, 1, 49.9999), (1, 2, 3.0), (1, 3, 2.0)], "lane int, seq int, dur double")
    got = packing.lane_schedule(df, "lane", ["seq"], "dur").orderBy("seq").collect()
    assert [(r.cron_minute, r.second_offset) for r in got] == [(0, 0), (50, 0), (53, 0)]


@pytest.mark.parametrize("max_rows", [10_000, 50])
def test_running_total(spark, max_rows):
    rng = np.random.default_rng(5)
    rows = [("hot" if i % 3 else None, i, int(v)) for i, v in enumerate(rng.integers(0, 9, 2000))]
    df = spark.createDataFrame(rows, "k string, seq long, v long").repartition(6)
    got = running_total(df, ["k"], ["seq"], F.col("v"), "before", max_rows).collect()
    sums, expected = {}, {}
    for k, i, v in rows:
        expected[(k, i)] = sums.get(k, 0)
        sums[k] = sums.get(k, 0) + v
    assert {(r.k, r.seq): r.before for r in got} == expected


def test_large_group_keys_beside_nulls(spark):
    big = 2**60 + 1
    rows = [(big, i, 40) for i in range(3)] + [(None, i, 20) for i in range(3)] + [(big + 1, 0, 70)]
    df = spark.createDataFrame(rows, "grp long, seq long, dur int")
    got = packing.pack_lanes(df, "grp", ["seq"], "dur", 60).collect()
    assert {(r.grp, r.seq): (r.lane, r.start_s) for r in got} == {
        **{(big, i): p for i, p in enumerate(loop([40] * 3, 60))},
        **{(None, i): p for i, p in enumerate(loop([20] * 3, 60))}, (big + 1, 0): (1, 0)}


def test_running_total_of_fractions_is_the_same_by_both_plans(spark):
    df = spark.range(3000).selectExpr("case when id % 10 = 0 then 'cold' else 'hot' end as lane", "id as seq", "cast(id * 7919 % 1000 as double) / 7 as dur")
    plans = [packing.lane_schedule(df, "lane", ["seq"], "dur", n).orderBy("seq").collect() for n in (10_000, 400, 50)]
    assert [tuple(r) for r in plans[0]] == [tuple(r.asDict()[c] for c in plans[0][0].asDict()) for r in plans[1]]
    assert [r.start_min for r in plans[0]] == [r.start_min for r in plans[2]]


def test_jobs_are_packed_in_tasks_of_bounded_rows(spark, monkeypatch):
    from tidemark.operators import ordered

    monkeypatch.setattr(ordered, "TASK_ROWS", 100, raising=False)
    df = spark.range(3000).selectExpr("id % 60 as grp", "id as seq", "id % 7 + 1 as dur")
    got = packing.pack_lanes(df, "grp", ["seq"], "dur", 60).withColumn("task", F.spark_partition_id()).collect()
    tasks = {}
    for r in got:
        tasks[r.task] = tasks.get(r.task, 0) + 1
    assert len(got) == 3000 and max(tasks.values()) < 400, sorted(tasks.values())[-3:]
    for g in range(3):
        mine = sorted((r.seq, r.dur, r.lane, r.start_s) for r in got if r.grp == g)
        assert [m[2:] for m in mine] == loop([m[1] for m in mine], 60)
