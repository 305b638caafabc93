"""Windows that are short, many and overlapping: every plan against a loop over rows and windows."""

import random
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.operators import ledger as led
from tidemark.operators.intervals import count_in_windows, join_windows

DAY = datetime(2025, 3, 1)
WINDOWS = "record_id long, window_start timestamp_ntz, window_end timestamp_ntz"


def made(seed, rows=600, windows=120):
    pick = random.Random(seed)
    at = [None if pick.random() < 0.02 else DAY + timedelta(minutes=pick.choice([0, 30, pick.randint(-100, 3_000)])) for _ in range(rows)]
    spans = [(k, DAY + timedelta(minutes=5 * k), DAY + timedelta(minutes=5 * k + pick.choice([5, 5, 60, 1_440, 0, -5]))) for k in range(windows)]
    spans += [(1_000, None, DAY), (1_001, DAY, None), (1_002, DAY, DAY + timedelta(days=9)), (1_003, DAY, DAY + timedelta(days=9)), (None, DAY, DAY + timedelta(hours=1))]
    return list(enumerate(at)), spans


def holds(span, at, closed):
    _, low, high = span
    return None not in (low, high, at) and (low <= at < high or (closed == "both" and low <= at == high))


@pytest.mark.parametrize("closed", ["left", "both"])
@pytest.mark.parametrize("limit", [1_000_000, 0])
def test_counts_and_joins_by_either_plan(spark, closed, limit):
    rows, spans = made(7)
    df = spark.createDataFrame(rows, "id long, ts timestamp_ntz").repartition(4)
    windows = spark.createDataFrame(spans, WINDOWS)
    sums = count_in_windows(df, "ts", windows, "record_id", {"n": F.lit(1), "ids": F.col("id")}, closed=closed, max_bounds=limit).collect()
    want = [(s[0], *(sum(v) for v in zip(*[(1, i) for i, at in rows if holds(s, at, closed)] or [(0, 0)]))) for s in spans]
    assert Counter(map(tuple, sums)) == Counter(want)
    met = join_windows(df, "ts", windows, "record_id", closed=closed, max_bounds=limit, sweep_rows=50).collect()
    assert Counter((r.id, r.ts, r.record_id) for r in met) == Counter((i, at, s[0]) for i, at in rows for s in spans if holds(s, at, closed))


def test_many_pairs_are_swept(spark):
    rows, spans = made(8, 200, 60)
    df, windows = spark.createDataFrame(rows, "id long, ts timestamp"), spark.createDataFrame(spans, WINDOWS)
    plans = [sorted(map(tuple, join_windows(df, "ts", windows, "record_id", max_pairs=n, sweep_rows=30).collect()), key=str) for n in (0, 500_000)]
    assert plans[0] == plans[1] and plans[0]


def test_without_windows_or_rows(spark):
    rows, spans = made(9, 20, 3)
    df, windows = spark.createDataFrame(rows, "id long, ts timestamp_ntz"), spark.createDataFrame(spans, WINDOWS)
    assert join_windows(df, "ts", windows.limit(0), "record_id").columns == ["id", "ts", "record_id"]
    assert join_windows(df, "ts", windows.limit(0), "record_id").count() == 0
    assert count_in_windows(df, "ts", windows.limit(0), "record_id", {"n": F.lit(1)}).count() == 0
    assert {r.n for r in count_in_windows(df.limit(0), "ts", windows, "record_id", {"n": F.lit(1)}).collect()} == {0}


def test_a_row_is_met_with_its_windows_only(spark):
    """288 windows a day: the join gets one pair per row, not one per row and window of the day."""
    df = spark.range(2_000).select("id", (F.lit(DAY).cast("timestamp_ntz") + F.make_dt_interval(secs=F.col("id") * 40)).alias("ts"))
    windows = spark.range(288).select(F.col("id").alias("record_id"), (F.lit(DAY).cast("timestamp_ntz") + F.make_dt_interval(mins=F.col("id").cast("int") * 5)).alias("window_start"))
    windows = windows.withColumn("window_end", F.col("window_start") + F.expr("interval 5 minutes"))
    met = join_windows(df, "ts", windows, "record_id")
    plan = met._jdf.queryExecution().optimizedPlan().toString()
    assert met.count() == 2_000 and ">=" not in plan.split("Join")[1].split("\n")[0]
    counted = led.reconcile_windows(df, df.filter("id % 2 = 0"), windows, "ts").collect()
    assert sum(r.source_count for r in counted) == 2_000 and sum(r.target_count for r in counted) == 1_000
