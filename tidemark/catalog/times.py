"""Windows, trends and time texts."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import functions as F

from tidemark.catalog import fixtures as fx
from tidemark.catalog.registry import query
from tidemark.operators import filters, rollups, trends, windows
from tidemark.session import table
from tidemark.sources.extract import extract_window

ZONE = "America/Los_Angeles"
FIRST, LAST = date(2023, 12, 20), date(2024, 2, 10)
LOCAL_DAY = f"cast(timezone('{ZONE}', timezone('UTC', ts)) as date)"
SPINE = f"(select cast(d as date) as target_day from generate_series(date '{FIRST}', date '{LAST}', interval 1 day) t(d))"


@query("daily_counts", f"""
    select s.target_day, coalesce(c.n, 0) as row_count from {SPINE} s
    left join (select {LOCAL_DAY} as target_day, count(*) as n from events group by 1) c using (target_day)""")
def daily_counts(spark, folder):
    return windows.daily_counts(table(spark, folder, "events"), "ts", ZONE, FIRST, LAST)


@query("day_windows", f"""
    select s.target_day, timezone('UTC', timezone('{ZONE}', cast(s.target_day as timestamp))) as start_utc,
      timezone('UTC', timezone('{ZONE}', cast(s.target_day + interval 1 day as timestamp))) as end_utc,
      c.first_ts, c.last_ts
    from {SPINE} s join (select {LOCAL_DAY} as target_day, min(ts) as first_ts, max(ts) as last_ts from events group by 1) c
    using (target_day)""")
def day_windows(spark, folder):
    events = table(spark, folder, "events")
    seen = events.groupBy(windows.clock.local_date(F.col("ts"), ZONE).alias("target_day")).agg(
        F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))
    return windows.day_windows(spark, ZONE, FIRST, LAST).join(seen, "target_day")


@query("trend_windows", """
    with r as (select o_orderkey, o_orderdate + to_hours(cast(o_orderkey % 24 as int)) as start_ts,
        o_orderdate + to_hours(cast(o_custkey % 120 as int)) as end_ts from orders),
    w as (select *, unnest(generate_series(0, 10)) as window_no from r where start_ts < end_ts),
    b as (select o_orderkey, start_ts, end_ts, window_no,
        greatest(date_trunc('day', start_ts) + to_days(cast(window_no * 2 as int)), start_ts) as window_start,
        least(date_trunc('day', start_ts) + to_days(cast(window_no * 2 + 2 as int)), end_ts) as window_end from w)
    select o_orderkey, start_ts, end_ts, cast(window_no as int) as window_no, window_start, window_end
    from b where window_start < window_end""")
def trend_windows(spark, folder):
    requests = table(spark, folder, "orders").selectExpr(
        "o_orderkey",
        "o_orderdate + make_dt_interval(0, cast(o_orderkey % 24 as int)) as start_ts",
        "o_orderdate + make_dt_interval(0, cast(o_custkey % 120 as int)) as end_ts",
    )
    return windows.trend_windows(requests, 2)


# Both ends lie inside a local day, and all events between them.
START, END = datetime(2024, 1, 1), datetime(2024, 1, 31, 6)
TREND_LABEL = f"""least(
    cast(date '2023-12-31' + to_days(cast(floor(({LOCAL_DAY} - date '2023-12-31') / {{n}}) * {{n}} + {{n}} - 1 as int)) as date),
    cast(timezone('{ZONE}', timezone('UTC', timestamp '{END}')) - interval 1 microsecond as date))"""


def _trended(relation: str, days: int) -> str:
    return (f"(select *, {TREND_LABEL.format(n=days)} as trend_day from {relation} "
            f"where ts >= timestamp '{START}' and ts < timestamp '{END}')")


def _compute(df, dims):
    return rollups.compute_stats(df, dims, order=("ts", "row_id"))


def _storage(disk):
    return lambda df, dims: rollups.storage_stats(df, dims, fx.STORAGE_ORDER, disk)


@query("compute_trend", fx.compute_stats_sql(_trended(fx.COMPUTE_SQL, 1), ["trend_day"]))
def compute_trend(spark, folder):
    return trends.trend(fx.compute(spark, folder), "ts", ZONE, START, END, _compute)


@query("compute_trend_by_service", fx.compute_stats_sql(_trended(fx.COMPUTE_SQL, 3), ["trend_day", "service"]))
def compute_trend_by_service(spark, folder):
    return trends.trend(fx.compute(spark, folder), "ts", ZONE, START, END, _compute, ["service"], days=3)


@query("storage_trend_by_owner", fx.storage_stats_sql(
    f"(select *, least(cast(date '1995-01-01' + to_days(cast(floor((cast(ts as date) - date '1995-01-01') / 30) * 30 + 29 as int)) as date), "
    f"date '2002-06-30') as trend_day from {fx.STORAGE_SQL} where ts >= timestamp '1995-01-01' and ts < timestamp '2002-07-01')",
    ["trend_day", "owner"], "mount_point"))
def storage_trend_by_owner(spark, folder):
    return trends.trend(fx.storage(spark, folder), "ts", "UTC", datetime(1995, 1, 1), datetime(2002, 7, 1),
                        _storage("mount_point"), ["owner"], days=30)


@query("bucket_minutes", "select time_bucket(interval '5 minutes', ts) as bucket_start, count(*) as n from events group by 1")
def bucket_minutes(spark, folder):
    return windows.count_buckets(table(spark, folder, "events"), "ts", 5)


@query("iso_week", """
    select cast(isoyear(o_orderdate) as int) as iso_year, cast(weekofyear(o_orderdate) as int) as iso_week,
      printf('%04d/week_%02d', isoyear(o_orderdate), weekofyear(o_orderdate)) as week_folder, count(*) as n
    from orders group by all""")
def iso_week(spark, folder):
    weeks = windows.iso_weeks(table(spark, folder, "orders"), "o_orderdate")
    return weeks.groupBy("iso_year", "iso_week", "week_folder").agg(F.count(F.lit(1)).alias("n"))


NOW = datetime(2024, 2, 1, 12, 0)
WINDOW_REQUESTS = [
    "event_id",
    "case when event_id % 5 in (0, 1, 3) then ts end as start_ts",
    "case when event_id % 5 = 0 then ts + interval '1' hour * cast(user_id % 3 as int) "
    "when event_id % 5 = 4 then ts end as end_ts",
    "case when event_id % 5 in (1, 2) then user_id % 7000 end as duration_s",
]


@query("resolve_windows", f"""
    select *, window_start < window_end as valid from (select *,
      case when start_ts is not null then start_ts when duration_s is not null
        then timestamp '{NOW}' - to_seconds(duration_s) else timestamp '{NOW}' - interval 1 hour end as window_start,
      case when start_ts is not null and end_ts is not null then end_ts
        when start_ts is not null and duration_s is not null then start_ts + to_seconds(duration_s)
        else timestamp '{NOW}' end as window_end
    from {fx.sql('events', WINDOW_REQUESTS)})""")
def resolve_windows(spark, folder):
    return windows.resolve_windows(fx.select(spark, folder, "events", WINDOW_REQUESTS), NOW)


TIME_TEXTS = [
    "o_orderkey",
    "case o_orderkey % 7 when 0 then '2025-10-14T14:33:21+05:30' when 1 then '31/12/2025 10:00:00' "
    "when 2 then '2025-01-02T03:04:05Z' when 3 then '03/04/2025 00:30:00' when 4 then '12/31/2025 23:59:59' "
    "when 5 then null else 'junk' end as s",
]


@query("parse_times", f"""
    select *, s is null or s_utc is not null as s_ok from (select *, case
      when regexp_matches(s, 'T.*([+-]\\d\\d:\\d\\d|Z)$') then timezone('UTC', cast(s as timestamptz))
      when try_strptime(s, '%d/%m/%Y %H:%M:%S') is not null
        then timezone('UTC', timezone('{ZONE}', try_strptime(s, '%d/%m/%Y %H:%M:%S')))
      when try_strptime(s, '%m/%d/%Y %H:%M:%S') is not null
        then timezone('UTC', timezone('{ZONE}', try_strptime(s, '%m/%d/%Y %H:%M:%S'))) end as s_utc
    from {fx.sql('orders', TIME_TEXTS)})""")
def parse_times(spark, folder):
    return windows.parse_times(fx.select(spark, folder, "orders", TIME_TEXTS), "s", assume_zone=ZONE)


@query("age_seconds", f"""
    select event_id, cast(date_diff('microsecond', ts, timestamp '{NOW}') // 1000000 as bigint) as age_s from events
    where ts <= timestamp '{NOW}'""")
def age_seconds(spark, folder):
    events = extract_window(table(spark, folder, "events"), "ts", datetime(1970, 1, 1), NOW)
    return windows.age_seconds(events, NOW, "ts").select("event_id", "age_s")


def iso_sql(ts: str, zone: str) -> str:
    local = f"timezone('{zone}', timezone('UTC', {ts}))"
    minutes = f"date_diff('minute', {ts}, {local})"
    return (f"strftime({local}, '%Y-%m-%dT%H:%M:%S') || case when {minutes} < 0 then '-' else '+' end || "
            f"lpad(cast(abs({minutes}) // 60 as varchar), 2, '0') || ':' || lpad(cast(abs({minutes}) % 60 as varchar), 2, '0')")


# One instant on both sides of a clock change per row: ten months are spread over the events.
SPREAD = "date_trunc('second', ts) + interval '1' day * cast(event_id % 300 as int)"


@query("render_zones", f"""
    select event_id, {iso_sql('t', 'UTC')} as at_utc, {iso_sql('t', ZONE)} as at_los_angeles,
      {iso_sql('t', 'Asia/Kolkata')} as at_kolkata from (select event_id, {SPREAD} as t from events)""")
def render_zones(spark, folder):
    spread = fx.select(spark, folder, "events", ["event_id", f"{SPREAD} as t"])
    return windows.render_zones(spread, "t").drop("t")


@query("shift_seconds", f"select event_id, {iso_sql('ts - to_seconds(user_id)', 'Asia/Kolkata')} as shifted from events")
def shift_seconds(spark, folder):
    return windows.shift_seconds(table(spark, folder, "events"), "ts", "user_id", "Asia/Kolkata").select("event_id", "shifted")


DURATIONS = [
    "o_orderkey", "o_custkey",
    "case o_orderkey % 4 when 0 then concat(cast(o_orderkey % 60 as varchar(10)), 'm:', cast(o_custkey % 60 as varchar(10)), 's') "
    "when 1 then concat(cast(o_custkey % 9 as varchar(10)), 'd ', cast(o_orderkey % 24 as varchar(10)), 'H') "
    "when 2 then cast(o_orderkey as varchar(20)) else concat(' ', cast(o_orderkey % 30 as varchar(10)), ' h') end as runtime",
]


@query("duration_seconds", f"""
    select *, cast(case o_orderkey % 4 when 0 then (o_orderkey % 60) * 60 + o_custkey % 60
      when 1 then (o_custkey % 9) * 86400 + (o_orderkey % 24) * 3600 when 2 then 0
      else (o_orderkey % 30) * 3600 end as bigint) as duration_s from {fx.sql('orders', DURATIONS)}""")
def duration_seconds(spark, folder):
    return windows.duration_seconds(fx.select(spark, folder, "orders", DURATIONS), "runtime")


@query("newest", "select event_id, ts from events order by ts desc, event_id desc limit 25")
def newest(spark, folder):
    return filters.newest(table(spark, folder, "events").select("event_id", "ts"), "ts", "event_id", 25)


@query("order_rows", "select o_orderkey, o_orderdate from orders order by o_orderdate, o_orderkey")
def order_rows(spark, folder):
    return filters.order_rows(table(spark, folder, "orders").select("o_orderkey", "o_orderdate"), "o_orderdate", "o_orderkey")
