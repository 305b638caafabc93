"""The work ledger, reconciliation, alerts, lanes and packing."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tidemark.catalog import fixtures as fx
from tidemark.catalog.registry import query
from tidemark.functions import clock
from tidemark.operators import ledger as led
from tidemark.operators import packing
from tidemark.operators.ordered import dealt
from tidemark.operators.windows import bucket_minutes
from tidemark.plans import ingest
from tidemark.session import scratch_path, table
from tidemark.sinks import keyed

NOW, AGE, OPEN_FROM = datetime(2000, 6, 1), timedelta(days=1500), datetime(1997, 1, 1)
OLDEST = NOW - AGE
SOURCE_SQL = "(select l_orderkey as record_id, count(*) as s from lineitem group by 1)"
TARGET_SQL = "(select l_orderkey as record_id, count(*) as t from lineitem where l_linestatus = 'F' group by 1)"
COUNTS_SQL = f"""(select record_id, coalesce(s, 0) as source_count, coalesce(t, 0) as target_count
    from {SOURCE_SQL} full join {TARGET_SQL} using (record_id))"""
REASON = (f"case when status <> 'pending' then null when not (window_start >= timestamp '{OLDEST}' and window_end <= timestamp '{NOW}') "
          f"then 'window_outside_range' when window_start < timestamp '{OPEN_FROM}' then 'history_not_accessible' end")
CHECKED_SQL = f"(select * exclude (status), case when reason is not null then 'failed_permanently' else status end as status " \
              f"from (select *, {REASON} as reason from {fx.LEDGER_SQL}))"
ACTION_SQL = f"""(select l.*, coalesce(c.source_count, 0) as sc, coalesce(c.target_count, 0) as tc,
    case when not audit_enabled then 'process' when coalesce(c.source_count, 0) = coalesce(c.target_count, 0) then 'completed'
      else 'clean_and_process' end as action
    from {CHECKED_SQL} l left join {COUNTS_SQL} c using (record_id) where l.status = 'pending')"""


def _ledger(spark, folder):
    return fx.select(spark, folder, "orders", fx.LEDGER)


def _sides(spark, folder):
    lines = table(spark, folder, "lineitem").withColumnRenamed("l_orderkey", "record_id")
    return lines.select("record_id"), lines.filter("l_linestatus = 'F'").select("record_id")


@query("reconcile_counts", f"select *, source_count = target_count as equal from {COUNTS_SQL}")
def reconcile_counts(spark, folder):
    return led.reconcile_counts(*_sides(spark, folder))


@query("reconcile_windows", f"""
    select record_id, source_count, target_count, source_count = target_count as equal from (
      select r.record_id, (select count(*) from orders o where o.o_orderdate >= r.window_start and o.o_orderdate < r.window_end) as source_count,
        (select count(*) from orders o where o.o_orderdate >= r.window_start and o.o_orderdate < r.window_end and o_orderstatus <> 'P') as target_count
      from {fx.LEDGER_SQL} r where status = 'pending' and window_start >= timestamp '1997-06-01')""")
def reconcile_windows(spark, folder):
    pending = _ledger(spark, folder).filter("status = 'pending' and window_start >= timestamp_ntz'1997-06-01'")
    orders = table(spark, folder, "orders")
    return led.reconcile_windows(orders, orders.filter("o_orderstatus <> 'P'"), pending, "o_orderdate")


SLICES_SQL = """(select distinct cast(epoch(time_bucket(interval '5 minutes', ts)) as bigint) as record_id,
    time_bucket(interval '5 minutes', ts) as window_start, time_bucket(interval '5 minutes', ts) + interval '20 minutes' as window_end from events)"""


def _slices(spark, folder):
    """Windows of 20 minutes that begin every 5, so four hold each instant."""
    starts = bucket_minutes(table(spark, folder, "events").select("ts"), "ts", 5, "window_start").select("window_start").distinct()
    return starts.select(F.unix_seconds(F.col("window_start").cast("timestamp")).alias("record_id"), F.col("window_start").cast("timestamp_ntz").alias("window_start"),
                         (F.col("window_start") + F.expr("interval 20 minutes")).cast("timestamp_ntz").alias("window_end"))


@query("reconcile_slices", f"""
    select record_id, source_count, target_count, source_count = target_count as equal from (
      select record_id, count(e.ts) as source_count, count(e.ts) filter (event_type <> 'error') as target_count
      from {SLICES_SQL} w left join events e on e.ts >= w.window_start and e.ts < w.window_end group by record_id)""")
def reconcile_slices(spark, folder):
    events = table(spark, folder, "events")
    return led.reconcile_windows(events, events.filter("event_type <> 'error'"), _slices(spark, folder), "ts")


@query("window_members", f"""
    select event_id, w.record_id from {SLICES_SQL} w join events e on e.ts >= w.window_start and e.ts <= w.window_end""")
def window_members(spark, folder):
    return led.with_record(table(spark, folder, "events").select("event_id", "ts"), _slices(spark, folder), "ts", closed="both").drop("ts")


@query("clean_target", f"""
    select l_orderkey as record_id, l_linenumber, l_partkey from lineitem where l_linestatus = 'F'
      and l_orderkey not in (select record_id from {ACTION_SQL} where action = 'clean_and_process')""")
def clean_target(spark, folder):
    source, _ = _sides(spark, folder)
    lines = table(spark, folder, "lineitem").withColumnRenamed("l_orderkey", "record_id").filter("l_linestatus = 'F'")
    target = lines.select("record_id", "l_linenumber", "l_partkey")
    checked = led.classify_window(_ledger(spark, folder), NOW, AGE, OPEN_FROM).filter("status = 'pending'")
    judged = led.classify_processed(checked, led.reconcile_counts(source, target.select("record_id")), NOW)
    return led.clean_target(target, judged)


@query("upsert", """
    select o_orderkey, o_orderstatus from orders where o_orderstatus <> 'P'
    union all select o_orderkey, 'X' from orders where o_orderstatus = 'P'
    union all select -1 - o_orderkey, 'N' from orders where o_orderpriority = '5-LOW'""")
def upsert(spark, folder):
    orders = table(spark, folder, "orders")
    base = orders.select("o_orderkey", "o_orderstatus")
    changed = base.filter("o_orderstatus = 'P'").withColumn("o_orderstatus", F.lit("X"))
    added = orders.filter("o_orderpriority = '5-LOW'").select((-1 - F.col("o_orderkey")).alias("o_orderkey"), F.lit("N").alias("o_orderstatus"))
    return led.upsert(base, changed.unionAll(added), "o_orderkey")


@query("not_yet_loaded", """
    select o_orderkey, cast(isoyear(o_orderdate) as int) as iso_year, cast(weekofyear(o_orderdate) as int) as iso_week
    from orders where (isoyear(o_orderdate), weekofyear(o_orderdate)) not in
      (select (isoyear(l_shipdate), weekofyear(l_shipdate)) from lineitem where l_shipdate < timestamp '1997-03-01')""")
def not_yet_loaded(spark, folder):
    def weeks(df, day):
        return df.withColumns({"iso_year": clock.iso_year(F.col(day)), "iso_week": clock.iso_week(F.col(day))})

    orders = weeks(table(spark, folder, "orders"), "o_orderdate").select("o_orderkey", "iso_year", "iso_week")
    shipped = weeks(table(spark, folder, "lineitem").filter("l_shipdate < timestamp_ntz'1997-03-01'"), "l_shipdate")
    return led.not_yet_loaded(orders, shipped)


@query("pick_pending", f"""
    select record_id, window_start from {fx.LEDGER_SQL} where status = 'pending' order by window_start, record_id limit 500""")
def pick_pending(spark, folder):
    return led.pick_pending(_ledger(spark, folder), 500).select("record_id", "window_start")


@query("classify_window", f"select record_id, status, reason from {CHECKED_SQL}")
def classify_window(spark, folder):
    return led.classify_window(_ledger(spark, folder), NOW, AGE, OPEN_FROM).select("record_id", "status", "reason")


@query("classify_processed", f"""
    select record_id, action, case when action = 'completed' then 'completed' else status end as status,
      case when action = 'completed' then sc end as source_count, case when action = 'completed' then tc end as target_count,
      case when action = 'completed' then timestamp '{NOW}' end as completed_at from {ACTION_SQL}""")
def classify_processed(spark, folder):
    checked = led.classify_window(_ledger(spark, folder), NOW, AGE, OPEN_FROM).filter("status = 'pending'")
    done = led.classify_processed(checked, led.reconcile_counts(*_sides(spark, folder)), NOW)
    return done.select("record_id", "action", "status", "source_count", "target_count", "completed_at")


@query("next_batch", f"""
    select record_id, window_start, action from {ACTION_SQL} where action <> 'completed'
    order by window_start, record_id limit 400""")
def next_batch(spark, folder):
    counts = led.reconcile_counts(*_sides(spark, folder))
    return led.next_batch(_ledger(spark, folder), counts, 400, NOW, AGE, OPEN_FROM).select("record_id", "window_start", "action")


STUCK = "case when stage_export <> 'done' then 'export' when stage_transfer <> 'done' then 'transfer' when stage_audit <> 'done' then 'audit' end"


@query("find_stuck", f"""
    select record_id, window_start, {STUCK} as stuck_stage from {fx.LEDGER_SQL}
    where status = 'in_progress' and started_at < timestamp '{OLDEST}'""")
def find_stuck(spark, folder):
    return led.find_stuck(_ledger(spark, folder), NOW, AGE).select("record_id", "window_start", "stuck_stage")


RESET_SQL = f"""
    select * exclude (stuck, st) replace (case when stuck then 'pending' else status end as status,
      case when stuck and st = 'export' then 'open' else stage_export end as stage_export,
      case when stuck and st = 'transfer' then 'open' else stage_transfer end as stage_transfer,
      case when stuck and st = 'audit' then 'open' else stage_audit end as stage_audit)
    from (select *, status = 'in_progress' and started_at < timestamp '{OLDEST}' as stuck, {STUCK} as st from {fx.LEDGER_SQL})"""


@query("reset_stuck", RESET_SQL)
def reset_stuck(spark, folder):
    ledger = _ledger(spark, folder)
    return led.reset_stuck(ledger, led.find_stuck(ledger, NOW, AGE))


@query("recover_ledger", RESET_SQL)
def recover_ledger(spark, folder):
    return led.recover(_ledger(spark, folder), NOW, AGE)


@query("settle_ledger", f"""
    select record_id, coalesce(case when a.action = 'completed' then 'completed' end, c.status) as status, c.reason,
      case when a.action = 'completed' then a.sc end as source_count
    from {CHECKED_SQL} c left join (select record_id, action, sc from {ACTION_SQL}) a using (record_id)""")
def settle_ledger(spark, folder):
    out = led.settle(_ledger(spark, folder), led.reconcile_counts(*_sides(spark, folder)), NOW, AGE, OPEN_FROM)
    return out.select("record_id", "status", "reason", "source_count")


RULES = ingest.LoadRules(NOW, AGE, OPEN_FROM, AGE, batch=120, part_bytes=500)
FLOW_SQL = f"""
    with r as (select record_id, window_start, window_end, audit_enabled, case when status = 'in_progress' and
        started_at < timestamp '{OLDEST}' then 'pending' else status end as status from {fx.LEDGER_SQL}),
    k as (select *, {REASON} as reason from r),
    a as (select k.*, coalesce(source_count, 0) as sc, coalesce(target_count, 0) as tc from k left join {COUNTS_SQL} using (record_id)),
    b as (select *, case when reason is not null then 'failed_permanently' when status = 'pending' and audit_enabled and sc = tc
        then 'completed' else status end as checked from a),
    p as (select record_id from b where checked = 'pending' order by window_start, record_id limit {RULES.batch})
    select record_id, case when record_id in (from p) then 'completed' else checked end as status, reason,
      case when record_id in (from p) or (status = 'pending' and checked = 'completed') then sc end as source_count,
      case when record_id in (from p) then sc when status = 'pending' and checked = 'completed' then tc end as target_count
    from b"""


@query("load_batch", FLOW_SQL)
def load_batch(spark, folder):
    lines = table(spark, folder, "lineitem").withColumnRenamed("l_orderkey", "record_id")
    there = lines.filter("l_linestatus = 'F'").select("record_id")
    order = ("l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")
    out = ingest.load_batch(_ledger(spark, folder), lines, there, order, scratch_path(spark, "load"), RULES)
    return out.select("record_id", "status", "reason", "source_count", "target_count")


WINDOW_RULES = ingest.LoadRules(NOW, AGE, OPEN_FROM, AGE, batch=30)
LATE = "window_start >= {0}'2000-05-20' and window_start < {0}'2000-06-05'"  # some windows end after NOW
WINDOW_SQL = f"""
    with r as (select * from {CHECKED_SQL} where {LATE.format("timestamp ")}),
    c as (select r.record_id, count(*) as sc, sum(l_partkey) as parts,
        count(*) filter (r.record_id % 7 = 0 or (r.record_id % 5 = 0 and l_linenumber % 2 = 0)) as tc,
        sum(l_partkey) filter (r.record_id % 7 = 0 or (r.record_id % 5 = 0 and l_linenumber % 2 = 0)) as old_parts
      from r join lineitem l on l_shipdate >= window_start and l_shipdate < window_end where status in ('pending', 'failed_permanently') group by 1),
    a as (select r.*, coalesce(sc, 0) as sc, coalesce(tc, 0) as tc, parts, old_parts, r.status = 'pending' and audit_enabled and coalesce(sc, 0) = coalesce(tc, 0) as ok
      from r left join c using (record_id)),
    p as (select record_id from a where status = 'pending' and not ok order by window_start, record_id limit {WINDOW_RULES.batch}),
    b as (select *, record_id in (from p) as loaded from a)
    select record_id, case when ok or loaded then 'completed' else status end as status, case when ok or loaded then sc end as source_count,
      case when ok or loaded then sc end as target_count, case when loaded then sc else tc end as stored,
      cast(coalesce(case when loaded then parts else old_parts end, 0) as bigint) as parts from b"""


@query("load_windows", WINDOW_SQL)
def load_windows(spark, folder):
    """A table that holds some records whole and some by half; what it holds afterwards is counted per record."""
    root = scratch_path(spark, "store")
    late = _ledger(spark, folder).filter(LATE.format("timestamp_ntz"))
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate")
    held = led.with_record(lines, late.filter("status = 'pending'"), "l_shipdate")
    keyed.upsert_stored(held.filter("record_id % 7 = 0 or (record_id % 5 = 0 and l_linenumber % 2 = 0)"), root, led.KEY)
    out = ingest.load_windows(late, lines, "l_shipdate", root, WINDOW_RULES)
    stored = keyed.read_keyed(spark, root, held.schema).groupBy(led.KEY).agg(F.count(F.lit(1)).alias("stored"), F.sum("l_partkey").alias("parts"))
    return out.join(stored, led.KEY, "left").select(
        "record_id", "status", "source_count", "target_count", F.coalesce("stored", F.lit(0)).alias("stored"), F.coalesce("parts", F.lit(0)).alias("parts"))


ALERTS_SQL = f"""(select run_id, run_s, case when run_s <= 0 or k * 300 < 1400 then 'completed' else 'timeout' end as outcome,
    case when run_s <= 0 then 0 when k * 300 < 1400 then k else 5 end as alerts,
    case when run_s <= 0 then 1 when k * 300 < 1400 then k + 1 else 5 end as checks
    from (select *, cast(ceil(run_s / 300.0) as bigint) as k from {fx.sql('orders', fx.RUNS)}))"""


@query("alert_outcome", f"select * from {ALERTS_SQL}")
def alert_outcome(spark, folder):
    return led.alert_outcome(fx.select(spark, folder, "orders", fx.RUNS), 300, 1400)


@query("alert_events", f"""
    select a.run_id, a.outcome, n as alert_no, least(n * 300, 1400) as alert_at_s
    from {ALERTS_SQL} a, generate_series(1, 5) t(n) where n <= a.alerts""")
def alert_events(spark, folder):
    return led.alert_events(fx.select(spark, folder, "orders", fx.RUNS), 300, 1400).select(
        "run_id", "outcome", "alert_no", "alert_at_s")


LANE_SQL = f"""(select *, coalesce(sum(dur) over (partition by grp order by {', '.join(fx.JOB_ORDER)}
    rows between unbounded preceding and 1 preceding), 0) as start_min from {fx.sql('lineitem', fx.JOBS)})"""


@query("lane_schedule", f"""
    select grp, l_orderkey, l_linenumber, l_partkey, dur, start_min, start_min + dur as end_min,
      cast(cast(floor(start_min) as bigint) % 60 as int) as cron_minute,
      cast((start_min - floor(start_min)) * 60 as int) as second_offset from {LANE_SQL}""")
def lane_schedule(spark, folder):
    jobs = fx.select(spark, folder, "lineitem", fx.JOBS)
    return packing.lane_schedule(jobs, "grp", fx.JOB_ORDER, "dur").select(
        "grp", "l_orderkey", "l_linenumber", "l_partkey", "dur", "start_min", "end_min", "cron_minute", "second_offset")


@query("lane_load", """
    select l_suppkey as grp, count(*) as jobs, sum(l_quantity) as used_min, sum(l_quantity) / 60 as load_share
    from lineitem group by 1""")
def lane_load(spark, folder):
    return packing.lane_load(fx.select(spark, folder, "lineitem", fx.JOBS), "grp", "dur")


def _packed(spark, folder):
    jobs = fx.select(spark, folder, "lineitem", fx.JOBS).withColumn("dur", F.col("dur").cast("bigint"))
    return packing.pack_lanes(jobs, "grp", fx.JOB_ORDER, "dur", 60)


# The packing job by job: the lane list is sorted by load before each job, ties in list order, and a
# lane's number is its place in the list after the group's last job.
PACK_SQL = f"""
    with recursive jobs as (select *, cast(dur as bigint) as d, row_number() over (
        partition by grp order by dur desc, {', '.join(fx.JOB_ORDER)}) as step from {fx.sql('lineitem', fx.JOBS)}),
    walk as (
      select grp, step, [{{'load': d, 'pos': 1::bigint, 'id': 1::bigint}}] as lanes, 1::bigint as id, 0::bigint as start_s
        from jobs where step = 1
      union all
      select grp, step, case when fits then [{{'load': s[1].load + d, 'pos': 1::bigint, 'id': s[1].id}}] || s[2:]
          else s || [{{'load': d, 'pos': 0::bigint, 'id': len(s) + 1}}] end,
        case when fits then s[1].id else len(s) + 1 end, case when fits then s[1].load else 0 end
      from (select j.grp, j.step, j.d, w.s, w.s[1].load + j.d <= 60 as fits
        from (select grp, step, list_sort(list_transform(lanes, lambda x, i: {{'load': x.load, 'pos': i, 'id': x.id}})) as s from walk) w
        join jobs j on j.grp = w.grp and j.step = w.step + 1)),
    final as (select grp, unnest(lanes).id as id, generate_subscripts(lanes, 1) as lane from walk
      where (grp, step) in (select (grp, max(step)) from jobs group by grp))
    select j.grp, j.l_orderkey, j.l_linenumber, j.l_partkey, j.d as dur, cast(f.lane as bigint) as lane, w.start_s, w.start_s + j.d as end_s
    from jobs j join walk w on w.grp = j.grp and w.step = j.step join final f on f.grp = w.grp and f.id = w.id"""


@query("pack_lanes", PACK_SQL)
def pack_lanes(spark, folder):
    return _packed(spark, folder).select("grp", "l_orderkey", "l_linenumber", "l_partkey", "dur", "lane", "start_s", "end_s")


@query("packed_lane_totals", """
    select l_suppkey as grp, count(*) as jobs, cast(sum(l_quantity) as bigint) as used, true as fits, true as gapless
    from lineitem group by 1""")
def packed_lane_totals(spark, folder):
    """What any packing must keep: every job once, no lane over the horizon, no gap or overlap in a lane."""
    jobs = table(spark, folder, "lineitem").count()
    lanes = dealt(_packed(spark, folder).select("grp", "lane", "dur", "start_s", "end_s"), ["grp", "lane"], jobs).groupBy("grp", "lane").agg(
        F.count(F.lit(1)).alias("n"), F.sum("dur").alias("used"), F.max("end_s").alias("last"),
        F.count_distinct("start_s").alias("starts"))
    return lanes.groupBy("grp").agg(
        F.sum("n").alias("jobs"), F.sum("used").alias("used"), (F.max("last") <= 60).alias("fits"),
        F.min((F.col("last") == F.col("used")) & (F.col("starts") == F.col("n"))).alias("gapless"))
