"""Filters, roll-ups and reporting lines over the fleet inventories."""

from __future__ import annotations

from dataclasses import replace
from datetime import datetime

from pyspark.sql import functions as F

from tidemark.catalog import fixtures as fx
from tidemark.catalog.registry import query
from tidemark.operators import filters, people, rollups, sketches
from tidemark.plans import fleet
from tidemark.session import scratch_path, table
from tidemark.sources.extract import extract_window, query_rows

JAN, FEB = datetime(1998, 1, 1), datetime(1998, 2, 1)


@query("extract_window", """
    select o_orderkey, o_orderdate, o_totalprice from orders
    where o_orderdate between timestamp '1998-01-01' and timestamp '1998-02-01' and o_orderstatus <> 'P'""")
def extract(spark, folder):
    return extract_window(table(spark, folder, "orders"), "o_orderdate", JAN, FEB,
                          fields=["o_orderkey", "o_orderdate", "o_totalprice"], extra=F.col("o_orderstatus") != "P")


@query("extract_window_half_open", """
    select o_orderkey, o_orderdate from orders
    where o_orderdate >= timestamp '1998-01-01' and o_orderdate < timestamp '1998-02-01'""")
def extract_half_open(spark, folder):
    return extract_window(table(spark, folder, "orders"), "o_orderdate", JAN, FEB, "left", ["o_orderkey", "o_orderdate"])


@query("count_window", """
    select count(*) as row_count from orders
    where o_orderdate between timestamp '1998-01-01' and timestamp '1998-02-01'""")
def count_window(spark, folder):
    return rollups.count_window(table(spark, folder, "orders"), "o_orderdate", JAN, FEB)


@query("count_window_empty", "select count(*) as row_count from orders where o_orderdate > timestamp '2090-01-01'")
def count_window_empty(spark, folder):
    return rollups.count_window(table(spark, folder, "orders"), "o_orderdate", datetime(2090, 1, 1), datetime(2091, 1, 1))


@query("query_rows", "select * from orders where o_orderstatus = 'P' and o_orderpriority = '5-LOW'")
def rows_by_parameters(spark, folder):
    table(spark, folder, "orders").createOrReplaceTempView("ledger_orders")
    return query_rows(spark, "ledger_orders", {"o_orderstatus": "P", "o_orderpriority": "5-LOW"}, "o_orderkey")


@query("query_rows_limit", """
    select * from orders where o_orderstatus = 'P' order by o_orderkey limit 50""")
def first_rows_by_parameters(spark, folder):
    table(spark, folder, "orders").createOrReplaceTempView("ledger_orders")
    text = "select * from ledger_orders where o_orderstatus = :status"
    return query_rows(spark, text, {"status": "P"}, "o_orderkey", 50)


@query("filter_terms", f"""
    select row_id, hostname, service, pri_owner from {fx.CHAINED_SQL}
    where service in ('signup', 'error') and pri_owner in ('u1', 'u2', 'na') and list_has_any(owner_mgr_chain, [3, 17, 55])""")
def filter_terms(spark, folder):
    terms = {"service": ["signup", "error"], "pri_owner": ["u1", "u2", "na"], "owner_mgr_chain": [3, 17, 55], "unknown_field": ["x"]}
    return filters.filter_terms(fx.chained(spark, folder), terms, filters.FILTERABLE["compute"]).select(
        "row_id", "hostname", "service", "pri_owner")


@query("filter_owner_or_chain", f"""
    select row_id, owner_id from {fx.CHAINED_SQL}
    where list_has_any(owner_mgr_chain, [3, 17, 55]) or owner_id in (3, 17, 55)""")
def filter_owner_or_chain(spark, folder):
    return filters.filter_owner_or_chain(fx.chained(spark, folder), [3, 17, 55], "owner_id").select("row_id", "owner_id")


@query("exclude", f"""
    select row_id, pri_owner, virtual_host, service from {fx.COMPUTE_SQL}
    where pri_owner is distinct from 'na' and virtual_host is distinct from 1 and service not like '%ur%'""")
def exclude(spark, folder):
    return filters.exclude(fx.compute(spark, folder), {"pri_owner": "na", "virtual_host": 1}, {"service": "%ur%"}).select(
        "row_id", "pri_owner", "virtual_host", "service")


@query("filter_status_compute", f"select row_id, status_name from {fx.COMPUTE_SQL} where status_name = 'Retired'")
def filter_status_compute(spark, folder):
    return filters.filter_status(fx.compute(spark, folder), "compute", "Retired").select("row_id", "status_name")


@query("filter_status_storage", f"""
    select l_orderkey, l_linenumber, l_partkey, state from {fx.STORAGE_SQL} where state is distinct from 'offline'""")
def filter_status_storage(spark, folder):
    return filters.filter_status(fx.storage(spark, folder), "storage", "Production").select(
        "l_orderkey", "l_linenumber", "l_partkey", "state")


@query("project_fields", f"""
    select ts, owner as pri_owner, mount_point as hostname, state as status_name,
      cast(totalsize as double) as totalsize, cast(usedsize as double) as usedsize from {fx.STORAGE_SQL}""")
def project_fields(spark, folder):
    out = filters.project_fields(fx.storage(spark, folder), ["pri_owner", "hostname", "status_name"], "storage",
                                 stats=["totalsize", "usedsize"])
    return out.withColumns({c: F.col(c).cast("double") for c in ("totalsize", "usedsize")})


@query("filter_level", """
    select event_id, level from (select event_id, case event_type when 'error' then 'Error' when 'click' then 'debug'
      when 'view' then 'WARNNING' when 'purchase' then 'warning' else 'INFO' end as level from events)
    where upper(level) not in ('DEBUG')""")
def filter_level(spark, folder):
    leveled = fx.select(spark, folder, "events", [
        "event_id", "case event_type when 'error' then 'Error' when 'click' then 'debug' "
        "when 'view' then 'WARNNING' when 'purchase' then 'warning' else 'INFO' end as level"])
    return filters.filter_level(leveled, "level", "info")


@query("union_kinds", f"""
    select 'compute' as kind, row_id, pri_owner, service, null as line_no, null as mount_point from {fx.COMPUTE_SQL}
    union all select 'storage', null, null, service, line_no, mount_point from {fx.STORAGE_SQL}""")
def union_kinds(spark, folder):
    both = filters.union_kinds({"compute": fx.compute(spark, folder), "storage": fx.storage(spark, folder)})
    return both.select("kind", "row_id", "pri_owner", "service", "line_no", "mount_point")


@query("latest_per_key", f"""
    select hostname, ts, row_id, core_count, cast(ram as double) as ram from (select *,
      row_number() over (partition by hostname order by ts desc, row_id desc) as rn from {fx.COMPUTE_SQL}) where rn = 1""")
def latest_per_key(spark, folder):
    return rollups.latest_per_key(
        fx.compute(spark, folder), "hostname", ["ts", "row_id"], ["ts", "row_id", "core_count", "ram"]
    ).withColumn("ram", F.col("ram").cast("double"))


_compute = rollups.compute_unit_stats(("ts", "row_id"))


def _storage(df, dims):
    return rollups.storage_stats(df, dims, fx.STORAGE_ORDER, "clust_vol_mount")


@query("compute_stats", fx.compute_stats_sql(fx.COMPUTE_SQL, ["service", "status_name"]))
def compute_stats(spark, folder):
    return _compute(fx.compute(spark, folder), ["service", "status_name"])


@query("compute_stats_total", fx.compute_stats_sql(fx.COMPUTE_SQL, []))
def compute_stats_total(spark, folder):
    return _compute(fx.compute(spark, folder), [])


@query("storage_stats", fx.storage_stats_sql(fx.STORAGE_SQL, ["owner", "state"], "clust_vol_mount"))
def storage_stats(spark, folder):
    return _storage(fx.storage(spark, folder), ["owner", "state"])


@query("distinct_count", "select count(distinct o_custkey) as n_distinct from orders")
def distinct_exact(spark, folder):
    return rollups.distinct_count(table(spark, folder, "orders"), "o_custkey", exact=True)


@query("distinct_count_within_two_percent", """
    select true as within, count(distinct o_custkey) as n_distinct from orders""")
def distinct_approx(spark, folder):
    both = table(spark, folder, "orders").agg(
        rollups.distinct_values("o_custkey").alias("about"), rollups.distinct_values("o_custkey", exact=True).alias("n_distinct"))
    return both.select((F.abs(F.col("about") - F.col("n_distinct")) <= 0.02 * F.col("n_distinct")).alias("within"), "n_distinct")


NESTED_SQL = f"""
    with c as (select pri_owner, hostname, service, count(*) as n from {fx.COMPUTE_SQL}
        where pri_owner is not null and hostname is not null and service is not null group by all),
    a as (select pri_owner from (select pri_owner, row_number() over (order by sum(n) desc, pri_owner) as r
        from c group by 1) where r <= 5),
    b as (select pri_owner, hostname from (select pri_owner, hostname, row_number() over (
        partition by pri_owner order by sum(n) desc, hostname) as r from c join a using (pri_owner) group by 1, 2) where r <= 5),
    k as (select pri_owner, hostname, service, n from (select c.*, row_number() over (
        partition by c.pri_owner, c.hostname order by n desc, service) as r from c join b using (pri_owner, hostname)) where r <= 5)"""
DIMS = ["pri_owner", "hostname", "service"]


@query("nested_terms", NESTED_SQL + " select * from k")
def nested_terms(spark, folder):
    return rollups.nested_terms(fx.compute(spark, folder), DIMS, 5)


@query("nested_terms_frequent", """
    with c as (select l_returnflag, l_suppkey, l_partkey, count(*) as n from lineitem
        where l_returnflag is not null and l_suppkey is not null and l_partkey is not null group by all),
    a as (select l_returnflag from (select l_returnflag, row_number() over (order by sum(n) desc, l_returnflag) as r from c group by 1) where r <= 3),
    b as (select l_returnflag, l_suppkey from (select l_returnflag, l_suppkey, row_number() over (
        partition by l_returnflag order by sum(n) desc, l_suppkey) as r from c join a using (l_returnflag) group by 1, 2) where r <= 3)
    select l_returnflag, l_suppkey, l_partkey, n from (select c.*, row_number() over (
        partition by c.l_returnflag, c.l_suppkey order by n desc, l_partkey) as r from c join b using (l_returnflag, l_suppkey)) where r <= 3""")
def nested_terms_frequent(spark, folder):
    return rollups.nested_terms(table(spark, folder, "lineitem"), ["l_returnflag", "l_suppkey", "l_partkey"], 3, most_counts=0)


@query("nested_stats", NESTED_SQL + fx.compute_stats_sql(
    f"(select x.* from {fx.COMPUTE_SQL} x join k using (pri_owner, hostname, service))", ["pri_owner", "service"]))
def nested_stats(spark, folder):
    return rollups.nested_stats(fx.compute(spark, folder), DIMS, lambda df, dims: _compute(df, ["pri_owner", "service"]), 5)


@query("nest_buckets", f"""
    with t as (select service, hostname, count(*) as n from {fx.COMPUTE_SQL} group by all)
    select service, '{{' || string_agg('"' || hostname || '":{{"n":' || n || '}}', ',' order by cast(hostname as varchar)) || '}}'
      as buckets from t where hostname is not null group by 1""")
def nest_buckets(spark, folder):
    dims = ["service", "hostname"]
    return rollups.nest_buckets(rollups.nested_terms(fx.compute(spark, folder), dims), dims)


@query("direct_reports", f"""
    select distinct cast(e.n_nationkey as bigint) as exec_id, u.user_id from {fx.sql('customer', fx.PEOPLE)} u
    join nation e on u.manager = e.n_nationkey where u.status = 'Active'""")
def direct_reports(spark, folder):
    users = fx.select(spark, folder, "customer", fx.PEOPLE)
    execs = table(spark, folder, "nation").select(F.col("n_nationkey").cast("bigint").alias("exec_id"))
    return people.direct_reports(users, execs)


TARGETS_SQL = f"""
    e as (select cast(s_suppkey as bigint) as exec_id from supplier),
    u as (select user_id, manager as exec_id from {fx.sql('customer', fx.PEOPLE)} where status = 'Active'),
    t as (select e.exec_id, coalesce(u.user_id, e.exec_id) as person, u.user_id is not null as has_reports
        from e left join u using (exec_id)),
    m as (select x.*, t.exec_id, t.person from {fx.CHAINED_SQL} x join t
        on t.person = x.owner_id or (t.has_reports and list_contains(x.owner_mgr_chain, t.person)))"""


@query("exec_rollup", "with " + TARGETS_SQL + fx.compute_stats_sql("m", ["exec_id", "person"]))
def exec_rollup(spark, folder):
    users = fx.select(spark, folder, "customer", fx.PEOPLE)
    execs = table(spark, folder, "supplier").select(F.col("s_suppkey").alias("exec_id"))
    rows = fx.chained(spark, folder).drop("pri_owner").withColumnRenamed("owner_id", "pri_owner")
    return people.exec_rollup(rows, users, execs, _compute)


REQUEST = fleet.FleetRequest(
    start=datetime(2023, 12, 1), end=datetime(2024, 3, 1), status=("Production",), dims=("pri_owner", "service"),
    services={"compute": ("signup", "click", "purchase")}, bucket_size=4,
    order={"compute": ("ts", "row_id"), "storage": fx.STORAGE_ORDER},
    exclusions={"compute": fleet.Exclusion({"pri_owner": "na", "virtual_host": 1}, {"hostname": "%99"}),
                "storage": fleet.Exclusion({"owner": "na"})},
)
SELECTED_SQL = f"""(select * from {fx.COMPUTE_SQL} where ts >= timestamp '2023-12-01' and ts < timestamp '2024-03-01'
    and pri_owner is distinct from 'na' and virtual_host is distinct from 1 and status_name = 'Production'
    and cast(hostname as varchar) not like '%99' and service in ('signup', 'click', 'purchase'))"""


def _inventories(spark, folder):
    named = fx.compute(spark, folder).withColumn("hostname", F.col("hostname").cast("string"))
    return {"compute": named, "storage": fx.storage(spark, folder)}


@query("fleet_snapshot", f"""
    with c as (select pri_owner, service, count(*) as n from {SELECTED_SQL} where pri_owner is not null group by all),
    a as (select pri_owner from (select pri_owner, row_number() over (order by sum(n) desc, pri_owner) as r
        from c group by 1) where r <= 4),
    k as (select pri_owner, service from (select c.*, row_number() over (partition by pri_owner order by n desc, service) as r
        from c join a using (pri_owner)) where r <= 4)
    """ + fx.compute_stats_sql(f"(select x.* from {SELECTED_SQL} x join k using (pri_owner, service))", ["pri_owner", "service"]))
def fleet_snapshot(spark, folder):
    return fleet.snapshot(_inventories(spark, folder), REQUEST)["compute"]


@query("fleet_details", f"""
    select 'compute' as kind, ts, pri_owner, cast(hostname as varchar) as hostname, status_name, core_count,
      null as totalsize, null as usedsize from {fx.COMPUTE_SQL}
    where ts between timestamp '1990-01-01' and timestamp '2024-01-01' and pri_owner is distinct from 'na'
      and virtual_host is distinct from 1 and cast(hostname as varchar) not like '%99' and service in ('view', 'error')
    union all select 'storage', ts, owner, cast(mount_point as varchar), state, null, totalsize, usedsize from {fx.STORAGE_SQL}
    where service = 'storage'""")
def fleet_details(spark, folder):
    request = replace(REQUEST, start=datetime(1990, 1, 1), end=datetime(2024, 1, 1), closed="both", status=("Production", "Retired"),
                      services={"compute": ("view", "error"), "storage": ("storage",)})
    inventories = _inventories(spark, folder)
    inventories["storage"] = inventories["storage"].withColumn("mount_point", F.col("mount_point").cast("string"))
    found = fleet.details(inventories, request, ["pri_owner", "hostname", "status_name"])
    return found.select("kind", "ts", "pri_owner", "hostname", "status_name", "core_count", "totalsize", "usedsize")


DAILY_SQL = f"(select *, cast(ts as date) as trend_day from {SELECTED_SQL})"


@query("fleet_trend", f"""
    with c as (select trend_day, pri_owner, service, count(*) as n from {DAILY_SQL} where pri_owner is not null group by all),
    a as (select trend_day, pri_owner from (select trend_day, pri_owner, row_number() over (
        partition by trend_day order by sum(n) desc, pri_owner) as r from c group by 1, 2) where r <= 4),
    k as (select trend_day, pri_owner, service from (select c.*, row_number() over (
        partition by trend_day, pri_owner order by n desc, service) as r from c join a using (trend_day, pri_owner)) where r <= 4)
    """ + fx.compute_stats_sql(f"(select x.* from {DAILY_SQL} x join k using (trend_day, pri_owner, service))",
                               ["trend_day", "pri_owner", "service"]))
def fleet_trend(spark, folder):
    request = replace(REQUEST, zone="UTC")
    return fleet.fleet_trend(_inventories(spark, folder), request)["compute"]


@query("fleet_storage_snapshot", fx.storage_stats_sql(
    f"(select * from {fx.STORAGE_SQL} where state = 'offline' and service = 'archive')", ["owner"], "clust_vol_mount"))
def fleet_storage_snapshot(spark, folder):
    request = replace(REQUEST, start=datetime(1990, 1, 1), end=datetime(2010, 1, 1), status=("Retired",),
                      services={"storage": ("archive",)}, dims=("pri_owner",), bucket_size=None)
    return fleet.snapshot(_inventories(spark, folder), request)["storage"]


EXEC_SQL = f"""
    e as (select cast(s_suppkey as varchar) as exec_id from supplier),
    u as (select cast(user_id as varchar) as user_id, cast(manager as varchar) as exec_id
        from {fx.sql('customer', fx.PEOPLE)} where status = 'Active'),
    t as (select e.exec_id, coalesce(u.user_id, e.exec_id) as person, u.user_id is not null as has_reports
        from e left join u using (exec_id)),
    x as (select * replace (cast(hostname % 25 as varchar) as pri_owner) from {fx.COMPUTE_SQL}
        where virtual_host is distinct from 1 and cast(hostname as varchar) not like '%99'
        and service in ('signup', 'click', 'purchase') and ts >= timestamp '2023-12-01' and ts < timestamp '2024-03-01'),
    m as (select x.*, t.exec_id, t.person from x join t on t.person = x.pri_owner or (t.has_reports
        and (t.person = cast(x.hostname % 40 as varchar) or t.person = cast(x.hostname % 60 as varchar))))"""


def _exec_snapshot(spark, folder, **changes):
    people_rows = fx.select(spark, folder, "customer", fx.PEOPLE)
    users = people_rows.withColumns({c: F.col(c).cast("string") for c in ("user_id", "manager")})
    execs = table(spark, folder, "supplier").select(F.col("s_suppkey").cast("string").alias("exec_id"))
    hosts = fx.compute(spark, folder).withColumns({
        "pri_owner": F.expr("cast(hostname % 25 as string)"),
        "owner_mgr_chain": F.expr("array(cast(hostname % 40 as string), cast(hostname % 60 as string))"),
        "hostname": F.col("hostname").cast("string"),
    })
    request = replace(REQUEST, status=(), **changes)
    return fleet.exec_snapshot({"compute": hosts}, request, users, execs)["compute"]


@query("exec_snapshot", "with " + EXEC_SQL + fx.compute_stats_sql("m", ["exec_id", "person"]))
def exec_snapshot(spark, folder):
    return _exec_snapshot(spark, folder, dims=())


@query("exec_snapshot_by_service", "with " + EXEC_SQL + """,
    c as (select exec_id, person, pri_owner, service, count(*) as n from m group by all),
    a as (select exec_id, person, pri_owner from (select exec_id, person, pri_owner, row_number() over (
        partition by exec_id, person order by sum(n) desc, pri_owner) as r from c group by 1, 2, 3) where r <= 3),
    k as (select exec_id, person, pri_owner, service from (select c.*, row_number() over (
        partition by exec_id, person, pri_owner order by n desc, service) as r
        from c join a using (exec_id, person, pri_owner)) where r <= 3)
    """ + fx.compute_stats_sql("(select m.* from m join k using (exec_id, person, pri_owner, service))",
                               ["exec_id", "person", "pri_owner", "service"]))
def exec_snapshot_by_service(spark, folder):
    return _exec_snapshot(spark, folder, dims=("pri_owner", "service"), bucket_size=3)


@query("fleet_chain", f"""
    select ts, pri_owner, hostname from (select * exclude (pri_owner, hostname), cast(hostname % 25 as varchar) as pri_owner,
        cast(hostname as varchar) as hostname, hostname as h from {fx.COMPUTE_SQL})
    where ts >= timestamp '2023-12-01' and ts < timestamp '2024-03-01' and virtual_host is distinct from 1
      and hostname not like '%99' and status_name = 'Production' and service in ('signup', 'click', 'purchase')
      and (pri_owner in ('3', '17') or h % 40 in (3, 17) or h % 60 in (3, 17))""")
def fleet_chain(spark, folder):
    hosts = fx.compute(spark, folder).withColumns({
        "pri_owner": F.expr("cast(hostname % 25 as string)"),
        "owner_mgr_chain": F.expr("array(cast(hostname % 40 as string), cast(hostname % 60 as string))"),
        "hostname": F.col("hostname").cast("string"),
    })
    request = replace(REQUEST, terms={"owner_mgr_chain": ["3", "17"]}, owner_or_chain=True)
    return fleet.details({"compute": hosts}, request, ["pri_owner", "hostname"]).select("ts", "pri_owner", "hostname")


@query("window_distinct", """
    with e as (select cast(ts as date) as day, event_type as service, user_id from events),
    f as (select min(day) as first from e)
    select cast(first + cast((day - first) // 7 * 7 + 6 as integer) as date) as window_day, service, count(distinct user_id) as n_distinct, true as exact
    from e, f group by 1, 2""")
def window_distinct(spark, folder):
    """Distinct users per seven stored days and service, from each day's sketch and users."""
    path = scratch_path(spark, "days")
    events = table(spark, folder, "events").selectExpr("ts", "event_type as service", "user_id")
    sketches.store_days(events, path, "ts", "UTC", "user_id", ["service"])
    return sketches.window_distinct(spark, path, ["service"], days=7)
