"""Stand-ins for the inputs the operators expect, as column texts that Spark and DuckDB both read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import table


def _cents(value: str) -> str:
    """Measures with two decimals as whole hundredths: their sums are exact in any order."""
    return f"cast(floor({value} * 100 + 0.5) as bigint)"


COMPUTE = [
    "event_id as row_id", "ts", "user_id as hostname", "event_type as service",
    "case when user_id % 10 = 0 then 'na' when user_id % 10 = 1 then null "
    "else concat('u', cast(user_id % 7 as varchar(10))) end as pri_owner",
    "case when user_id % 5 = 0 then 'Retired' else 'Production' end as status_name",
    "case when user_id % 17 = 0 then 1 when user_id % 3 = 0 then null else 0 end as virtual_host",
    "case when user_id % 11 = 0 then null else cast(user_id % 16 as int) end as core_count",
    f"case when user_id % 13 = 0 then null else {_cents('value')} end as ram",
    f"{_cents('value')} as total_runrate", f"{_cents('value * 2')} as core_hours",
    f"{_cents('value * 3')} as ram_hours", f"{_cents('value')} as cpu_30d",
]
STORAGE = [
    "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate as ts", "l_suppkey as mount_point",
    "l_partkey as clust_vol_mount", "l_returnflag as owner",
    "case when l_partkey % 9 = 0 then 'archive' else 'storage' end as service",
    "case when l_linestatus = 'F' then 'offline' when l_orderkey % 7 = 0 then null else 'online' end as state",
    f"{_cents('l_extendedprice')} as totalsize", f"{_cents('l_quantity')} as usedsize",
    f"{_cents('l_discount')} as used_pct", f"{_cents('l_tax')} as runrate",
    f"{_cents('l_quantity')} as disk_hours",
    # Ship dates are midnights; the line's keys as one number tell the rows of a day apart.
    "((l_orderkey * 8 + l_linenumber) * 200000 + l_partkey) * 10000 + l_suppkey as line_no",
]
LEDGER = [
    "o_orderkey as record_id",
    "case o_orderstatus when 'O' then 'pending' when 'P' then 'in_progress' else 'completed' end as status",
    "o_orderdate as window_start", "o_orderdate + interval '1' day as window_end",
    "o_orderdate + interval '1' day * cast(o_orderkey % 200 as int) as started_at",
    "o_orderkey % 4 <> 0 as audit_enabled",
    "case when o_orderkey % 3 = 0 then 'done' else 'open' end as stage_export",
    "case when o_orderkey % 6 = 0 then 'done' else 'open' end as stage_transfer",
    "case when o_orderkey % 12 = 0 then 'done' else 'open' end as stage_audit",
]
PEOPLE = [
    "c_custkey as user_id", "cast(c_nationkey as bigint) as manager",
    "case when c_mktsegment = 'BUILDING' then 'Inactive' else 'Active' end as status",
]
RUNS = ["o_orderkey as run_id", "cast(o_orderkey % 2000 as bigint) as run_s"]
JOBS = [
    "l_suppkey as grp", "l_orderkey", "l_linenumber", "l_partkey", "l_shipdate", "l_extendedprice",
    "l_quantity as dur",
]
JOB_ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_shipdate", "l_extendedprice"]
MARKS = [
    "user_id as corr_id", "ts", "event_id",
    "case event_type when 'signup' then 'sub_start' when 'purchase' then 'sub_end' "
    "when 'error' then 'sub_exception' else 'other' end as mark",
]
PAGES = [
    "o_custkey",
    "case o_orderkey % 5 when 0 then '{\"result\":[]}' when 1 then '{\"result\":null}' when 2 then '{}' "
    "else concat('{\"result\":[{\"sys_id\":\"', cast(o_orderkey as varchar(20)), '\",\"x\":', "
    "cast(o_custkey as varchar(20)), '},{\"sys_id\":\"b\",\"x\":', cast(o_orderkey as varchar(20)), '}]}') end as body",
]
STORAGE_ORDER = ("ts", "line_no")


def select(spark: SparkSession, folder: str, name: str, columns: list[str]) -> DataFrame:
    return table(spark, folder, name).selectExpr(*columns)


def sql(name: str, columns: list[str]) -> str:
    return f"(select {', '.join(columns)} from {name})"


def compute(spark: SparkSession, folder: str) -> DataFrame:
    return select(spark, folder, "events", COMPUTE)


def storage(spark: SparkSession, folder: str) -> DataFrame:
    return select(spark, folder, "lineitem", STORAGE)


def chained(spark: SparkSession, folder: str) -> DataFrame:
    """Compute rows whose managers are two customers found from the host."""
    return compute(spark, folder).withColumns({
        "owner_id": F.expr("hostname % 25"),
        "owner_mgr_chain": F.expr("array(hostname % 40, hostname % 60)"),
    })


CHAINED_SQL = f"(select *, hostname % 25 as owner_id, [hostname % 40, hostname % 60] as owner_mgr_chain from {sql('events', COMPUTE)})"
COMPUTE_SQL = sql("events", COMPUTE)
STORAGE_SQL = sql("lineitem", STORAGE)
LEDGER_SQL = sql("orders", LEDGER)


def compute_stats_sql(relation: str, dims: list[str], host: str = "hostname") -> str:
    """The statistics by another route: ranked rows and a distinct count."""
    by = ", ".join([*dims, host])
    group = f" group by {', '.join(dims)}" if dims else ""
    head = "".join(f"{d}, " for d in dims)
    return f"""
    select {head}count(distinct {host}) as "count",
      coalesce(cast(sum(total_runrate) as double), 0) as run_rate,
      coalesce(cast(sum(core_hours) as double), 0) as core_hours,
      coalesce(cast(sum(ram_hours) as double), 0) as ram_hours,
      cast(sum(cpu_30d) as double) / nullif(count(cpu_30d), 0) * 100 as efficiency,
      coalesce(cast(sum(case when rn = 1 then core_count end) as double), 0) as core_count,
      coalesce(cast(sum(case when rn = 1 then ram end) as double), 0) as ram
    from (select *, row_number() over (partition by {by} order by ts desc, row_id desc) as rn from {relation})
    {group}"""


def storage_stats_sql(relation: str, dims: list[str], disk: str) -> str:
    by = ", ".join([*dims, disk])
    group = f" group by {', '.join(dims)}" if dims else ""
    head = "".join(f"{d}, " for d in dims)
    order = ", ".join(f"{c} desc" for c in STORAGE_ORDER)
    return f"""
    select *, case when total_size <> 0 then used_size / total_size * 100 else 0 end as disk_efficiency from (
    select {head}count(distinct {disk}) as disk_count,
      coalesce(cast(sum(runrate) as double), 0) as run_rate,
      coalesce(cast(sum(disk_hours) as double), 0) as disk_hours,
      cast(sum(used_pct) as double) / nullif(count(used_pct), 0) as efficiency,
      coalesce(cast(sum(case when rn = 1 then totalsize end) as double), 0) as total_size,
      coalesce(cast(sum(case when rn = 1 then usedsize end) as double), 0) as used_size
    from (select *, row_number() over (partition by {by} order by {order}) as rn from {relation})
    {group})"""
