"""Links, addresses, names, envelopes, tagged replies, log lines and spans."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import functions as F

from tidemark.catalog import fixtures as fx
from tidemark.catalog.registry import query
from tidemark.catalog.times import iso_sql
from tidemark.functions import texts
from tidemark.operators import links, logs
from tidemark.plans import weekly
from tidemark.session import table
from tidemark.sources.extract import flatten_envelope, worksheet_contract


@query("flatten_envelope", """
    select o_custkey, cast(o_orderkey as varchar) as sys_id, o_custkey as x from orders where o_orderkey % 5 > 2
    union all select o_custkey, 'b', o_orderkey from orders where o_orderkey % 5 > 2""")
def envelope_rows(spark, folder):
    return flatten_envelope(fx.select(spark, folder, "orders", fx.PAGES), "body", "sys_id:string,x:bigint", ("o_custkey",))


# Results of all shapes, one per page: an object with urls, an object with a prefix, a list of texts,
# a list of objects whose loose values repeat, and a bare number.
RESULTS = [
    "page_id",
    "case page_id % 5 when 0 then concat('{\"urls\":[\"', url, '\",\"\",\" \",7],\"prefix\":\"s3://b/p\"}') "
    "when 1 then concat(' {\"urls\":[],\"prefix\":\"s3://b/', cast(page_id as varchar(10)), '\"}') "
    "when 2 then concat('[\"', url, '\",\"\",\"', url, '\"]') "
    "when 3 then concat('[{\"prefix\":\"s3://b/x\"},5,{\"a\":\"', url, '\",\"b\":\"', url, '\",\"c\":\"s3://b/x\",\"d\":\"no\",\"e\":1}]') "
    "else '42' end as body",
]


@query("extract_links", """
    select page_id, 'url' as kind, url as value from pages where page_id % 5 in (0, 2, 3)
    union all select page_id, 'url', url from pages where page_id % 5 = 2
    union all select page_id, 'prefix', 's3://b/' || page_id from pages where page_id % 5 = 1
    union all select page_id, 'prefix', 's3://b/x' from pages where page_id % 5 = 3""")
def extract_links(spark, folder):
    return links.extract_links(fx.select(spark, folder, "pages", RESULTS), "page_id", "body")


@query("bad_results", "select page_id, '42' as body from pages where page_id % 5 = 4")
def bad_results(spark, folder):
    return links.bad_results(fx.select(spark, folder, "pages", RESULTS), "body")


@query("dedupe_links", "select distinct page_id % 10 as src_id, 'url' as kind, regexp_extract(url, '^https?://[^/]+') as value from pages")
def dedupe_links(spark, folder):
    found = table(spark, folder, "pages").selectExpr(
        "page_id % 10 as src_id", "'url' as kind", "regexp_extract(url, '^https?://[^/]+', 0) as value")
    return links.dedupe_links(found)


BASE_NAME = """coalesce(nullif(regexp_extract(regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1), '([^/]*)$', 1), ''),
    regexp_extract(url, '^[a-z]+://([^/?#]*)', 1))"""


@query("plan_destinations", f"""
    select page_id, url, dest_key, count(*) over (partition by dest_key) > 1 as duplicate
    from (select page_id, url, 'load/2025/week_10/' || {BASE_NAME} as dest_key from pages)""")
def plan_destinations(spark, folder):
    pages = table(spark, folder, "pages").select("page_id", "url")
    return links.plan_destinations(pages, "url", weekly.weekly_prefix("load", date(2025, 3, 5)))


@query("plan_destinations_odd", """
    select page_id, url, dest_key, count(*) over (partition by dest_key) > 1 as duplicate from (select page_id,
        'http://h.example/a b|' || page_id % 50 || '{x}?q=1' as url, 'w/a b|' || page_id % 50 || '{x}' as dest_key from pages)""")
def plan_destinations_odd(spark, folder):
    odd = "concat('http://h.example/a b|', cast(page_id % 50 as string), '{x}?q=1')"
    return links.plan_destinations(table(spark, folder, "pages").selectExpr("page_id", f"{odd} as url"), "url", "w")


@query("transfer_plan", f"""
    select page_id, kind, value, dest_key, count(*) over (partition by dest_key) > 1 as duplicate from (
      select page_id, 'url' as kind, url as value, 'load/2025/week_01/' || {BASE_NAME} as dest_key
      from pages where page_id % 5 in (0, 2, 3)
      union all select page_id, 'url', url, 'load/2025/week_01/' || {BASE_NAME} from pages where page_id % 5 = 2)
    union all select page_id, 'prefix', case page_id % 5 when 1 then 's3://b/' || page_id else 's3://b/x' end,
      'load/2025/week_01', false from pages where page_id % 5 in (1, 3)""")
def transfer_plan(spark, folder):
    return weekly.transfer_plan(fx.select(spark, folder, "pages", RESULTS), "page_id", "body", "load/", date(2024, 12, 30))


URIS = [
    "o_orderkey",
    "case o_orderkey % 5 when 0 then concat('s3://bucket/a/b/', cast(o_orderkey as varchar(20)), '.json') "
    "when 1 then concat('s3://b2/', cast(o_orderkey as varchar(20))) when 2 then 's3://only/deep/path/' "
    "when 3 then 's3://bucket' else 'http://x/y' end as uri",
]


@query("split_object_uri", f"""
    select o_orderkey, uri, o_orderkey % 5 < 3 as valid,
      case o_orderkey % 5 when 0 then 'bucket' when 1 then 'b2' when 2 then 'only' end as bucket,
      case o_orderkey % 5 when 0 then 'a/b' when 1 then '' when 2 then 'deep' end as prefix,
      case o_orderkey % 5 when 0 then o_orderkey || '.json' when 1 then cast(o_orderkey as varchar) when 2 then 'path' end as name
    from {fx.sql('orders', URIS)}""")
def split_object_uri(spark, folder):
    return links.split_object_uri(fx.select(spark, folder, "orders", URIS), "uri")


REPLIES = [
    "o_orderkey",
    "case o_orderkey % 4 when 0 then concat('noise BEGIN_JSON_RESULT {\"ok\":true,\"result\":{\"n\":', cast(o_custkey as varchar(20)), "
    "'}} END_JSON_RESULT tail') when 1 then 'BEGIN_JSON_RESULT {\"ok\":false} END_JSON_RESULT' "
    "when 2 then 'no marker' else 'BEGIN_JSON_RESULT {\"result\":{\"n\":1}} END_JSON_RESULT' end as reply",
]


@query("extract_tagged_json", """
    select o_orderkey, case when o_orderkey % 4 = 0 then o_custkey end as n,
      case o_orderkey % 4 when 1 then 'reported an error' when 2 then 'no result found' when 3 then 'reported an error' end as error
    from orders""")
def extract_tagged_json(spark, folder):
    replies = fx.select(spark, folder, "orders", REPLIES)
    return links.extract_tagged_json(replies, "reply", "struct<n:bigint>").select("o_orderkey", "result.n", "error")


HASHED = ["o_orderkey", "o_orderstatus", "case when o_orderkey % 3 = 0 then null else o_orderpriority end as p"]
PIECE = "coalesce(length({0}) || ':' || {0}, 'null')"


@query("row_fingerprint", f"""
    select o_orderkey, md5(concat_ws('|', {PIECE.format('o_orderstatus')}, {PIECE.format('p')})) as row_hash
    from {fx.sql('orders', HASHED)}""")
def row_fingerprint(spark, folder):
    rows = fx.select(spark, folder, "orders", HASHED)
    return links.row_fingerprint(rows, ["o_orderstatus", "p"]).select("o_orderkey", "row_hash")


@query("name_objects", """
    select o_orderkey, 'orders_' || epoch(o_orderdate)::bigint || printf('_part-%05d.json', o_orderkey % 500) as object_name,
      'orders_' || strftime(o_orderdate, '%Y-%m-%d_%H-%M-%S') || '_' || strftime(o_orderdate + interval 1 hour, '%Y-%m-%d_%H-%M-%S')
        || '_1700000000.json' as window_name from orders""")
def name_objects(spark, folder):
    orders = table(spark, folder, "orders").select(
        "o_orderkey", "o_orderdate", F.lit("orders").alias("idx"),
        F.unix_timestamp(F.col("o_orderdate").cast("timestamp")).alias("epoch"),
        (F.col("o_orderkey") % 500).cast("int").alias("part"))
    named = links.name_objects(orders, "idx", "epoch", "part")
    return named.select("o_orderkey", "object_name", texts.window_object_name(
        F.col("idx"), F.col("o_orderdate"), F.col("o_orderdate") + F.expr("interval 1 hour"), F.lit(1700000000)).alias("window_name"))


SHEET = [
    "cast(o_orderkey as varchar(20)) as ticket_id", "o_orderpriority as priority", "cast(o_custkey as varchar(20)) as owner",
    "case o_orderkey % 3 when 0 then '31/12/2025 10:00:00' when 1 then '2025-06-01T00:00:00Z' else 'bad' end as updated_at",
    "concat('http://x/', cast(o_orderkey as varchar(20))) as link", "o_totalprice as unused",
]
SHEET_HASH = ", ".join(PIECE.format(c) for c in ("ticket_id", "priority", "owner", "updated_at"))


@query("worksheet_contract", f"""
    select ticket_id, priority, owner, case updated_at when 'bad' then null when '2025-06-01T00:00:00Z'
      then timestamp '2025-06-01' else timestamp '2025-12-31 10:00:00' end as updated_at, link,
      md5(concat_ws('|', {SHEET_HASH})) as row_hash from {fx.sql('orders', SHEET)}""")
def worksheet(spark, folder):
    return worksheet_contract(fx.select(spark, folder, "orders", SHEET),
                              ["ticket_id", "priority", "owner", "updated_at", "link"], date_cols=("updated_at",))


LOGGED = [
    "event_id", "date_trunc('second', ts) as ts", "case event_type when 'error' then 'ERROR' else 'INFO' end as level",
    "concat('worker-', cast(user_id as varchar(10))) as thread", "'tide_test' as logger", "event_type as function",
    "concat('did | step: ', cast(event_id as varchar(20))) as message",
    "concat('{\"user_message\":\"m', cast(event_id as varchar(20)), '\",\"corr\":\"c|', cast(user_id as varchar(10)), '\"}') as ctx_json",
]


@query("format_log_lines", f"""
    select event_id, level || ' | [' || thread || '] | ' || logger || ' ' || function || ': ' || message || ' | UTC: '
      || {iso_sql('ts', 'UTC')} || ' | America/Los_Angeles: ' || {iso_sql('ts', 'America/Los_Angeles')}
      || ' | Asia/Kolkata: ' || {iso_sql('ts', 'Asia/Kolkata')} || ' | ctx=' || ctx_json as line
    from {fx.sql('events', LOGGED)}""")
def format_log_lines(spark, folder):
    return logs.format_log_lines(fx.select(spark, folder, "events", LOGGED), "ts", "ctx_json").select("event_id", "line")


def _lines(spark, folder):
    lines = logs.format_log_lines(fx.select(spark, folder, "events", LOGGED), "ts", "ctx_json")
    broken = F.when(F.col("event_id") % 50 == 0, F.concat(F.lit("torn "), F.col("line")))
    return lines.select(F.coalesce(broken, F.col("line")).alias("value"))


@query("parse_log_lines", f"""
    select level, thread, logger, function, message, ts as ts_utc, 'm' || event_id as user_message,
      'c|' || substr(thread, 8) as corr from {fx.sql('events', LOGGED)} where event_id % 50 <> 0""")
def parse_log_lines(spark, folder):
    return logs.parse_log_lines(_lines(spark, folder)).select(
        "level", "thread", "logger", "function", "message", "ts_utc",
        F.col("ctx")["user_message"].alias("user_message"), F.col("ctx")["corr"].alias("corr"))


@query("unparsed_lines", "select count(*) as n from events where event_id % 50 = 0")
def unparsed_lines(spark, folder):
    return logs.unparsed_lines(_lines(spark, folder)).agg(F.count(F.lit(1)).alias("n"))


CONTEXTS = [
    "event_id", "case when event_id % 3 = 0 then null else event_type end as um",
    "case event_id % 4 when 0 then null when 1 then 'plain text' when 2 then '{\"user_message\":\"other\",\"x\":\"1\",\"y\":{\"z\":2}}' "
    "else '{}' end as extra",
]


@query("flatten_context", f"""
    select event_id, um as user_message, case when event_id % 4 = 2 then '1' end as x,
      case when event_id % 4 = 2 then '{{"z":2}}' end as y, case when event_id % 4 = 1 then 'plain text' end as extra_data,
      cast((um is not null)::int + case event_id % 4 when 1 then 1 when 2 then 2 else 0 end as int) as keys
    from {fx.sql('events', CONTEXTS)}""")
def flatten_context(spark, folder):
    ctx = logs.flatten_context(F.col("um"), F.col("extra"))
    flat = fx.select(spark, folder, "events", CONTEXTS).select("event_id", ctx.alias("ctx"))
    return flat.select(
        "event_id", *[F.col("ctx")[k].alias(k) for k in ("user_message", "x", "y", "extra_data")], F.size("ctx").alias("keys"))


@query("spans", f"""
    select *, failed_at is not null as failed, ended_at is null and failed_at is null as unfinished,
      cast(date_diff('microsecond', started_at, greatest(ended_at, failed_at)) // 1000000 as bigint) as span_s
    from (select corr_id, min(case when mark = 'sub_start' then ts end) as started_at,
      max(case when mark = 'sub_end' then ts end) as ended_at, max(case when mark = 'sub_exception' then ts end) as failed_at,
      count(*) as marks from {fx.sql('events', fx.MARKS)} group by 1) where started_at is not null""")
def spans(spark, folder):
    return logs.spans(fx.select(spark, folder, "events", fx.MARKS), "corr_id", "ts", "mark")


@query("plan_copies", """
    select o_orderkey, src_key, case when o_orderkey % 7 = 0 then 'load/2025/week_10'
      else 'load/2025/week_10/' || o_orderpriority || '/' || o_orderkey end as dest_key
    from (select *, case when o_orderkey % 7 = 0 then 'exports/run' else 'exports/run/' || o_orderpriority || '/' || o_orderkey end as src_key
      from orders)""")
def plan_copies(spark, folder):
    objects = table(spark, folder, "orders").select(
        "o_orderkey", F.lit("exports/run").alias("pre"), F.when(F.col("o_orderkey") % 7 == 0, F.lit("exports/run")).otherwise(
            F.concat(F.lit("exports/run/"), "o_orderpriority", F.lit("/"), F.col("o_orderkey").cast("string"))).alias("src_key"))
    return links.plan_copies(objects, "pre", "src_key", "load/2025/week_10").drop("pre")
