"""Writers read back, part numbers, sizes, sources, record functions and streams."""

from __future__ import annotations

import json
from datetime import datetime

from pyarrow.fs import FileSelector
from pyspark.sql import functions as F

from tidemark.catalog.registry import query
from tidemark.operators import parts, records, rollups
from tidemark.plans import ingest
from tidemark.session import scratch_path, table
from tidemark.sinks import capped, export
from tidemark.sources import extract
from tidemark.sources.paged import paged_source
from tidemark.streaming import buckets, slices

ORDER_SCHEMA = "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string"
ALL_ORDERS = "select * from orders"


@query("write_ndjson", "select *, cast(null as varchar) as note from orders")
def ndjson_round_trip(spark, folder):
    path = scratch_path(spark, "ndjson")
    export.write_ndjson(table(spark, folder, "orders").withColumn("note", F.lit(None).cast("string")), path)
    return spark.read.schema(f"{ORDER_SCHEMA}, note string").json(path)


@query("write_parquet_capped", ALL_ORDERS)
def parquet_round_trip(spark, folder):
    path = scratch_path(spark, "parquet")
    export.write_parquet_capped(table(spark, folder, "orders"), path, max_bytes=200_000)
    return spark.read.parquet(path)


@query("parquet_part_sizes", "select true as capped, count(*) as rows, cast(sum(strlen(text)) as bigint) as bytes from documents")
def parquet_part_sizes(spark, folder):
    """Texts of a few and of many thousand bytes, each task's in the order of their sizes, under a cap of 300,000."""
    path = scratch_path(spark, "sizes")
    texts = table(spark, folder, "documents").select("doc_id", "text").sortWithinPartitions(F.length("text"))
    export.write_parquet_capped(texts, path, max_bytes=300_000)
    rows = spark.read.parquet(path).select((F.col("_metadata.file_size") <= 300_000).alias("capped"), F.octet_length("text").alias("b"))
    return rows.groupBy("capped").agg(F.count(F.lit(1)).alias("rows"), F.sum("b").alias("bytes"))


@query("write_csv_gz_parts", ALL_ORDERS)
def csv_gz_round_trip(spark, folder):
    path = scratch_path(spark, "csv")
    export.write_csv_gz_parts(table(spark, folder, "orders"), path, rows=2500)
    return extract.read_header_csv(spark, path, ORDER_SCHEMA)


@query("split_csv", ALL_ORDERS)
def split_csv(spark, folder):
    """CSV files cut line by line into gzip parts, read back."""
    whole, path = scratch_path(spark, "whole"), scratch_path(spark, "split")
    table(spark, folder, "orders").write.option("header", True).csv(whole)
    export.split_csv(spark, whole, path, rows=4_000, max_bytes=100_000)
    return extract.read_header_csv(spark, path, ORDER_SCHEMA)


@query("write_details_csv", """
    select o_orderkey, o_orderpriority || ', "x"' as label, o_totalprice from orders""")
def details_round_trip(spark, folder):
    path = scratch_path(spark, "details")
    rows = table(spark, folder, "orders").select(
        "o_orderkey", F.concat("o_orderpriority", F.lit(', "x"')).alias("label"), "o_totalprice")
    export.write_details_csv(rows, path)
    return extract.read_header_csv(spark, path, "o_orderkey bigint, label string, o_totalprice double")


@query("write_week_once", """
    select cast(isoyear(o_orderdate) as int) as iso_year, cast(weekofyear(o_orderdate) as int) as iso_week, count(*) as rows,
      1 as runs from orders where o_orderkey % 50 <> 7 group by 1, 2""")
def weeks_once(spark, folder):
    """Half the rows first, then all twice: each week is written by the first run that sees it; some rows have no day."""
    path, undated = (scratch_path(spark, n) for n in ("weeks", "weeks-undated"))
    orders = table(spark, folder, "orders").withColumn("o_orderdate", F.when(F.col("o_orderkey") % 50 != 7, F.col("o_orderdate")))
    early = orders.filter("o_orderdate < timestamp_ntz'1998-01-05'")  # a Monday, so no week is cut
    for run in (early, orders, orders):
        export.write_week_once(run, path, "o_orderdate", undated)
    runs = export.finished_weeks(spark, path).groupBy("iso_year", "iso_week").agg(F.count(F.lit(1)).cast("int").alias("runs"))
    rows = export.read_weeks(spark, path, ORDER_SCHEMA).groupBy("iso_year", "iso_week").agg(F.count(F.lit(1)).alias("rows"))
    return rows.join(runs, ["iso_year", "iso_week"])


@query("write_buckets", """
    select strftime(time_bucket(interval '60 minutes', ts), '%Y-%m-%d_%H-%M') as bucket, count(*) as n from events group by 1""")
def buckets_round_trip(spark, folder):
    path = scratch_path(spark, "buckets")
    export.write_buckets(table(spark, folder, "events"), path, "ts", 60)
    return spark.read.json(path, schema="event_id bigint, bucket string").groupBy("bucket").agg(F.count("event_id").alias("n"))


@query("manifest_totals", "select count(*) as rows, true as sized, true as several from orders")
def manifest_totals(spark, folder):
    path = scratch_path(spark, "manifest")
    export.write_csv_gz_parts(table(spark, folder, "orders"), path, rows=1000)
    files = export.manifest(extract.read_header_csv(spark, path, ORDER_SCHEMA))
    return files.agg(F.sum("rows").alias("rows"), (F.min("bytes") > 0).alias("sized"), (F.count(F.lit(1)) > 1).alias("several"))


@query("part_sizes", "select source, count(*) as lines, cast(sum(strlen(text)) as bigint) as raw_bytes from documents group by 1")
def part_sizes(spark, folder):
    return rollups.part_sizes(table(spark, folder, "documents"), "source", F.col("text"))


@query("rows_per_part", """
    select *, cast(least(greatest(rows_per_part, 100), 200000) as bigint) as read_rows from (
      select count(*) as measured, greatest(avg(strlen(text)), 1.0) as bytes_per_row,
        cast(greatest(floor(262144000.0::double / greatest(avg(strlen(text)), 1.0)), 1) as bigint) as rows_per_part
      from documents)""")
def rows_per_part(spark, folder):
    return rollups.rows_per_part(table(spark, folder, "documents"), text=F.col("text"))


def _documents(spark, folder):
    return table(spark, folder, "documents").select("source", "doc_id", F.octet_length("text").cast("bigint").alias("bytes"))


PART_CAP = 40_000


@query("assign_parts", f"""
    with recursive d as (select source, doc_id, cast(strlen(text) as bigint) as bytes,
        row_number() over (partition by source order by doc_id) as pos from documents),
    walk as (select source, doc_id, bytes, pos, cast(1 as bigint) as part, bytes as held from d where pos = 1
      union all select d.source, d.doc_id, d.bytes, d.pos,
        case when w.held > 0 and w.held + d.bytes > {PART_CAP} then w.part + 1 else w.part end,
        case when w.held > 0 and w.held + d.bytes > {PART_CAP} then d.bytes else w.held + d.bytes end
      from walk w join d on d.source = w.source and d.pos = w.pos + 1)
    select source, doc_id, bytes, part from walk""")
def assign_parts(spark, folder):
    return parts.assign_parts(_documents(spark, folder), "source", ["doc_id"], "bytes", PART_CAP)


FILE_CAP = 100_000


@query("part_files", f"""
    with recursive d as (select source, doc_id, octet_length(encode(to_json({{'source': source, 'doc_id': doc_id, 'text': text}}))) + 1 as bytes,
        row_number() over (partition by source order by doc_id) as pos from documents),
    walk as (select source, doc_id, bytes, pos, cast(1 as bigint) as part, bytes as held from d where pos = 1
      union all select d.source, d.doc_id, d.bytes, d.pos,
        case when w.held > 0 and w.held + d.bytes > {FILE_CAP} then w.part + 1 else w.part end,
        case when w.held > 0 and w.held + d.bytes > {FILE_CAP} then d.bytes else w.held + d.bytes end
      from walk w join d on d.source = w.source and d.pos = w.pos + 1)
    select source, part, count(*) as n, cast(sum(bytes) as bigint) as bytes, md5(string_agg(doc_id, ',' order by doc_id)) as docs
    from walk group by 1, 2""")
def part_files(spark, folder):
    """Whole documents as JSON lines in parts, read back."""
    path = scratch_path(spark, "parts")
    lines = ingest.record_lines(table(spark, folder, "documents").select("source", "doc_id", "text"), "source", ("doc_id",))
    export.write_line_parts(parts.assign_parts(lines, "source", ["doc_id"], "bytes", FILE_CAP), path, "source")
    back = spark.read.schema("value string, source string, part bigint").text(path)
    doc = F.get_json_object("value", "$.doc_id").cast("bigint")
    return back.groupBy("source", "part").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("value") + 1).cast("bigint").alias("bytes"),
        F.md5(F.array_join(F.array_sort(F.collect_list(doc)), ",").cast("binary")).alias("docs"))


@query("manifest_files", f"""
    with recursive d as (select source, doc_id, octet_length(encode(to_json({{'source': source, 'doc_id': doc_id, 'text': text}}))) + 1 as bytes,
        row_number() over (partition by source order by doc_id) as pos from documents),
    walk as (select source, doc_id, bytes, pos, cast(1 as bigint) as part, bytes as held from d where pos = 1
      union all select d.source, d.doc_id, d.bytes, d.pos,
        case when w.held > 0 and w.held + d.bytes > {FILE_CAP} then w.part + 1 else w.part end,
        case when w.held > 0 and w.held + d.bytes > {FILE_CAP} then d.bytes else w.held + d.bytes end
      from walk w join d on d.source = w.source and d.pos = w.pos + 1)
    select source || '/' || part as key, count(*) as rows, cast(sum(bytes) as bigint) as bytes, cast(sum(bytes) as bigint) as file_bytes,
      true as there, true as timed from walk group by source, part""")
def manifest_files(spark, folder):
    """One row per file of a run: its key, rows and bytes, whether the file is there, and whether its times are in order."""
    path = scratch_path(spark, "keyed")
    lines = ingest.record_lines(table(spark, folder, "documents").select("source", "doc_id", "text"), "source", ("doc_id",))
    export.write_keyed_lines(parts.assign_parts(lines, "source", ["doc_id"], "bytes", FILE_CAP), path, "source", order=("doc_id",))
    files = capped.written_files(spark, path)
    found = export.manifest(spark.read.text(path)).select(F.regexp_extract("file_path", "[^/]+$", 0).alias("name"), F.col("rows").alias("lines"))
    named = files.withColumn("name", F.regexp_extract("file_path", "[^/]+$", 0)).join(found, "name", "left")
    return named.select("key", "rows", "bytes", "file_bytes", F.col("lines").eqNullSafe(F.col("rows")).alias("there"),
                        ((F.col("started_at") <= F.col("finished_at")) & (F.col("finished_at") <= F.current_timestamp())).alias("timed"))


@query("record_lines", """
    select o_orderkey as record_id, '{"record_id":' || o_orderkey || ',"o_orderstatus":"' || o_orderstatus || '","note":null}' as line,
      cast(length('{"record_id":' || o_orderkey || ',"o_orderstatus":"' || o_orderstatus || '","note":null}') + 1 as bigint) as bytes
    from orders where o_orderstatus = 'O'""")
def record_lines(spark, folder):
    orders = table(spark, folder, "orders").withColumnRenamed("o_orderkey", "record_id")
    picked = orders.filter("o_orderstatus = 'O'")
    rows = orders.select("record_id", "o_orderstatus", F.lit(None).cast("string").alias("note"))
    return ingest.record_lines(ingest.extract_records(rows, picked))


@query("read_lines_utf8", """
    select o_orderkey || ' ' || o_orderpriority as value from orders where o_orderkey % 9 <> 4""")
def lines_utf8(spark, folder):
    """Lines of which every ninth is cut inside a two-byte letter, written as raw bytes."""
    path = scratch_path(spark, "lines")
    text = F.concat_ws(" ", F.col("o_orderkey").cast("string"), "o_orderpriority")
    torn = F.concat(F.encode(text, "UTF-8"), F.unhex(F.lit("C3")))
    raw = F.when(F.col("o_orderkey") % 9 == 4, torn).otherwise(F.encode(text, "UTF-8"))
    table(spark, folder, "orders").select(raw.cast("string").alias("value")).write.text(path)
    return extract.read_lines_utf8(spark, path)


PAGE_KEYS = 20_000


def _page_folder(spark, folder, calls=None):
    """Orders as a remote table of pages: JSON lines in a folder per ``PAGE_KEYS`` keys, and a source that asks for them.

    With ``calls``, every request leaves a file there.
    """
    pages = scratch_path(spark, "pages")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    named = orders.withColumn("page", F.expr(f"o_orderkey div {PAGE_KEYS}"))
    named.hint("rebalance", F.col("page")).write.partitionBy("page").json(pages)
    first, last = orders.agg(F.min("o_orderkey"), F.max("o_orderkey")).first()
    quantiles = orders.select(F.percentile_approx("o_orderkey", [i / 32 for i in range(1, 32)], 1000)).first()[0]

    def bounds():
        return first, last + 1

    def cuts(low, high, n):
        inside = [q for q in quantiles if low < q < high]
        return inside[::-(-len(inside) // max(1, n - 1))] if inside else []

    def fetch(low, high):
        store, place = capped.store_of(pages)
        if calls:
            there, mark = capped.store_of(calls)
            there.create_dir(mark, recursive=True)
            with there.open_output_stream(f"{mark}/{low}-{high}") as out:
                out.write(b"")
        for number in range(low // PAGE_KEYS, (high - 1) // PAGE_KEYS + 1):
            listed = FileSelector(f"{place}/page={number}", allow_not_found=True)
            for info in store.get_file_info(listed):
                if info.base_name.startswith("part-"):
                    with store.open_input_stream(info.path, compression=None) as lines:
                        for line in lines.read().splitlines():
                            row = json.loads(line)
                            if low <= row["o_orderkey"] < high:
                                yield row["o_orderkey"], row["o_custkey"], row["o_totalprice"]

    spark.conf.set("spark.sql.python.filterPushdown.enabled", True)
    spark.dataSource.register(paged_source(
        bounds, fetch, "o_orderkey bigint, o_custkey bigint, o_totalprice double", "paged_orders", "o_orderkey", cuts))
    return spark.read.format("paged_orders").option("pagesize", PAGE_KEYS // 4).option("pagespertask", 2).load()


@query("paged_source", "select o_orderkey, o_custkey, o_totalprice from orders")
def paged_orders(spark, folder):
    return _page_folder(spark, folder)


WINDOW = "o_orderkey >= 3000 and o_orderkey < 9000 and o_custkey % 3 = 0"


@query("paged_window", f"select o_orderkey, o_custkey, o_totalprice from orders where {WINDOW}")
def paged_window(spark, folder):
    """Only pages that the key's window reaches are asked for; the rest of the filter is Spark's."""
    return _page_folder(spark, folder).filter(WINDOW)


@query("map_records", """
    select case when o_orderkey % 10 <> 3 then o_orderkey end as k, case when o_orderkey % 10 <> 3 then o_custkey * 2 end as twice,
      o_orderkey % 10 <> 3 as ok, case when o_orderkey % 10 = 3 then 'ValueError: three' end as error from orders""")
def map_records(spark, folder):
    def double(record):
        if record["o_orderkey"] % 10 == 3:
            raise ValueError("three")
        return {"k": record["o_orderkey"], "twice": record["o_custkey"] * 2}

    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    return records.map_records(orders, double, "k bigint, twice bigint", "collect")


@query("stream_buckets", """
    with w as (select time_bucket(interval '5 minutes', ts) as bucket_start, count(*) as n from events group by 1)
    select bucket_start, n from w
    where bucket_start + interval '5 minutes' <= (select max(ts) - interval '10 minutes' from events)""")
def stream_buckets(spark, folder):
    """All slices the final watermark has passed; the ones still open are not written yet."""
    path, checkpoint = scratch_path(spark, "stream"), scratch_path(spark, "stream-checkpoint")
    source = table(spark, folder, "events")
    stream = spark.readStream.schema(source.schema).option("pathGlobFilter", "events.parquet").parquet(folder)
    buckets.drain(buckets.stream_buckets(stream, "ts"), path, checkpoint)
    return spark.read.schema("bucket_start timestamp_ntz, n bigint").parquet(path)


@query("finished_slices", "select time_bucket(interval '5 minutes', ts) as bucket_start, count(*) as n, false as late from events group by 1")
def finished_slices(spark, folder):
    """All slices of a stream that ends: the end mark flushes those that the watermark has not passed."""
    source, path, checkpoint = (scratch_path(spark, n) for n in ("ended", "slices", "slices-checkpoint"))
    events = table(spark, folder, "events").select("event_id", "ts")
    mark = spark.range(1).select(F.lit(-1).cast("bigint").alias("event_id"), F.lit(slices.END).cast(events.schema["ts"].dataType).alias("ts"))
    events.unionByName(mark).write.parquet(source)
    slices.use_timers(spark)
    stream = spark.readStream.schema(events.schema).parquet(source)
    slices.drain_to_end(slices.finished_slices(stream, "ts"), path, checkpoint)
    out = spark.read.schema(slices.OUT).parquet(path)
    return out.withColumn("bucket_start", F.col("bucket_start").cast("timestamp_ntz"))
