"""What writers leave behind, also when they fail; sources and streams on small files."""

import gzip
import json
import os
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tidemark.operators import parts, windows
from tidemark.session import scratch_path
from tidemark.sinks import capped, export, publish
from tidemark.sources import extract
from tidemark.sources.paged import paged_source
from tidemark.streaming import buckets, slices


def files(path, suffix):
    return sorted(p for p in Path(path).rglob(f"*{suffix}") if not p.name.startswith((".", "_")))


def test_ndjson_is_compact_and_keeps_nulls(spark, tmp_path):
    path = str(tmp_path / "out")
    export.write_ndjson(spark.createDataFrame([(1, None, "é")], "a int, b string, c string").coalesce(1), path)
    assert files(path, ".json")[0].read_text(encoding="utf-8") == '{"a":1,"b":null,"c":"é"}\n'


def test_csv_parts_have_one_header_each(spark, tmp_path):
    path = str(tmp_path / "out")
    export.write_csv_gz_parts(spark.range(1000).coalesce(1).withColumn("t", F.lit('q", x')), path, rows=300)
    found = files(path, ".csv.gz")
    lines = [gzip.open(p, "rt").read().splitlines() for p in found]
    assert sorted(len(x) for x in lines) == [101, 301, 301, 301]
    assert all(x[0] == "id,t" and "id,t" not in x[1:] for x in lines)
    assert extract.read_header_csv(spark, path).filter("t = 'q\", x'").count() == 1000


def test_parquet_parts_are_capped(spark, tmp_path):
    path = str(tmp_path / "out")
    export.write_parquet_capped(spark.range(20_000).coalesce(1).withColumn("t", F.uuid()), path, max_bytes=200_000)
    sizes = [p.stat().st_size for p in files(path, ".parquet")]
    assert len(sizes) > 3 and max(sizes) <= 200_000
    assert spark.read.parquet(path).count() == 20_000


def test_caps_hold_for_unequal_rows(spark, tmp_path):
    rows = spark.range(0, 4000, 1, 1).selectExpr("id", "case when id < 1000 then 'x' else repeat(uuid(), 20) end as t")
    for name, suffix, write in (("parquet", ".parquet", export.write_parquet_capped), ("csv", ".csv.gz", export.write_csv_gz_parts)):
        path = str(tmp_path / name)
        write(rows, path, max_bytes=100_000)
        found = files(path, suffix)
        sizes = [len(gzip.open(p).read()) if suffix == ".csv.gz" else p.stat().st_size for p in found]
        assert len(sizes) > 10 and max(sizes) <= 100_000
    assert spark.read.parquet(str(tmp_path / "parquet")).select("id").distinct().count() == 4000


def test_undated_rows_are_refused_or_set_aside(spark, tmp_path):
    path, aside = str(tmp_path / "data"), str(tmp_path / "aside")
    rows = spark.createDataFrame([(1, datetime(2025, 1, 6)), (2, None)], WEEK_ROWS)
    with pytest.raises(Exception, match="without a day"):
        export.write_week_once(rows, path, "day")
    for n in (1, 2):
        assert export.write_week_once(rows, path, "day", aside).count() == (n == 1)
        assert ids(spark, path) == [1]
        assert [r.id for r in spark.read.option("recursiveFileLookup", "true").parquet(aside).collect()] == [2] * n


def test_failed_write_leaves_no_files(spark, tmp_path):
    rows = spark.range(0, 10_000, 1, 8)
    bad = rows.withColumn("x", F.when(F.col("id") == 9_999, F.raise_error(F.lit("broken row"))).otherwise(F.col("id").cast("string")))
    for name, write in {
        "json": lambda p: export.write_ndjson(bad, p),
        "csv": lambda p: export.write_csv_gz_parts(bad, p, 100),
        "buckets": lambda p: export.write_buckets(bad.withColumn("ts", F.lit(datetime(2025, 1, 1)).cast("timestamp_ntz")), p, "ts"),
    }.items():
        path = str(tmp_path / name)
        with pytest.raises(Exception, match="broken row"):
            write(path)
        assert [p for p in Path(path).rglob("part-*")] == []


WEEK_ROWS = "id int, day timestamp_ntz"


def ids(spark, path):
    return sorted(r.id for r in export.read_weeks(spark, path, WEEK_ROWS).collect())


def test_week_survives_failure_and_is_written_once(spark, tmp_path):
    path = str(tmp_path / "data")
    rows = spark.createDataFrame([(1, datetime(2025, 1, 6)), (2, datetime(2025, 1, 7)), (3, datetime(2025, 1, 13))], WEEK_ROWS)
    first = rows.filter("id < 3")
    broken = first.withColumn("id", F.when(F.col("id") == 2, F.raise_error(F.lit("lost")).cast("int")).otherwise(F.col("id")))
    with pytest.raises(Exception, match="lost"):
        export.write_week_once(broken, path, "day")
    assert export.finished_weeks(spark, path).count() == 0
    assert [tuple(r)[:3] for r in export.write_week_once(first, path, "day").collect()] == [(2025, 2, 2)]
    kept = files(path, ".parquet")
    assert [tuple(r)[:3] for r in export.write_week_once(rows, path, "day").collect()] == [(2025, 3, 1)]
    assert set(kept) <= set(files(path, ".parquet"))
    assert export.write_week_once(rows, path, "day").count() == 0
    assert ids(spark, path) == [1, 2, 3]
    assert export.finished_weeks(spark, path).count() == 2


def test_a_reader_sees_all_weeks_or_none_wherever_the_run_dies(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "data")
    old = spark.createDataFrame([(1, datetime(2025, 1, 6))], WEEK_ROWS)
    new = spark.createDataFrame([(1, datetime(2025, 1, 6)), (2, datetime(2025, 1, 13)), (3, datetime(2025, 1, 20))], WEEK_ROWS)
    export.write_week_once(old, path, "day")

    class Killed(BaseException):
        """Not an Exception: like a lost driver it runs no clean-up of ours."""

    def dies(name, after):
        plain = getattr(publish, name) if name != "link" else os.link

        def step(*args, **options):
            out = plain(*args, **options) if after else None
            assert ids(spark, path) == ([1, 2, 3] if (name, after) == ("link", True) else [1])
            raise Killed

        return step

    steps = [("new_run", False), ("write_run", False), ("write_run", True), ("publish", False), ("create_once", False), ("link", False)]
    for name, after in steps:
        with monkeypatch.context() as patch, pytest.raises(Killed):
            patch.setattr(os if name == "link" else publish, name, dies(name, after))
            export.write_week_once(new, path, "day")
        assert ids(spark, path) == [1]
    assert publish.sweep_runs(spark, path, 2) == 8  # four runs had written their two weeks
    with monkeypatch.context() as patch, pytest.raises(Killed):
        patch.setattr(os, "link", dies("link", True))
        export.write_week_once(new, path, "day")
    assert ids(spark, path) == [1, 2, 3]
    assert export.write_week_once(new, path, "day").count() == 0
    assert publish.sweep_runs(spark, path, 2) == 0


def test_a_week_that_another_run_publishes_first_is_not_written_twice(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "data")
    mine = spark.createDataFrame([(1, datetime(2025, 1, 6)), (2, datetime(2025, 1, 13))], WEEK_ROWS)
    theirs = spark.createDataFrame([(7, datetime(2025, 1, 6))], WEEK_ROWS)
    plain, done = publish.publish, []

    def late(spark, root, base, slices):
        if not done:
            done.append(1)
            export.write_week_once(theirs, path, "day")
        return plain(spark, root, base, slices)

    monkeypatch.setattr(publish, "publish", late)
    assert [tuple(r)[:3] for r in export.write_week_once(mine, path, "day").collect()] == [(2025, 3, 1)]
    assert ids(spark, path) == [2, 7]
    assert publish.sweep_runs(spark, path, 2) == 0  # the loser of the first round took its files away


def test_no_rows_write_no_week(spark, tmp_path):
    path = str(tmp_path / "data")
    rows = spark.createDataFrame([], WEEK_ROWS)
    assert export.write_week_once(rows, path, "day").count() == 0
    assert export.finished_weeks(spark, path).count() == 0 and ids(spark, path) == []


def test_part_files_keep_to_the_cap(spark, tmp_path):
    lines = spark.range(500).select(F.lit("s").alias("stream"), "id", F.repeat(F.lit("x"), (F.col("id") % 40).cast("int")).alias("body"))
    line = F.to_json(F.struct("id", "body"))
    sized = lines.withColumn("bytes", (F.octet_length(line) + 1).cast("bigint"))
    numbered = parts.assign_parts(sized, "stream", ["id"], "bytes", 2_000).drop("bytes")
    path = str(tmp_path / "out")
    export.write_part_files(numbered, path, "stream")
    seen = []
    for folder in sorted(Path(path, "stream=s").iterdir(), key=lambda p: int(p.name.split("=")[1])):
        text = [x for p in files(folder, ".json") for x in p.read_text().splitlines()]
        assert sum(len(x) + 1 for x in text) <= 2_000
        seen += sorted(json.loads(x)["id"] for x in text)
    assert seen == list(range(500))


def test_buckets_get_a_folder_each(spark, tmp_path):
    rows = spark.range(60).select("id", F.expr("timestamp_ntz'2025-11-24 09:00:00' + make_dt_interval(0,0,0,id*20)").alias("ts"))
    path = str(tmp_path / "out")
    export.write_buckets(rows, path, "ts")
    assert sorted(p.name for p in Path(path).glob("bucket=*")) == [f"bucket=2025-11-24_09-{m:02d}" for m in (0, 5, 10, 15)]


def test_invalid_utf8_lines_are_dropped(spark, tmp_path):
    path = tmp_path / "lines.txt"
    path.write_bytes("good\nbad \xff\xfe\nüber\n".encode("latin-1").replace(b"\xfcber", "über".encode()))
    assert sorted(r.value for r in extract.read_lines_utf8(spark, str(path)).collect()) == ["good", "über"]


def test_pages_are_disjoint_and_whole(spark):
    def bounds():
        return 5, 103

    def fetch(low, high):
        return ((k, f"row {k}") for k in range(low, high) if k % 10)

    spark.dataSource.register(paged_source(bounds, fetch, "k long, t string", "few_pages"))
    df = spark.read.format("few_pages").option("pagesize", 7).option("pagespertask", 3).load()
    assert df.rdd.getNumPartitions() == 5
    assert sorted(r.k for r in df.collect()) == [k for k in range(5, 103) if k % 10]


def test_stream_equals_batch_below_the_watermark_and_resumes(spark, tmp_path):
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))
    rows = spark.range(200).select("id", F.expr("timestamp'2025-01-01 00:00:00' + make_dt_interval(0,0,0,id*30)").alias("ts"))
    rows.filter("id < 100").write.parquet(source)

    def run():
        stream = spark.readStream.schema(rows.schema).parquet(source)
        query = buckets.drain(buckets.stream_buckets(stream, "ts"), out, checkpoint)
        assert buckets.dropped_rows(query) == 0
        return {(r.bucket_start, r.n) for r in spark.read.parquet(out).collect()}

    first = run()
    rows.filter("id >= 100").write.mode("append").parquet(source)
    second = run()
    batch = {(r.bucket_start.replace(tzinfo=None), r.n) for r in windows.count_buckets(rows, "ts").collect()}
    assert first < second < batch
    assert len(batch) - len(second) <= 3
    rest = {(r.bucket_start, r.n) for r in buckets.held_back(rows, "ts", spark.read.parquet(out)).collect()}
    assert rest == batch - second


def test_a_stream_that_ends_counts_every_row_once_and_lists_late_ones(spark, tmp_path):
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))
    rows = spark.range(200).select("id", F.expr("timestamp_ntz'2025-01-01 00:00:00' + make_dt_interval(0,0,0,id*30)").alias("ts"))
    slices.use_timers(spark)

    def run(part):
        part.coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(rows.schema).parquet(source)
        slices.drain_to_end(slices.finished_slices(stream, "ts"), out, checkpoint)
        return [tuple(r) for r in spark.read.parquet(out).collect()]

    first = run(rows.filter("id < 100"))
    assert len(first) == 7 and all(n == 10 and not late for _, n, late in first)  # up to 10 minutes before the last row
    late = run(rows.filter("id between 100 and 150 or id in (3, 4, 12)"))
    assert sorted(n for _, n, is_late in late if is_late) == [1, 2]
    done = run(spark.createDataFrame([(151, datetime(2025, 1, 1, 1, 15, 30)), (-1, slices.END), (-2, None)], rows.schema))
    batch = {r.bucket_start: r.n for r in windows.count_buckets(rows.filter("id <= 151"), "ts").collect()}
    assert {at: n for at, n, is_late in done if not is_late} == batch and len(done) == len(batch) + 2


def test_scratch_needs_a_shared_folder(spark):
    assert scratch_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_a_scope_leaves_no_folder(spark):
    from tidemark.session import scratch_scope

    with scratch_scope(spark):
        paths = [scratch_path(spark, "scoped") for _ in range(2)]
        spark.range(5).write.parquet(paths[0])
        assert Path(paths[0]).exists()
    assert not any(Path(p).exists() for p in paths)


def test_batch_completes_only_what_can_be_read_back(spark, tmp_path):
    from datetime import timedelta

    from tidemark.plans import ingest

    day = datetime(2025, 1, 1)
    rows = [(1, "pending", day, True), (2, "pending", day + timedelta(days=1), False), (3, "pending", day + timedelta(days=2), True),
            (4, "in_progress", day, True), (5, "pending", day - timedelta(days=900), True), (6, "pending", day + timedelta(days=3), True)]
    ledger = spark.createDataFrame(rows, "record_id long, status string, window_start timestamp_ntz, audit_enabled boolean").selectExpr(
        "*", "window_start + interval 1 day as window_end", "window_start as started_at", "'done' as stage_export", "'open' as stage_transfer", "'open' as stage_audit")
    source = spark.createDataFrame([(k, i, "x" * 40) for k in (1, 2, 4, 6) for i in range(10)], "record_id long, seq int, body string")
    target = source.filter("record_id = 1").select("record_id")
    rules = ingest.LoadRules(day + timedelta(days=30), timedelta(days=100), day - timedelta(days=99), timedelta(days=2), 3, 200)
    path = str(tmp_path / "load")
    out = {r.record_id: r for r in ingest.load_batch(ledger, source, target, ("seq",), path, rules).collect()}
    assert {k: (r.status, r.reason, r.source_count) for k, r in out.items()} == {
        1: ("completed", None, 10),                             # found complete, not loaded again
        2: ("completed", None, 10),                             # not audited, loaded
        3: ("completed", None, 0),                              # nothing on either side
        4: ("completed", None, 10),                             # was stuck, reset and loaded
        5: ("failed_permanently", "window_outside_range", None),
        6: ("completed", None, 10),
    }
    assert out[4].stage_transfer == "open" and out[2].completed_at == rules.now
    loaded = spark.read.schema("value string, record_id long, part long").text(path)
    assert {(r.record_id, r["count"]) for r in loaded.groupBy("record_id").count().collect()} == {(2, 10), (4, 10), (6, 10)}
    per_part = loaded.groupBy("record_id", "part").agg(F.sum(F.octet_length("value") + 1).alias("b")).collect()
    assert len(per_part) > 3 and max(r.b for r in per_part) <= 200
    with pytest.raises(Exception, match="already exists"):
        ingest.load_batch(ledger, source, target, ("seq",), path, rules)


def test_compression_ratio(spark, tmp_path):
    from tidemark.operators import rollups

    rows = spark.range(5000).select(F.lit("s").alias("part"), F.concat(F.lit("row "), F.col("id").cast("string")).alias("text"))
    path = str(tmp_path / "out")
    export.write_csv_gz_parts(rows.select("text"), path, rows=2000)
    packed = export.manifest(extract.read_header_csv(spark, path)).agg(F.sum("bytes").alias("packed"))
    raw = rollups.part_sizes(rows, "part", F.col("text")).first()
    saved = packed.select(rollups.compression_ratio(F.lit(raw.raw_bytes), F.col("packed")).alias("saved")).first().saved
    assert raw.lines == 5000 and 50 < saved < 100
    assert spark.range(1).select(rollups.compression_ratio(F.lit(0), F.lit(20)).alias("s")).first().s == 0.0


def window_ledger(spark, day, rows):
    from datetime import timedelta

    made = [(k, "pending", day + timedelta(minutes=low), day + timedelta(minutes=high), audited) for k, low, high, audited in rows]
    ledger = spark.createDataFrame(made, "record_id long, status string, window_start timestamp_ntz, window_end timestamp_ntz, audit_enabled boolean")
    return ledger.selectExpr("*", "window_start as started_at", "'open' as stage_export", "'open' as stage_transfer", "'open' as stage_audit")


def test_window_load_clears_what_a_dead_load_left(spark, tmp_path):
    from datetime import timedelta

    from tidemark.operators.ledger import with_record
    from tidemark.plans import ingest
    from tidemark.sinks import keyed

    day, root = datetime(2025, 1, 1), str(tmp_path / "store")
    source = spark.range(600).select("id", (F.lit(day).cast("timestamp_ntz") + F.make_dt_interval(mins=F.col("id").cast("int"))).alias("ts"))
    windows = [(1, 0, 60, True), (2, 30, 90, True), (3, 60, 65, False), (4, 100, 200, True), (5, 300, 300, True), (6, 400, 410, True), (7, 590, 700, True)]
    ledger = window_ledger(spark, day, windows)
    rules = ingest.LoadRules(day + timedelta(days=2), timedelta(days=9), day - timedelta(days=9), timedelta(days=3), 4)

    def held(k):
        return [i for i in range(600) if windows[k - 1][1] <= i < windows[k - 1][2]]

    whole = with_record(source, ledger, "ts")
    left = whole.filter("record_id = 1 or (record_id = 2 and id < 50) or (record_id = 4 and id % 2 = 0)")  # 1 complete, 2 and 4 half done
    other = left.filter("record_id = 4").withColumn("record_id", F.lit(99).cast("long"))
    assert keyed.upsert_stored(left.unionByName(other), root, "record_id", 8)

    def stored():
        found = {}
        for r in keyed.read_keyed(spark, root, whole.schema).collect():
            found.setdefault(r.record_id, []).append(r.id)
        return {k: sorted(v) for k, v in found.items()}

    first = {r.record_id: r for r in ingest.load_windows(ledger, source, "ts", root, rules, 8).collect()}
    assert {k: (r.status, r.source_count, r.target_count) for k, r in first.items()} == {
        1: ("completed", 60, 60), 5: ("completed", 0, 0),          # found complete
        2: ("completed", 60, 60), 3: ("completed", 5, 5), 4: ("completed", 100, 100), 6: ("completed", 10, 10),
        7: ("pending", None, None)}                                # beyond the batch
    assert stored() == {**{k: held(k) for k in (1, 2, 3, 4, 6)}, 99: [i for i in held(4) if i % 2 == 0]}
    again = ingest.load_windows(ledger, source, "ts", root, rules, 8).collect()
    assert {r.record_id: r.status for r in again} == {k: "completed" for k in range(1, 8)}
    assert stored() == {**{k: held(k) for k in (1, 2, 3, 4, 6, 7)}, 99: [i for i in held(4) if i % 2 == 0]}


def test_a_dead_window_load_changes_nothing_and_a_rival_makes_it_look_again(spark, tmp_path, monkeypatch):
    from datetime import timedelta

    from tidemark.plans import ingest
    from tidemark.sinks import keyed

    day, root = datetime(2025, 1, 1), str(tmp_path / "store")
    source = spark.range(50).select("id", (F.lit(day).cast("timestamp_ntz") + F.make_dt_interval(mins=F.col("id").cast("int"))).alias("ts"))
    ledger = window_ledger(spark, day, [(1, 0, 10, True), (2, 10, 20, True)])
    rules = ingest.LoadRules(day + timedelta(days=2), timedelta(days=9), day - timedelta(days=9), timedelta(days=3), 5)
    schema = source.withColumn("record_id", F.lit(1).cast("long")).schema
    plain = publish.publish
    with monkeypatch.context() as patch, pytest.raises(RuntimeError, match="lost"):
        patch.setattr(publish, "publish", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        ingest.load_windows(ledger, source, "ts", root, rules, 4)
    assert keyed.read_keyed(spark, root, schema).count() == 0 and publish.sweep_runs(spark, root, 1) == 0
    done = []

    def late(spark, root, base, slices):
        if not done:
            done.append(1)
            ingest.load_windows(ledger.filter("record_id = 2"), source, "ts", root, rules, 4)
        return plain(spark, root, base, slices)

    monkeypatch.setattr(publish, "publish", late)
    out = ingest.load_windows(ledger, source, "ts", root, rules, 4).collect()
    assert {(r.record_id, r.status, r.target_count) for r in out} == {(1, "completed", 10), (2, "completed", 10)}
    assert keyed.read_keyed(spark, root, schema).count() == 20


def test_one_long_row_changes_neither_layout_nor_schema(spark, tmp_path):
    rows = spark.range(0, 1000, 1, 2).selectExpr("id", "case when id = 500 then repeat('x', 400000) else 'x' end as t", "array(id, null) as a", "named_struct('k', id) as s")
    path = str(tmp_path / "out")
    export.write_parquet_capped(rows, path, max_bytes=100_000)
    found = files(path, ".parquet")
    assert {p.parent for p in found} == {Path(path)} and spark.read.parquet(path).dtypes == rows.dtypes
    assert sorted(map(tuple, spark.read.parquet(path).select("id", "a", "s.k").collect())) == [(i, [i, None], i) for i in range(1000)]
    manifest = {Path(r.file_path).name: r for r in capped.written_files(spark, path).collect()}
    assert {p.name: p.stat().st_size for p in found} == {name: r.file_bytes for name, r in manifest.items()}
    assert sum(r.rows for r in manifest.values()) == 1000 and all(r.started_at <= r.finished_at for r in manifest.values())


def test_types_survive_the_capped_writer(spark, tmp_path):
    rows = spark.sql("""select cast(1 as tinyint) a, cast(2.50 as decimal(9,2)) b, date'2025-01-02' c, timestamp_ntz'2025-01-02 03:04:05.123456' d,
        timestamp'2025-01-02 03:04:05' e, x'00ff' f, map('k', array(1, null)) g, cast(null as string) h, true i, cast('nan' as double) j""")
    path = str(tmp_path / "out")
    export.write_parquet_capped(rows.union(rows), path)
    back = spark.read.parquet(path)
    assert back.dtypes == rows.dtypes
    assert [str(r) for r in back.collect()] == [str(r) for r in rows.union(rows).collect()]


def test_capped_modes(spark, tmp_path):
    path, rows = str(tmp_path / "out"), spark.range(100)
    export.write_parquet_capped(rows, path)
    with pytest.raises(FileExistsError):
        export.write_parquet_capped(rows, path)
    export.write_parquet_capped(rows, path, mode="append")
    assert spark.read.parquet(path).count() == 200 and capped.written_files(spark, path).agg(F.sum("rows")).first()[0] == 200
    export.write_parquet_capped(rows, path, mode="overwrite")
    assert spark.read.parquet(path).count() == 100
    assert [p.name for p in tmp_path.iterdir()] == ["out"]
    empty = str(tmp_path / "empty")
    export.write_csv_gz_parts(rows.limit(0), empty)
    assert files(empty, ".gz") == [] and capped.written_files(spark, empty).count() == 0


def test_failed_capped_write_leaves_nothing_and_a_second_attempt_counts_once(spark, tmp_path):
    rows = spark.range(0, 10_000, 1, 8)
    bad = rows.withColumn("x", F.when(F.col("id") == 9_999, F.raise_error(F.lit("broken row"))).otherwise(F.col("id").cast("string")))
    with pytest.raises(Exception, match="broken row"):
        export.write_parquet_capped(bad, str(tmp_path / "out"), 1_000)
    assert list(tmp_path.iterdir()) == []
    # A staged file of an attempt that does not count, as a lost executor leaves it, never reaches the target.
    options = {"staging": str(tmp_path / "_run"), "target": str(tmp_path / "kept"), "mode": "errorifexists"}
    (tmp_path / "_run").mkdir()
    for name in ("part-counts", "part-lost"):
        (tmp_path / "_run" / name).write_text("x")
    capped.CappedWriter(options).commit([capped.TaskFiles([capped.Written("part-counts", None, 1, 1, 1, 0.0, 1.0)]), None])
    assert [p.name for p in sorted((tmp_path / "kept").iterdir())] == ["_manifest", "part-counts"]


def test_keyed_files_close_with_their_key(spark, tmp_path):
    rows = spark.range(300).select((F.col("id") % 3).cast("string").alias("s"), F.floor(F.col("id") / 30).alias("part"), "id", F.concat(F.lit("line "), "id").alias("line"))
    path = str(tmp_path / "out")
    export.write_keyed_lines(rows.repartition(7), path, "s", order=("id",))
    found = {r.key: r for r in capped.written_files(spark, path).collect()}
    assert set(found) == {f"{s}/{p}" for s in range(3) for p in range(10)} and len([p for p in files(path, ".json") if p.parent == Path(path)]) == 30
    for key, r in found.items():
        s, part = map(int, key.split("/"))
        want = [f"line {i}" for i in range(300) if i % 3 == s and i // 30 == part]
        assert Path(r.file_path).read_text().splitlines() == want and r.bytes == r.file_bytes == sum(len(x) + 1 for x in want)


def test_csv_is_split_by_whole_lines_as_they_stand(spark, tmp_path):
    source, out = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    body = [f'{i},"a ""quoted"", é",, x ' for i in range(500)] + ["id,t,u,v"]  # a row that reads like the header is a row
    for n in range(3):
        (source / f"f{n}.csv").write_text("\n".join(["id,t,u,v", *body[n::3]]) + "\n", encoding="utf-8")
    export.split_csv(spark, str(source), out, rows=40, max_bytes=1_000)
    texts = [gzip.open(p, "rt", encoding="utf-8").read() for p in files(out, ".csv.gz")]
    lines = [t.splitlines() for t in texts]
    assert all(x[0] == "id,t,u,v" and len(x) <= 41 for x in lines) and all(len(t.encode()) <= 1_000 for t in texts)
    assert sorted(line for x in lines for line in x[1:]) == sorted(body)
    (source / "odd.csv").write_text("id,t,u,w\n1,2,3,4\n")
    with pytest.raises(Exception, match="header"):
        export.split_csv(spark, str(source), str(tmp_path / "odd"))


def test_texts_are_written_by_the_tasks_that_read_them(spark, tmp_path, monkeypatch):
    from tidemark.catalog import exports
    from tidemark.sinks import capped

    spark.range(0, 800, 1, 8).selectExpr("id as doc_id", "repeat('x', cast(id as int)) as text").write.parquet(str(tmp_path / "in" / "documents.parquet"))
    monkeypatch.setattr(exports, "scratch_path", lambda spark, label: str(tmp_path / label))
    assert [tuple(r) for r in exports.parquet_part_sizes(spark, str(tmp_path / "in")).collect()] == [(True, 800, 800 * 799 // 2)]
    names = [r.file_path.rpartition("/")[2] for r in capped.written_files(spark, str(tmp_path / "sizes")).collect()]
    assert len({n.split("-")[1] for n in names}) == 8  # as many tasks as input files, not a fixed number


def test_a_change_is_written_by_tasks_of_bounded_bytes(spark, tmp_path, monkeypatch):
    from pathlib import Path

    from tidemark.sinks import keyed

    monkeypatch.setattr(publish, "TASK_BYTES", 4_000, raising=False)
    root = str(tmp_path / "store")
    rows = spark.range(4_000).selectExpr("id % 5 as k", "id", "if(id % 2 = 0, null, 'x') as t", "array(id) as a")
    assert keyed.upsert_stored(rows, root, "k", 4)
    files = [str(p) for p in Path(root).rglob("*.parquet")]
    assert max(r.n for r in spark.read.parquet(*files).groupBy(F.input_file_name()).agg(F.count(F.lit(1)).alias("n")).collect()) < 300
    assert keyed.upsert_stored(spark.range(3).selectExpr("cast(2 as bigint) as k", "id", "'y' as t", "array(id) as a"), root, "k", 4)
    back = [tuple(r) for r in keyed.read_keyed(spark, root, rows.schema).collect()]
    kept = [tuple(r) for r in rows.filter("k <> 2").collect()]
    assert sorted(map(repr, back)) == sorted(map(repr, kept + [(2, i, "y", [i]) for i in range(3)]))
