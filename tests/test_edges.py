"""Literal rows for the edges of each operator."""

from datetime import date, datetime, timedelta
from functools import partial

import pytest
from pyspark.sql import functions as F

from tidemark.functions import clock, texts
from tidemark.operators import filters, ledger, links, logs, people, records, rollups, trends, windows
from tidemark.sources import extract
from tidemark.sources.jdbc import window_options


def values(df, *columns):
    return [tuple(r) for r in (df.select(*columns) if columns else df).collect()]


def test_day_windows_follow_clock_changes(spark):
    zone = "America/Los_Angeles"
    rows = windows.day_windows(spark, zone, date(2025, 3, 8), date(2025, 3, 10)).collect()
    assert [(r.end_utc - r.start_utc) for r in rows] == [timedelta(hours=24), timedelta(hours=23), timedelta(hours=24)]
    rows = windows.day_windows(spark, zone, date(2025, 11, 2), date(2025, 11, 2)).collect()
    assert rows[0].end_utc - rows[0].start_utc == timedelta(hours=25)
    recent = windows.recent_day_windows(spark, zone, date(2025, 11, 10)).collect()
    assert [r.target_day for r in recent] == [date(2025, 11, 2) + timedelta(days=i) for i in range(7)]


def test_daily_counts_zero_days_and_edges(spark):
    zone = "America/Los_Angeles"
    stamps = [datetime(2025, 3, 9, 7, 59, 59, 999999), datetime(2025, 3, 9, 8), datetime(2025, 3, 10, 6, 59, 59),
              datetime(2025, 3, 10, 7)]
    df = spark.createDataFrame([(t,) for t in stamps], "ts timestamp_ntz")
    got = values(windows.daily_counts(df, "ts", zone, date(2025, 3, 8), date(2025, 3, 11)))
    assert got == [(date(2025, 3, 8), 1), (date(2025, 3, 9), 2), (date(2025, 3, 10), 1), (date(2025, 3, 11), 0)]


def test_zoned_timestamps_count_like_naive_ones(spark):
    zone = "America/Los_Angeles"
    naive = spark.range(400).select(F.expr("timestamp_ntz'2025-03-07 20:00:00' + make_dt_interval(0, 0, id * 17)").alias("ts"))
    zoned = naive.select(F.col("ts").cast("timestamp").alias("ts"))

    def stats(df, dims):
        return df.groupBy(*dims).agg(F.count(F.lit(1)).alias("n"))

    span = (datetime(2025, 3, 7, 20), datetime(2025, 3, 12, 1))
    for first, second in (
        [windows.daily_counts(df, "ts", zone, date(2025, 3, 6), date(2025, 3, 13)) for df in (naive, zoned)],
        [trends.trend(df, "ts", zone, *span, stats, days=2) for df in (naive, zoned)],
        [windows.count_buckets(df, "ts").select(F.col("bucket_start").cast("timestamp_ntz"), "n") for df in (naive, zoned)],
        [windows.render_zones(df, "ts").drop("ts") for df in (naive, zoned)],
    ):
        assert sorted(values(first)) == sorted(values(second)) != []
    counted = windows.daily_counts(zoned, "ts", zone, date(2025, 3, 6), date(2025, 3, 13))
    assert counted.agg(F.sum("row_count")).first()[0] == 400


def test_trend_windows_align_and_clip(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 1, 15), datetime(2024, 1, 4, 6))], "start_ts timestamp_ntz, end_ts timestamp_ntz")
    got = values(windows.trend_windows(df, 2), "window_start", "window_end")
    assert got == [(datetime(2024, 1, 1, 15), datetime(2024, 1, 3)), (datetime(2024, 1, 3), datetime(2024, 1, 4, 6))]


def test_trend_without_rows_is_zero(spark):
    df = spark.createDataFrame([], "ts timestamp_ntz, hostname string, total_runrate double, core_hours double, "
                                   "ram_hours double, cpu_30d double, core_count int, ram double")
    got = trends.trend(df, "ts", "UTC", datetime(2024, 1, 1), datetime(2024, 1, 3), partial(rollups.compute_stats, order=("ts",))).orderBy("trend_day")
    assert values(got, "trend_day", "count", "run_rate", "efficiency") == [
        (date(2024, 1, 1), 0, 0.0, None), (date(2024, 1, 2), 0, 0.0, None)]


def test_iso_weeks_at_year_ends(spark):
    days = [date(2024, 12, 29), date(2024, 12, 30), date(2027, 1, 3), date(2026, 12, 28), date(2021, 1, 1)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    assert [r.week_folder for r in windows.iso_weeks(df, "d").collect()] == [
        "{:04d}/week_{:02d}".format(*d.isocalendar()[:2]) for d in days]


def test_resolve_windows_cases(spark):
    now, t = datetime(2025, 1, 2, 12), datetime(2025, 1, 1)
    rows = [(1, t, now, None), (2, t, None, 600), (3, None, None, 600), (4, t, None, None), (5, None, None, None), (6, now, t, None)]
    df = spark.createDataFrame(rows, "id int, start_ts timestamp_ntz, end_ts timestamp_ntz, duration_s long")
    got = {r.id: (r.window_start, r.window_end, r.valid) for r in windows.resolve_windows(df, now).collect()}
    assert got == {
        1: (t, now, True), 2: (t, t + timedelta(minutes=10), True), 3: (now - timedelta(minutes=10), now, True),
        4: (t, now, True), 5: (now - timedelta(hours=1), now, True), 6: (now, t, False),
    }


def test_parse_times(spark):
    cases = {
        "2025-10-14T14:33:21Z": datetime(2025, 10, 14, 14, 33, 21),
        "2025-10-14T14:33:21+05:30": datetime(2025, 10, 14, 9, 3, 21),
        "2025-10-14 14:33:21.250000-07:00": datetime(2025, 10, 14, 21, 33, 21, 250000),
        "31/12/2025 10:00:00": datetime(2025, 12, 31, 10),
        "12/31/2025 10:00:00": datetime(2025, 12, 31, 10),
        "03/04/2025 00:00:00": datetime(2025, 4, 3),
        "junk": None,
    }
    df = spark.createDataFrame([(s,) for s in cases], "s string")
    got = {r.s: (r.s_utc, r.s_ok) for r in windows.parse_times(df, "s", assume_zone="UTC").collect()}
    assert got == {s: (t, t is not None) for s, t in cases.items()}
    unknown = windows.parse_times(df.filter("s like '31/%'"), "s").first()
    assert (unknown.s_utc, unknown.s_ok) == (None, False)


def test_age_and_zones(spark):
    df = spark.createDataFrame([("2025-10-14T14:33:21+05:30", "2025-10-14T14:30:00+07:30")], "a string, b string")
    both = df.select(clock.parse_utc(F.col("a"), ()).alias("a"), clock.parse_utc(F.col("b"), ()).alias("b"))
    assert values(windows.age_seconds(both, "a", "b"), "age_s") == [(7401,)]
    cut = spark.createDataFrame([(datetime(2025, 1, 1, 0, 0, 0, 900000), datetime(2025, 1, 1, 0, 0, 2))], "a timestamp_ntz, b timestamp_ntz")
    assert values(windows.age_seconds(cut, "a", "b"), "age_s") == [(-1,)]
    summer = windows.render_zones(spark.createDataFrame([(datetime(2025, 7, 1),)], "t timestamp_ntz"), "t").first()
    assert summer.at_utc == "2025-07-01T00:00:00+00:00"
    assert summer.at_los_angeles == "2025-06-30T17:00:00-07:00"
    assert summer.at_kolkata == "2025-07-01T05:30:00+05:30"
    assert values(windows.shift_seconds(spark.createDataFrame([(datetime(2025, 7, 1),)], "t timestamp_ntz"), "t", 90, "UTC"), "shifted") == [
        ("2025-06-30T23:58:30+00:00",)]


def test_durations(spark):
    cases = {"1m:40s": 100, "2d 3h": 183600, "1H": 3600, "90": 0, "": 0}
    df = spark.createDataFrame([(s,) for s in cases], "s string")
    assert {r.s: r.duration_s for r in windows.duration_seconds(df, "s").collect()} == cases


def test_negations_keep_missing(spark):
    df = spark.createDataFrame([(1, "na", "offline"), (2, "bob", "online"), (3, None, None)], "id int, owner string, state string")
    assert [r.id for r in filters.exclude(df, {"owner": "na"}).collect()] == [2, 3]
    assert [r.id for r in filters.filter_status(df, "storage", "Production").collect()] == [2, 3]
    assert [r.id for r in filters.filter_status(df, "storage", "Retired").collect()] == [1]
    with pytest.raises(ValueError):
        filters.filter_status(df, "storage", "Unknown")


def test_filters_without_conditions(spark):
    df = spark.createDataFrame([(1, "a")], "id int, site string")
    assert filters.filter_terms(df, {}, ("site",)).count() == 1
    assert filters.filter_terms(df, {"id": [9]}, ("site",)).count() == 1
    assert filters.exclude(df).count() == 1


def test_owner_or_chain_with_nulls(spark):
    df = spark.createDataFrame([(1, "a", None), (2, None, ["x", "a"]), (3, "b", [None]), (4, None, None)],
                               "id int, pri_owner string, owner_mgr_chain array<string>")
    assert [r.id for r in filters.filter_owner_or_chain(df, ["a"]).collect()] == [1, 2]


def test_levels(spark):
    df = spark.createDataFrame([("debug",), ("Info",), ("WARNNING",), ("error",), (None,)], "level string")
    assert [r.level for r in filters.filter_level(df, "level", "INFO").collect()] == ["Info", "WARNNING", "error", None]
    assert [r.level for r in filters.filter_level(df, "level", "warning").collect()] == ["error"]


def test_exec_rollup_isolates_execs(spark):
    users = spark.createDataFrame([("u1", "boss", "Active"), ("u2", "boss", "Active"), ("u3", "boss", "Inactive")],
                                  "user_id string, manager string, status string")
    execs = spark.createDataFrame([("boss",), ("solo",)], "exec_id string")
    rows = [(1, "u1", ["boss", "u1"], "h1", 1.0), (2, "x", ["boss", "u1"], "h2", 2.0),
            (3, "solo", ["top"], "h3", 4.0), (4, "y", ["solo"], "h4", 8.0), (5, None, None, "h5", 16.0), (6, "u2", None, "h6", 32.0)]
    inventory = spark.createDataFrame(rows, "id int, pri_owner string, owner_mgr_chain array<string>, hostname string, v double")
    got = people.exec_rollup(inventory, users, execs, lambda df, dims: df.groupBy(*dims).agg(F.sum("v").alias("v")))
    assert sorted(values(got, "exec_id", "person", "v")) == [("boss", "u1", 3.0), ("boss", "u2", 32.0), ("solo", "solo", 4.0)]


def test_storage_without_size(spark):
    df = spark.createDataFrame([("m1", datetime(2025, 1, 1), 0.0, 0.0), ("m2", datetime(2025, 1, 1), None, None)],
                               "mount_point string, ts timestamp_ntz, totalsize double, usedsize double"
                               ).withColumns({"runrate": F.lit(1.0), "disk_hours": F.lit(2.0), "used_pct": F.lit(None).cast("double")})
    got = rollups.storage_stats(df, [], ("ts",)).first()
    assert (got.disk_count, got.total_size, got.used_size, got.disk_efficiency, got.efficiency) == (2, 0.0, 0.0, 0.0, None)


def test_rows_without_host_count_in_sums_only(spark):
    rows = [(None, datetime(2025, 1, 1), 1.0, 5), ("h", datetime(2025, 1, 2), 2.0, 3), ("h", datetime(2025, 1, 1), 4.0, 9)]
    df = spark.createDataFrame(rows, "hostname string, ts timestamp_ntz, total_runrate double, core_count int").withColumns(
        {"core_hours": F.lit(0.0), "ram_hours": F.lit(0.0), "cpu_30d": F.lit(0.5), "ram": F.lit(1.0)})
    got = rollups.compute_stats(df, [], ("ts",)).first()
    assert (got["count"], got.run_rate, got.core_count, got.ram, got.efficiency) == (1, 7.0, 3.0, 1.0, 50.0)


def test_latest_by_any_order(spark):
    t = datetime(2025, 1, 1)
    rows = [("a", t, 5, "x", 1), ("a", t, -(2**63), "z", 2), ("a", t - timedelta(days=1), 2**63 - 1, "y", 3), ("a", None, 9, "w", 4),
            ("b", None, 1, "p", 5), ("b", None, 2, "q", 6), ("c", datetime(1900, 1, 1), None, "r", 7), ("c", datetime(1900, 1, 1), -4, "s", None)]
    df = spark.createDataFrame(rows, "k string, ts timestamp_ntz, tie long, name string, v int")

    def got(*order):
        return dict(values(rollups.latest_per_key(df, "k", list(order), ["v"]), "k", "v"))

    assert got("ts", "tie") == {"a": 1, "b": 6, "c": None}
    assert got("ts", "tie", "name") == {"a": 1, "b": 6, "c": None}
    assert got("name") == {"a": 2, "b": 6, "c": None}
    assert got("tie") == {"a": 3, "b": 6, "c": None}
    assert got("ts", "name") == {"a": 2, "b": 6, "c": None}
    plan = rollups.latest_per_key(df.drop("name"), "k", ["ts", "tie"], ["v"])._jdf.queryExecution().toString()
    assert "SortAggregate" not in plan


def test_nested_terms_ties_and_nulls(spark):
    rows = [("a", "x")] * 3 + [("a", "y")] * 3 + [("a", "z")] + [("b", "x")] * 2 + [("c", "q")] * 7 + [(None, "x")] * 9 + [("b", None)] * 9
    df = spark.createDataFrame(rows, "d1 string, d2 string")
    got = sorted(values(rollups.nested_terms(df, ["d1", "d2"], 2)))
    assert got == [("a", "x", 3), ("a", "y", 3), ("c", "q", 7)]


def test_nest_buckets(spark):
    df = spark.createDataFrame([("a", "x", "p", 1), ("a", "x", "q", 2), ("a", "y", "p", 3)], "d1 string, d2 string, d3 string, n int")
    assert values(rollups.nest_buckets(df, ["d1", "d2", "d3"])) == [
        ("a", '{"x":{"p":{"n":1},"q":{"n":2}},"y":{"p":{"n":3}}}')]


def test_envelopes(spark):
    df = spark.createDataFrame([('{"result":[{"a":"1"},{"a":"2"}]}',), ('{"result":null}',), ("{}",), ('{"result":[]}',)], "body string")
    assert values(extract.flatten_envelope(df, "body", "a:string")) == [("1",), ("2",)]


def test_query_rows_checks_names(spark):
    spark.createDataFrame([(1, "O'Reilly"), (2, None)], "c3 int, c1 string").createOrReplaceTempView("edge_rows")
    assert extract.query_rows(spark, "edge_rows", {"c1": "O'Reilly"}, "c3").count() == 1
    assert extract.query_rows(spark, "edge_rows", {"c1": None}, "c3").count() == 0
    text = "select c3 from edge_rows where c1 = :who or c3 > :low"
    assert values(extract.query_rows(spark, text, {"who": "O'Reilly", "low": 1}, "c3")) == [(1,), (2,)]
    for bad in ("edge_rows; drop", "a b", "x`y"):
        with pytest.raises(ValueError):
            extract.query_rows(spark, bad, {}, "c3")
    with pytest.raises(ValueError):
        extract.query_rows(spark, "edge_rows", {"c1 = 1 or c1": 1}, "c3")


def test_worksheet_contract_rejects(spark):
    df = spark.createDataFrame([("1", "p", "l")], "ticket_id string, priority string, link string")
    required = ["ticket_id", "priority", "link"]
    kept = extract.worksheet_contract(df, required)
    assert kept.columns == [*required, "row_hash"]
    assert values(kept, "row_hash") == values(extract.worksheet_contract(df, required, ["ticket_id", "priority"]), "row_hash")
    for args in (([],), (["absent"],), (["ticket_id"], ["priority"])):
        with pytest.raises(ValueError):
            extract.worksheet_contract(df, *args)


def test_window_start_after_end(spark):
    with pytest.raises(ValueError):
        extract.extract_window(spark.range(1), "id", datetime(2025, 1, 2), datetime(2025, 1, 1))


def test_jdbc_options_are_checked():
    options = window_options("jdbc:x", "schema.tab", "ts", "2025-01-01T00:00:00+01:00", datetime(2025, 1, 2), 4)
    assert options["lowerBound"] == "2024-12-31 23:00:00.000000" and options["numPartitions"] == "4"
    for table, column in (("a;b", "ts"), ("a", "t s")):
        with pytest.raises(ValueError):
            window_options("jdbc:x", table, column, datetime(2025, 1, 1), datetime(2025, 1, 2), 4)


# A result and the links it holds, as (kind, value).
LINKS = [
    ('{"urls": ["http://a", "", " ", null, 7], "prefix": "s3://p"}', [("url", "http://a")]),
    ('{"urls": [""], "prefix": "s3://p"}', []),
    ('{"urls": [], "prefix": "s3://p"}', [("prefix", "s3://p")]),
    ('{"urls": "x", "prefix": " "}', []),
    ('{"prefix": 5, "other": "http://a"}', []),
    ("{}", []),
    ("[]", []),
    ('["http://a", "", "http://a"]', [("url", "http://a"), ("url", "http://a")]),
    ('["http://a", 1]', []),
    ('["http://a", null]', []),
    ('[{"urls": ["http://a", "http://a"]}, {"k": "http://a", "m": "https://b", "n": "s3://c"}, {"z": "https://b"}, 4, "http://x"]',
     [("prefix", "s3://c"), ("url", "http://a"), ("url", "http://a"), ("url", "https://b")]),
    ('[{"k": "http://a"}, {"urls": ["http://a"]}, {"prefix": "s3://c"}, {"q": "s3://c", "r": {"deep": "http://no"}}]',
     [("prefix", "s3://c"), ("url", "http://a"), ("url", "http://a")]),
    ('[{"urls": [], "prefix": "", "k": "s3://d"}, null]', [("prefix", "s3://d")]),
]


def test_link_shapes(spark):
    df = spark.createDataFrame([(i, body) for i, (body, _) in enumerate(LINKS)], "id int, body string")
    got = sorted(values(links.extract_links(df, "id", "body")))
    assert got == sorted((i, *link) for i, (_, found) in enumerate(LINKS) for link in found)
    bad = spark.createDataFrame([(1, "42"), (2, '"text"'), (3, "{broken"), (4, None), (5, "null"), (6, "[]")], "id int, body string")
    assert [r.id for r in links.bad_results(bad, "body").collect()] == [1, 2, 3, 4, 5]
    assert links.extract_links(bad, "id", "body").count() == 0


def test_destinations(spark):
    urls = ["http://h.com/a/f.gz?x=1", "https://h.com/", "https://u@h.com:8080", "http://o.com/b/f.gz", "http://h.com/x/"]
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    got = {r.url: (r.dest_key, r.duplicate) for r in links.plan_destinations(df, "url", "w/").collect()}
    assert got == {urls[0]: ("w/f.gz", True), urls[1]: ("w/h.com", True), urls[2]: ("w/u@h.com:8080", False),
                   urls[3]: ("w/f.gz", True), urls[4]: ("w/h.com", True)}


def test_object_uris(spark):
    uris = {"s3://b/a/n.json": (True, "b", "a", "n.json"), "s3://b/n": (True, "b", "", "n"), "s3://b/a/n/": (True, "b", "a", "n"),
            "s3://b": (False, None, None, None), "s3://b/": (False, None, None, None), "http://b/n": (False, None, None, None)}
    df = spark.createDataFrame([(u,) for u in uris], "u string")
    got = {r.u: (r.valid, r.bucket, r.prefix, r["name"]) for r in links.split_object_uri(df, "u").collect()}
    assert got == uris


def test_tagged_replies(spark):
    texts_ = ['x BEGIN_JSON_RESULT\n{"ok": true, "result": {"n": 1}}\nEND_JSON_RESULT y', 'BEGIN_JSON_RESULT {"ok": false} END_JSON_RESULT',
              "nothing", 'BEGIN_JSON_RESULT {bad} END_JSON_RESULT', None]
    df = spark.createDataFrame([(t,) for t in texts_], "t string")
    got = values(links.extract_tagged_json(df, "t", "struct<n:int>"), "result.n", "error")
    assert got == [(1, None), (None, "reported an error"), (None, "no result found"), (None, "reported an error"), (None, "no result found")]


def test_fingerprints_tell_nulls_apart(spark):
    df = spark.createDataFrame([(None, "a"), ("a", None), ("", "a"), ("null", "a"), ("a|1:b", "c"), ("a", "1:b|1:c")], "x string, y string")
    assert df.select(texts.fingerprint(F.col("x"), F.col("y")).alias("h")).distinct().count() == 6


def test_range_names(spark):
    name = texts.range_object_name(F.lit("tab"), F.lit("2025-01-01T00:00:00+05:30"), F.lit("2025-01-02 00:00:00"), F.lit(3))
    assert spark.range(1).select(name.alias("n")).first().n == "tab_2025-01-01T000000_0530_2025-01-02_000000_part3.parquet"


def test_reset_opens_the_stuck_stage_only(spark):
    t = datetime(2025, 1, 1)
    rows = [(1, "in_progress", t, "done", "partial", "open"), (2, "in_progress", t + timedelta(days=9), "open", "open", "open"),
            (3, "in_progress", t, "done", "done", "done"), (4, "pending", t, "x", "x", "x")]
    df = spark.createDataFrame(rows, "record_id int, status string, window_start timestamp_ntz, stage_export string, stage_transfer string, stage_audit string")
    stuck = ledger.find_stuck(df, t + timedelta(days=5), timedelta(days=1), "window_start")
    assert sorted(values(stuck, "record_id", "stuck_stage")) == [(1, "transfer"), (3, None)]
    got = sorted(values(ledger.reset_stuck(df, stuck), "record_id", "status", "stage_export", "stage_transfer", "stage_audit"))
    assert got == [(1, "pending", "done", "open", "open"), (2, "in_progress", "open", "open", "open"),
                   (3, "pending", "done", "done", "done"), (4, "pending", "x", "x", "x")]


def test_reconcile_reports_empty_windows(spark):
    side = spark.createDataFrame([(1,), (1,), (2,)], "record_id int")
    keys = spark.createDataFrame([(1,), (2,), (3,)], "record_id int")
    got = ledger.reconcile_counts(side, side.limit(2), windows=keys)
    assert sorted(values(got)) == [(1, 2, 2, True), (2, 1, 0, False), (3, 0, 0, True)]


def watched(run, interval, most):
    """Step by step: check, then sleep, alert, and check again until done or out of time."""
    checks, alerts, at = 1, [], 0
    if run <= 0:
        return "completed", checks, alerts
    while True:
        at += min(interval, most - at)
        alerts.append(at)
        if at >= most:
            return "timeout", checks, alerts
        checks += 1
        if run <= at:
            return "completed", checks, alerts


@pytest.mark.parametrize("interval,most", [(1, 1), (4, 10), (5, 10), (7, 3), (3, 20)])
def test_alerts_match_the_steps(spark, interval, most):
    runs = spark.range(0, 30).selectExpr("id as run_id", "id as run_s")
    outcome = {r.run_id: r for r in ledger.alert_outcome(runs, interval, most).collect()}
    events = {}
    for r in ledger.alert_events(runs, interval, most).collect():
        events.setdefault(r.run_id, []).append(r.alert_at_s)
    for run in range(30):
        kind, checks, alerts = watched(run, interval, most)
        assert (outcome[run].outcome, outcome[run].checks, outcome[run].alerts) == (kind, checks, len(alerts))
        assert sorted(events.get(run, [])) == alerts


def test_log_lines_with_hard_text(spark):
    rows = [("INFO", "main", "lg", "fn", "a | b: c | ctx={}", '{"user_message":"x | y"}'), ("ERROR", "w 1", "l.g", "<module>", "", "{}")]
    df = spark.createDataFrame(rows, "level string, thread string, logger string, function string, message string, c string"
                               ).withColumn("ts", clock.instant(datetime(2025, 1, 2, 3, 4, 5)))
    lines = logs.format_log_lines(df, "ts", "c").select(F.col("line").alias("value"))
    got = logs.parse_log_lines(lines)
    assert values(got, "level", "thread", "logger", "function", "message") == [r[:5] for r in rows]
    assert {r.ts_utc for r in got.collect()} == {datetime(2025, 1, 2, 3, 4, 5)}
    assert logs.unparsed_lines(spark.createDataFrame([("free text",), (None,)], "value string")).count() == 2


def test_record_policies(spark):
    def half(record):
        if record["id"] % 2:
            raise ValueError("odd")
        return {"h": record["id"] // 2}

    df = spark.range(6)
    assert sorted(values(records.map_records(df, half, "h long", "skip"))) == [(0,), (1,), (2,)]
    collected = sorted(values(records.map_records(df, half, "h long", "collect")), key=str)
    assert len(collected) == 6 and (None, False, "ValueError: odd") in collected
    with pytest.raises(Exception, match="odd"):
        records.map_records(df, half, "h long").collect()
    with pytest.raises(ValueError):
        records.map_records(df, half, "h long", "ignore")


def test_records_keep_nulls_and_large_numbers(spark):
    big = 2**62 + 1
    df = spark.createDataFrame([(big, None), (None, 2)], "a long, b int")
    got = records.map_records(df, lambda r: {"a": r["a"], "missing": r["b"] is None}, "a long, missing boolean")
    assert sorted(values(got), key=str) == sorted([(big, True), (None, False)], key=str)


def test_no_rows_are_dropped_unasked(spark):
    spark.range(3000).selectExpr("id as c1").createOrReplaceTempView("edge_long")
    assert extract.query_rows(spark, "edge_long", {}).count() == 3000
    with pytest.raises(ValueError):
        extract.query_rows(spark, "edge_long", {}, limit=5)
    assert rollups.nested_terms(spark.range(3000).selectExpr("id as d"), ["d"]).count() == 3000
    spread = spark.range(2000).selectExpr("case when id < 1000 then 'x' else repeat('x', 999) end as t").coalesce(1)
    assert rollups.rows_per_part(spread, 100_000, F.col("t")).first()["rows_per_part"] == 200


def test_terms_on_an_array(spark):
    df = spark.createDataFrame([(1, ["a", "b"]), (2, ["c"]), (3, None), (4, [None])], "k int, owner_mgr_chain array<string>")
    assert values(filters.filter_terms(df, {"owner_mgr_chain": ["b", "z"]}, {"owner_mgr_chain"}), "k") == [(1,)]


def test_naive_iso_text_needs_a_zone(spark):
    texts_in = ["2025-10-14T14:33:21", "2025-10-14 14:33:21.250", "2025-10-14T14:33:21.250000", "2025-10-14T14:33", "2025-10-14T14:33:21Z"]
    df = spark.createDataFrame([(t,) for t in texts_in], "s string")
    day = datetime(2025, 10, 14)
    got = values(df.select(clock.parse_utc(F.col("s"), assume_zone="Asia/Kolkata")))
    assert got == [(day.replace(hour=9, minute=3, second=21),), (day.replace(hour=9, minute=3, second=21, microsecond=250_000),),
                   (day.replace(hour=9, minute=3, second=21, microsecond=250_000),), (None,), (day.replace(hour=14, minute=33, second=21),)]
    assert values(df.select(clock.parse_utc(F.col("s"))))[:4] == [(None,)] * 4


@pytest.mark.parametrize("policy", ["collect", "skip"])
def test_bad_outputs_follow_the_policy(spark, policy):
    outputs = [{"a": 1}, None, {"a": "no number"}, {"a": 2}]
    df = spark.createDataFrame([(i,) for i in range(4)], "i int").coalesce(1)
    got = records.map_records(df, lambda r: outputs[r["i"]], "a int", policy).collect()
    assert [r.a for r in got if r.a] == [1, 2]
    if policy == "collect":
        assert [r.ok for r in got] == [True, False, False, True] and got[1].error.startswith("TypeError")


def test_whole_batches(spark):
    import pyarrow.compute as pc

    got = records.map_record_batches(spark.range(5), lambda b: b.append_column("twice", pc.multiply(b["id"], 2)), "twice long, id long")
    assert sorted(values(got)) == [(2 * i, i) for i in range(5)]


def test_very_many_loose_links_in_one_result(spark):
    body = "[" + ",".join(f'{{"a":"http://h/{i % 30_000}"}}' for i in range(60_000)) + ',{"urls":["http://h/1","http://h/1"]}]'
    df = spark.createDataFrame([(1, body)], "src int, body string")
    assert links.extract_links(df, "src", "body").count() == 30_002


def test_addresses_with_odd_signs(spark):
    urls = ["http://h/a b|c{d}.csv?x", "ftp://h", "http://h/x/", "no address", None]
    df = spark.createDataFrame([(u,) for u in urls], "u string")
    assert values(df.select(texts.url_base_name(F.col("u")))) == [("a b|c{d}.csv",), ("h",), ("h",), (None,), (None,)]


def test_loading_over_a_partial_target_doubles_nothing(spark):
    t = datetime(2025, 1, 1)
    pending = spark.createDataFrame([(1, True), (2, True)], "record_id long, audit_enabled boolean").withColumn("status", F.lit("pending"))
    source = spark.createDataFrame([(1, i) for i in range(5)] + [(2, i) for i in range(3)], "record_id long, seq int")
    target = source.filter("record_id = 2 or seq < 2")
    judged = ledger.classify_processed(pending, ledger.reconcile_counts(source, target), t)
    todo = judged.filter("action <> 'completed'").select("record_id")
    loaded = ledger.clean_target(target, judged).unionByName(source.join(todo, "record_id", "left_semi"))
    assert sorted(values(loaded)) == sorted(values(source))


def test_counts_by_window(spark):
    t = datetime(2025, 1, 1)
    records_in = [(1, t, t + timedelta(hours=6)), (2, t + timedelta(hours=6), t + timedelta(days=2)), (3, t + timedelta(days=9), t + timedelta(days=10)), (4, t, t)]
    windows_in = spark.createDataFrame(records_in, "record_id long, window_start timestamp_ntz, window_end timestamp_ntz")
    source = spark.createDataFrame([(t + timedelta(hours=h),) for h in (-1, 0, 5, 6, 30, 48)], "ts timestamp_ntz")
    got = ledger.reconcile_windows(source, source.filter(F.col("ts") > t), windows_in, "ts")
    assert sorted(values(got)) == [(1, 2, 1, False), (2, 2, 2, True), (3, 0, 0, True), (4, 0, 0, True)]
    assert ledger.reconcile_windows(source, source, windows_in.limit(0), "ts").count() == 0


def test_paged_tasks_are_bounded():
    from tidemark.sources.paged import paged_source

    source = paged_source(lambda: (0, 10**12), None, "k bigint")(options={"pagesize": "1000"})
    ranges = source.reader(None).partitions()
    assert len(ranges) <= 10_000 and ranges[0].low == 0 and ranges[-1].high == 10**12
    assert all(a.high == b.low for a, b in zip(ranges, ranges[1:]))
