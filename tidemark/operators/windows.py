"""Time windows: local days, trend windows, fixed slices, requested windows."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import clock


def day_windows(spark: SparkSession, zone: str, first: date, last: date) -> DataFrame:
    """One row per local day ``first..last`` with its UTC bounds; a DST day has 23 or 25 hours."""
    day = F.explode(F.sequence(F.lit(first), F.lit(last))).alias("target_day")
    return spark.range(1).select(day).select(
        "target_day",
        clock.to_utc(F.col("target_day"), zone).alias("start_utc"),
        clock.to_utc(F.date_add("target_day", 1), zone).alias("end_utc"),
    )


def recent_day_windows(spark: SparkSession, zone: str, today: date, back_start: int = 8, back_end: int = 1) -> DataFrame:
    """The default request: days T-8 up to, but without, T-1."""
    return day_windows(spark, zone, today - timedelta(days=back_start), today - timedelta(days=back_end + 1))


def daily_counts(df: DataFrame, ts: str, zone: str, first: date, last: date) -> DataFrame:
    """Rows per local day, 0 for days without rows.

    One scan: the UTC bounds of the whole span reach the file scan, rows are counted per local
    date before the shuffle, and only the day list (one row per day) is joined.
    """
    start = clock.instant(clock.local_midnight_utc(first, zone))
    end = clock.instant(clock.local_midnight_utc(last + timedelta(days=1), zone))
    counts = (
        df.filter(clock.within(F.col(ts), start, end))
        .groupBy(clock.local_date(F.col(ts), zone).alias("target_day"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    days = day_windows(df.sparkSession, zone, first, last).select("target_day")
    return (
        days.join(counts, "target_day", "left")
        .select("target_day", F.coalesce("n", F.lit(0)).cast("bigint").alias("row_count"))
        .orderBy("target_day")
    )


def trend_windows(requests: DataFrame, days: int = 1, start: str = "start_ts", end: str = "end_ts") -> DataFrame:
    """Calendar-aligned windows of ``days`` days over each request's ``[start, end)``.

    The first window begins at ``start`` itself, later ones at midnight; the last is cut at ``end``.
    """
    cuts = F.sequence(
        F.date_trunc("day", F.col(start)).cast("timestamp_ntz"),
        F.col(end).cast("timestamp_ntz"),
        F.expr(f"interval {int(days)} days"),
    )
    rows = requests.filter(F.col(start) < F.col(end)).select("*", F.posexplode(cuts).alias("window_no", "cut"))
    opened = F.greatest(F.col("cut"), clock.naive(F.col(start)))
    closed = F.least(F.col("cut") + F.expr(f"interval {int(days)} days"), clock.naive(F.col(end)))
    return (
        rows.withColumn("window_start", opened)
        .withColumn("window_end", closed)
        .filter(F.col("window_start") < F.col("window_end"))
        .drop("cut")
    )


def trend_label(window_end: Column) -> Column:
    """Date of the last instant inside a half-open window, which names the window."""
    return F.to_date(window_end - F.expr("interval 1 microsecond"))


def in_trend_window(df: DataFrame, ts: str, zone: str, start, end, days: int = 1, name: str = "trend_day") -> DataFrame:
    """Keep rows of ``[start, end)`` and add the label of the N-day local window each falls in.

    The window comes from day arithmetic on the row itself: no join and one scan for all windows.
    """
    opened, closed = clock.instant(start), clock.instant(end)
    first = clock.local_date(opened, zone)
    number = F.floor(F.datediff(clock.local_date(F.col(ts), zone), first) / days).cast("int")
    last_day = F.to_date(clock.to_local(closed, zone) - F.expr("interval 1 microsecond"))
    label = F.least(F.date_add(first, (number + 1) * days - 1), last_day)
    return df.filter(clock.within(F.col(ts), opened, closed)).withColumn(name, label)


def trend_labels(spark: SparkSession, zone: str, start, end, days: int = 1, name: str = "trend_day") -> DataFrame:
    """Every window label of the span, also of windows without rows."""
    request = spark.range(1).select(
        clock.to_local(clock.instant(start), zone).alias("start_ts"),
        clock.to_local(clock.instant(end), zone).alias("end_ts"),
    )
    return trend_windows(request, days).select(trend_label(F.col("window_end")).alias(name))


def bucket_minutes(df: DataFrame, ts: str, minutes: int = 5, name: str = "bucket_start") -> DataFrame:
    """Add the start of the fixed half-open slice of ``minutes`` each row falls in."""
    slot = F.window(F.col(ts), f"{int(minutes)} minutes").getField("start")
    return df.withColumn("_slot", slot).withColumnRenamed("_slot", name)


def count_buckets(df: DataFrame, ts: str, minutes: int = 5) -> DataFrame:
    return bucket_minutes(df, ts, minutes).groupBy("bucket_start").agg(F.count(F.lit(1)).alias("n"))


def iso_weeks(df: DataFrame, day: str) -> DataFrame:
    """Add ISO year, ISO week and the week's folder."""
    return df.withColumns({
        "iso_year": clock.iso_year(F.col(day)),
        "iso_week": clock.iso_week(F.col(day)),
        "week_folder": clock.week_folder(F.col(day)),
    })


def resolve_windows(df: DataFrame, now, start: str = "start_ts", end: str = "end_ts", duration: str = "duration_s") -> DataFrame:
    """Fill a window from any of start, end and duration; flag it when start is not before end.

    An end without a start counts only when there is no duration either to override it, which then
    means the last hour before ``now``.
    """
    moment = clock.instant(now)
    opened, closed = clock.naive(F.col(start)), clock.naive(F.col(end))
    span = F.make_dt_interval(secs=F.col(duration).cast("decimal(18,6)"))
    hour = F.expr("interval 1 hour")
    has_start, has_end, has_span = (F.col(c).isNotNull() for c in (start, end, duration))
    return df.withColumn(
        "window_start",
        F.when(has_start, opened).when(has_span, moment - span).otherwise(moment - hour),
    ).withColumn(
        "window_end",
        F.when(has_start & has_end, closed).when(has_start & has_span, opened + span).otherwise(moment),
    ).withColumn("valid", F.col("window_start") < F.col("window_end"))


def parse_times(df: DataFrame, column: str, formats=clock.WORKSHEET_FORMATS, assume_zone: str | None = None) -> DataFrame:
    """Add ``<column>_utc`` and whether a non-null text could be read."""
    parsed = f"{column}_utc"
    return df.withColumn(parsed, clock.parse_utc(F.col(column), formats, assume_zone)).withColumn(
        f"{column}_ok", F.col(parsed).isNotNull() | F.col(column).isNull()
    )


def age_seconds(df: DataFrame, later, earlier: str) -> DataFrame:
    """Add whole seconds from ``earlier`` to ``later``, a column name or a fixed instant."""
    until = F.col(later) if isinstance(later, str) and later in df.columns else clock.instant(later)
    return df.withColumn("age_s", clock.seconds_between(until, F.col(earlier)))


def shift_seconds(df: DataFrame, ts: str, seconds: int | str, zone: str) -> DataFrame:
    """Add the ISO text, in ``zone``, of the instant ``seconds`` before ``ts``."""
    amount = F.col(seconds) if isinstance(seconds, str) else F.lit(int(seconds))
    earlier = clock.naive(F.col(ts)) - F.make_dt_interval(secs=amount.cast("decimal(18,6)"))
    return df.withColumn("shifted", clock.iso_text(earlier, zone))


# The zones every log line is stamped in.
LOG_ZONES = ("UTC", "America/Los_Angeles", "Asia/Kolkata")


def render_zones(df: DataFrame, ts: str, zones=LOG_ZONES) -> DataFrame:
    """Add one ISO text column per zone, named after the zone's last part."""
    return df.withColumns({
        f"at_{zone.split('/')[-1].lower()}": clock.iso_text(F.col(ts), zone) for zone in zones
    })


def duration_seconds(df: DataFrame, column: str, name: str = "duration_s") -> DataFrame:
    return df.withColumn(name, clock.duration_s(F.col(column)))
