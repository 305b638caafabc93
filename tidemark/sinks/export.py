"""Writers. Files appear only when the whole job commits; the weeks of a load appear together (see ``publish``)."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import clock
from tidemark.operators.ordered import small_side
from tidemark.operators.windows import bucket_minutes
from tidemark.sinks import publish
from tidemark.sinks.capped import csv_lines, write_capped

PART_BYTES = 250 * 1024 * 1024
#: Twice as fast as the usual 6, at a few hundredths more bytes.
GZIP_LEVEL = 4
def write_ndjson(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One compact JSON object per line, nulls kept."""
    df.write.mode(mode).option("ignoreNullFields", "false").json(path)


def write_parquet_capped(df: DataFrame, path: str, max_bytes: int = PART_BYTES, mode: str = "errorifexists") -> None:
    """Snappy parquet files of at most ``max_bytes`` on disk (but for a single larger row); see ``capped``."""
    write_capped(df, path, "parquet", max_bytes, ".snappy.parquet", mode)


def write_csv_gz_parts(df: DataFrame, path: str, rows: int | None = None, max_bytes: int = PART_BYTES,
                       mode: str = "errorifexists") -> None:
    """Gzip CSV files of whole rows, each with one header line: at most ``rows`` of them, and ``max_bytes``
    before compression (but for a single larger row)."""
    lines, header = csv_lines(df)
    write_capped(lines, path, "lines", max_bytes, ".csv.gz", mode, rows, gzip="true", header=header, level=str(GZIP_LEVEL))


def split_csv(spark: SparkSession, path: str, out: str, rows: int | None = None, max_bytes: int = PART_BYTES,
              mode: str = "errorifexists", level: int = GZIP_LEVEL) -> None:
    """Cut the CSV files of ``path`` into gzip files of whole lines as they stand, each below one header line.

    Lines are not taken apart into columns, so a file's text comes out as it went in; a quoted value must not hold
    a line end. Every input file begins with the same header, which is checked; blank lines go.
    """
    header = spark.read.text(path).first()
    if header is None:
        raise ValueError(f"{path} has no header")
    whole = T.StructType([T.StructField(header.value, T.StringType())])
    # One column whose separator no text has: the reader only finds line ends, drops each file's header and checks it.
    lines = spark.read.schema(whole).options(header=True, enforceSchema=False, sep="\u0001", quote="", escape="").csv(path)
    ended = lines.select(F.concat(F.col(f"`{header.value}`"), F.lit("\n")).alias("line"))
    write_capped(ended, out, "lines", max_bytes, ".csv.gz", mode, rows, gzip="true", header=header.value + "\n", level=str(level))


def write_keyed_lines(parted: DataFrame, path: str, stream: str, line: str = "line", order: tuple[str, ...] = (), mode: str = "errorifexists") -> None:
    """Ready-made lines as one NDJSON file per (stream, part), as numbered by ``assign_parts``, with a manifest of them.

    A part's rows meet in one task, which their cap bounds, and keep ``order`` inside their file.
    """
    rows = parted.select(stream, "part", *order, F.concat(line, F.lit("\n")).alias("line"))
    met = rows.repartition(stream, "part").sortWithinPartitions(stream, "part", *order)
    write_capped(met.select(stream, "part", "line"), path, "lines", 1 << 62, ".json", mode, keys=2)


def write_details_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).options(header=True, escape='"').csv(path)


def write_part_files(parted: DataFrame, path: str, stream: str, mode: str = "errorifexists") -> None:
    """NDJSON with one directory per (stream, part), as numbered by ``assign_parts``.

    Parts are capped in size, so a part's rows can share a task even where one stream is huge.
    """
    by_part = parted.hint("rebalance", F.col(stream), F.col("part"))
    by_part.write.mode(mode).partitionBy(stream, "part").option("ignoreNullFields", "false").json(path)


def write_line_parts(parted: DataFrame, path: str, stream: str, line: str = "line", mode: str = "errorifexists") -> None:
    """Ready-made lines as text with one directory per (stream, part)."""
    rows = parted.select(stream, "part", line).hint("rebalance", F.col(stream), F.col("part"))
    rows.write.mode(mode).partitionBy(stream, "part").text(path)


def write_buckets(df: DataFrame, path: str, ts: str, minutes: int = 5, mode: str = "errorifexists") -> None:
    """NDJSON with one directory per time slice.

    The rebalance gathers a slice's rows into few files, yet splits a slice too big for one task.
    """
    sliced = bucket_minutes(df, ts, minutes, "slice")
    named = sliced.withColumn("bucket", F.date_format("slice", "yyyy-MM-dd_HH-mm")).drop("slice")
    named.hint("rebalance", F.col("bucket")).write.mode(mode).partitionBy("bucket").option(
        "ignoreNullFields", "false").json(path)


WEEK = ("iso_year", "iso_week")
_WEEKS = "iso_year int, iso_week int, rows bigint, finished_at timestamp"


def _weeks(spark: SparkSession, slices: list[publish.Slice]) -> DataFrame:
    rows = [(*(v for _, v in s.values), s.rows, datetime.fromisoformat(s.at)) for s in slices]
    return spark.createDataFrame(rows, _WEEKS.replace("timestamp", "timestamp_ntz")).withColumn("finished_at", F.col("finished_at").cast("timestamp"))


def finished_weeks(spark: SparkSession, root: str) -> DataFrame:
    """The published weeks, their rows and when they were published; none when nothing ever was."""
    return _weeks(spark, publish.current(spark, root).slices)


def read_weeks(spark: SparkSession, root: str, schema: str) -> DataFrame:
    """The rows of all published weeks; ``schema`` is that of the rows, without their week."""
    return publish.read_state(spark, root, f"{schema}, iso_year int, iso_week int")


def write_week_once(df: DataFrame, root: str, day: str, undated_path: str | None = None) -> DataFrame:
    """Publish the rows of every ISO week that is not published yet; return the weeks published now.

    All weeks of a run appear at once, when its version of the state does (see ``publish``). A run that
    fails deletes what it wrote; one that is killed leaves folders that no reader sees and ``sweep_runs``
    deletes. Where another run publishes first, the weeks are looked up again. They are counted over the
    day column alone; rows are then read once. Rows without a day belong to no week: each run puts them
    into a new folder below ``undated_path``, or is refused where none is given.
    """
    spark, known = df.sparkSession, F.col(day).isNotNull()
    if undated_path is None:
        checked = df.withColumn(day, F.when(known, F.col(day)).otherwise(F.raise_error(F.lit("row without a day"))))
    else:
        df.filter(~known).write.parquet(f"{undated_path}/{publish.new_run()}")
        checked = df.filter(known)
    dated = checked.withColumns({"iso_year": clock.iso_year(F.col(day)), "iso_week": clock.iso_week(F.col(day))})
    counts = {(("iso_year", r.iso_year), ("iso_week", r.iso_week)): r.n for r in dated.groupBy(*WEEK).agg(F.count(F.lit(1)).alias("n")).collect()}
    while True:
        base = publish.current(spark, root)
        new = {week: n for week, n in counts.items() if week not in base.by_value()}
        if not new:
            return _weeks(spark, [])
        run = publish.new_run()
        try:
            fresh = small_side(spark.createDataFrame([tuple(v for _, v in week) for week in new], "iso_year int, iso_week int"))
            seen = Observation()
            todo = dated.join(fresh, list(WEEK), "left_semi").observe(seen, F.count(F.lit(1)).alias("n"))
            publish.write_run(todo, root, list(WEEK), run)
            if seen.get["n"] != sum(new.values()):
                raise RuntimeError("the input changed while its weeks were written")
            at = publish.now_text()
            made = [publish.Slice(week, run, n, at) for week, n in sorted(new.items())]
            if publish.publish(spark, root, base, base.slices + made):
                return _weeks(spark, made)
        except Exception:
            publish.forget_run(spark, root, run, len(WEEK))
            raise
        publish.forget_run(spark, root, run, len(WEEK))


def manifest(df: DataFrame, started=None, finished=None) -> DataFrame:
    """Files behind a freshly read folder: path, bytes and rows; with the run's start and finish where they are given."""
    files = df.groupBy(
        F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_size").alias("bytes")
    ).agg(F.count(F.lit(1)).alias("rows"))
    times = {"started_at": started, "finished_at": finished}
    return files.withColumns({k: clock.instant(v) for k, v in times.items() if v is not None})
