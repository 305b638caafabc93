"""Time-bounded reads of a database table."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import clock
from tidemark.sources.extract import checked_column, checked_table


def window_options(url: str, table: str, ts: str, start, end, parts: int, fetch_rows: int = 10_000) -> dict[str, str]:
    """Reader options that split the window into ``parts`` ranges of ``ts``, one query each."""
    def text(value: datetime) -> str:
        return value.strftime("%Y-%m-%d %H:%M:%S.%f")

    return {
        "url": url,
        "dbtable": checked_table(table),
        "partitionColumn": checked_column(ts),
        "lowerBound": text(clock.utc_naive(start)),
        "upperBound": text(clock.utc_naive(end)),
        "numPartitions": str(int(parts)),
        "fetchsize": str(int(fetch_rows)),
    }


def jdbc_window(spark: SparkSession, url: str, table: str, ts: str, start, end, parts: int = 8, closed: str = "both", **options) -> DataFrame:
    """Rows with ``start <= ts <= end``, or ``ts < end`` with ``closed="left"``; the filter is pushed into each range's query.

    The split only spreads the work: the filter alone decides which rows come back.
    """
    reader = spark.read.format("jdbc").options(**window_options(url, table, ts, start, end, parts), **options)
    df = reader.load()
    kind = df.schema[ts].dataType
    first, last = (F.lit(clock.utc_naive(v)).cast(kind) for v in (start, end))
    return df.filter(clock.within(F.col(ts), first, last, closed))
