"""Fixed time slices of a stream that ends: every row is counted or listed, and nothing stays open.

A processor per slice keeps its count and a timer at its end. When the watermark passes that end the slice is
final; rows that come later for it are counted apart as late. A mark at the end of the stream moves the watermark
past everything, so the slices that are still open are flushed too.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime, timedelta, timezone

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

#: The state store that keeps timers.
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: The instant of an end mark: later than any row.
END = datetime(2200, 1, 1)
OUT = "bucket_start timestamp, n long, late boolean"


class SliceCounter(StatefulProcessor):
    """Counts the rows of one slice until its timer fires. Rows that come once the watermark has passed it are late."""

    def __init__(self, micros: int):
        self.micros = micros

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.count = handle.getValueState("count", "n long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        n, end = sum(len(part) for part in rows), (key[0] + self.micros) // 1000
        if timerValues.getCurrentWatermarkInMs() >= end:
            yield _rows(key[0], n, True)
        elif self.count.exists():
            self.count.update((self.count.get()[0] + n,))
        else:
            self.handle.registerTimer(end)
            self.count.update((n,))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        n = self.count.get()[0]
        self.count.clear()
        yield _rows(key[0], n, False)

    def close(self) -> None:
        pass


def _rows(slot: int, n: int, late: bool) -> pd.DataFrame:
    at = datetime.fromtimestamp(0, timezone.utc).replace(tzinfo=None) + timedelta(microseconds=slot)
    return pd.DataFrame({"bucket_start": [at], "n": [n], "late": [late]})


def finished_slices(stream: DataFrame, ts: str, minutes: int = 5, lateness: str = "10 minutes") -> DataFrame:
    """Counts of a stream per slice: bucket_start, n, late. Rows at END are marks and belong to no slice.

    A slice has one row that is not late, when it is final, and one for every step that brought late rows.
    """
    micros = minutes * 60_000_000
    at: Column = F.unix_micros(F.col(ts).cast("timestamp"))
    known = stream.filter(F.col(ts).isNotNull())
    timed = known.select(F.col(ts).cast("timestamp").alias("_ts"), (at - F.pmod(at, F.lit(micros))).alias("slot")).withWatermark("_ts", lateness)
    # Without the watched column, so that rows behind the watermark reach the processor, which lists them.
    counted = timed.select("slot").groupBy("slot").transformWithStateInPandas(SliceCounter(micros), OUT, "append", "eventTime")
    return counted.filter(F.col("bucket_start") < F.lit(END).cast("timestamp"))


def drain_to_end(slices: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Process all there is, its end mark included, into parquet, and stop."""
    query = slices.writeStream.format("parquet").outputMode("append").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def use_timers(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
