"""Fixed time slices counted continuously."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.windows import count_buckets


def stream_buckets(stream: DataFrame, ts: str, minutes: int = 5, lateness: str = "10 minutes") -> DataFrame:
    """Rows per slice of a stream; a slice is final once the watermark has passed its end.

    State is one counter per open slice, whatever the rate of rows.
    """
    timed = stream.withColumn("_ts", F.col(ts).cast("timestamp")).withWatermark("_ts", lateness)
    counted = timed.groupBy(F.window("_ts", f"{int(minutes)} minutes").alias("_w")).agg(F.count(F.lit(1)).alias("n"))
    return counted.select(F.col("_w.start").cast("timestamp_ntz").alias("bucket_start"), "n")


def drain(buckets: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Process what is there now into parquet and stop; the checkpoint makes a rerun go on from there."""
    query = (
        buckets.writeStream.format("parquet").outputMode("append")
        .option("path", path).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return query


def dropped_rows(query: StreamingQuery) -> int:
    """Rows that came after the watermark had passed their slice, over the steps the query still reports."""
    return sum(s["numRowsDroppedByWatermark"] for p in query.recentProgress for s in p["stateOperators"])


def held_back(rows: DataFrame, ts: str, written: DataFrame, minutes: int = 5) -> DataFrame:
    """The slices of a source that has ended which its stream never wrote, since no later row moved the watermark."""
    counted = count_buckets(rows, ts, minutes).withColumn("bucket_start", F.col("bucket_start").cast("timestamp_ntz"))
    return counted.join(written.select("bucket_start"), "bucket_start", "left_anti").select("bucket_start", "n")
