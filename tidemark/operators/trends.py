"""Fleet statistics per trend window."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.rollups import nested_stats
from tidemark.operators.windows import in_trend_window, trend_labels


def trend(df: DataFrame, ts: str, zone: str, start, end, stats, dims=(), days: int = 1,
          bucket_size: int | None = None) -> DataFrame:
    """``stats(df, dims)`` per window of ``days`` local days, named by the window's last date.

    The window is one more group key, so the whole span is one scan and one aggregation; a unit's
    latest row is taken inside each window. Without ``dims``, windows lacking rows appear with 0.
    With ``bucket_size`` each window keeps only its largest buckets of each dimension.
    """
    dims = list(dims)
    rows = in_trend_window(df, ts, zone, start, end, days)
    if dims and bucket_size:
        return nested_stats(rows, dims, stats, bucket_size, ("trend_day",))
    result = stats(rows, ["trend_day", *dims])
    if dims:
        return result
    every = trend_labels(df.sparkSession, zone, start, end, days)
    joined = every.join(result, "trend_day", "left")
    zero = [c for c in result.columns if c not in ("trend_day", "efficiency")]
    return joined.withColumns({c: F.coalesce(c, F.lit(0).cast(result.schema[c].dataType)) for c in zero})
