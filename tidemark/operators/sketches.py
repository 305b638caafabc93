"""Distinct counts over many days from what is stored once per day.

A day's rows are reduced to its distinct units per group. Each group keeps a sketch of them, and the units
themselves as long as they are few. A window of days unions the sketches; where all its days kept their units and
the estimate says that the window has few, they are counted exactly instead. Raw rows are read once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import clock
from tidemark.operators.ordered import null_safe_join
from tidemark.session import cut_lineage

#: Units up to which a group's count is exact, as the reports ask for.
EXACT_UNITS = 300_000
#: Binary logarithm of a sketch's registers: a standard error of 0.6 %.
REGISTERS = 15
#: How far above the exact limit an estimate may lie for units to be counted after all.
DOUBT = 1.05


def day_units(df: DataFrame, ts: str, zone: str, unit: str, dims: list[str]) -> DataFrame:
    """(day, dims, unit): the distinct units of each local day; rows without a unit or a time count nowhere."""
    named = df.select(clock.local_date(F.col(ts), zone).alias("day"), *dims, F.col(unit).alias("unit"))
    return named.filter("unit is not null and day is not null").distinct()


def store_days(df: DataFrame, path: str, ts: str, zone: str, unit: str, dims: list[str], mode: str = "errorifexists",
               exact_units: int = EXACT_UNITS) -> None:
    """Write ``days`` (day, dims, n, sketch) and ``units`` (day, dims, unit) of the rows' days below ``path``.

    Whole days only: append the days that are new. A group of a day keeps its units up to ``exact_units``.
    """
    units = cut_lineage(day_units(df, ts, zone, unit, dims))
    keys = ["day", *dims]
    # A sketch hashes texts and whole numbers; others go by their text.
    kind = units.schema["unit"].dataType.simpleString()
    value = F.col("unit") if kind in ("string", "binary", "int", "bigint") else F.col("unit").cast("string")
    days = cut_lineage(units.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.hll_sketch_agg(value, F.lit(REGISTERS)).alias("sketch")))
    days.write.mode(mode).parquet(f"{path}/days")
    few = days.filter(F.col("n") <= exact_units).select(*keys)
    null_safe_join(units, few, keys, "left_semi").write.mode(mode).parquet(f"{path}/units")


def window_distinct(spark: SparkSession, path: str, dims: list[str], days: int = 7, first=None, exact_units: int = EXACT_UNITS) -> DataFrame:
    """Distinct units per window of ``days`` stored days and group: window_day (its last), dims, n_distinct, exact.

    Windows begin at ``first``, by default the first stored day. Counts up to ``exact_units`` are exact; above,
    the union of the days' sketches is estimated.
    """
    stored, units = spark.read.parquet(f"{path}/days"), spark.read.parquet(f"{path}/units")
    first = first or stored.agg(F.min("day")).first()[0]
    if first is None:
        return spark.createDataFrame([], stored.select(F.col("day").alias("window_day"), *dims, F.col("n").alias("n_distinct")).withColumn("exact", F.lit(True)).schema)
    number = F.floor(F.datediff("day", F.lit(first)) / days).cast("int")
    window = F.date_add(F.lit(first), number * days + days - 1).alias("window_day")
    keys = ["window_day", *dims]
    shown = stored.filter(F.col("day") >= F.lit(first)).select(window, *dims, "n", "sketch")
    rough = cut_lineage(shown.groupBy(*keys).agg(F.max("n").alias("most"), F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("rough")))
    few = rough.filter((F.col("most") <= exact_units) & (F.col("rough") <= exact_units * DOUBT)).select(*keys)
    kept = null_safe_join(units.filter(F.col("day") >= F.lit(first)).select(window, *dims, "unit"), few, keys, "left_semi")
    counted = kept.distinct().groupBy(*keys).agg(F.count(F.lit(1)).alias("counted"))
    known = F.coalesce(F.col("counted") <= exact_units, F.lit(False))
    return null_safe_join(rough, counted, keys, "left").select(
        *keys, F.when(known, F.col("counted")).otherwise(F.col("rough")).alias("n_distinct"), known.alias("exact"))
