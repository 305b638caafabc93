"""Ledger-driven loads: recover, check, pick, extract, write, reconcile, complete."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import clock
from tidemark.operators import ledger as led
from tidemark.operators.intervals import count_in_windows, join_windows
from tidemark.operators.ordered import small_side
from tidemark.operators.parts import assign_parts
from tidemark.session import cut_lineage
from tidemark.sinks import keyed
from tidemark.sinks.export import PART_BYTES, write_line_parts


@dataclass(frozen=True)
class LoadRules:
    """Which windows may run, when a record counts as stuck, and how a load is cut."""

    now: datetime
    max_age: timedelta
    accessible_from: datetime
    stuck_after: timedelta
    batch: int
    part_bytes: int = PART_BYTES


def extract_records(source: DataFrame, batch: DataFrame, key: str = led.KEY) -> DataFrame:
    """Source rows of all picked records in one join, instead of one read per record."""
    return source.join(small_side(batch.select(key)), key, "left_semi")


def record_lines(rows: DataFrame, key: str = led.KEY, order: tuple[str, ...] = ()) -> DataFrame:
    """NDJSON line and its size in bytes, newline included, per row; ``order`` columns are kept beside it."""
    line = F.to_json(F.struct(*rows.columns), {"ignoreNullFields": "false"})
    return rows.select(key, *order, line.alias("line")).withColumn("bytes", (F.octet_length("line") + 1).cast("bigint"))


def check_ledger(ledger: DataFrame, source: DataFrame, target: DataFrame, rules: LoadRules) -> DataFrame:
    """The ledger with stuck records reset, impossible windows failed, and finished records completed.

    What is still pending afterwards needs work. Only rows of records that can run are counted.
    """
    recovered = led.recover(ledger, rules.now, rules.stuck_after)
    tested = led.classify_window(recovered, rules.now, rules.max_age, rules.accessible_from)
    open_keys = small_side(tested.filter(F.col("status") == "pending").select(led.KEY))
    counts = led.reconcile_counts(*[rows.join(open_keys, led.KEY, "left_semi") for rows in (source, target)])
    return led.settle(recovered, counts, rules.now, rules.max_age, rules.accessible_from)


def load_batch(ledger: DataFrame, source: DataFrame, target: DataFrame, order: tuple[str, ...], path: str,
               rules: LoadRules) -> DataFrame:
    """Load the first pending records into ``path`` as capped NDJSON parts; return the new ledger.

    ``path`` is a new folder for this batch alone, so an earlier load that failed cannot mix with it.
    The picked keys are fixed by a checkpoint before the load, so the rows written and the records
    completed are the same ones. A record is completed only when what can be read back equals its
    source; otherwise it stays pending for a later batch.
    """
    checked = cut_lineage(check_ledger(ledger, source, target, rules))
    batch = cut_lineage(led.pick_pending(checked, rules.batch).select(led.KEY))
    rows = extract_records(source, batch)
    lines = record_lines(rows, order=order)
    write_line_parts(assign_parts(lines, led.KEY, list(order), "bytes", rules.part_bytes), path, led.KEY)
    key_type = ledger.schema[led.KEY].dataType.simpleString()
    loaded = ledger.sparkSession.read.schema(f"value string, {led.KEY} {key_type}, part bigint").text(path)
    proof = led.reconcile_counts(rows.select(led.KEY), loaded.select(led.KEY), windows=batch).filter("equal")
    proof = proof.select(led.KEY, F.col("source_count").alias("_loaded"))
    done = F.col("_loaded").isNotNull()
    return checked.join(small_side(proof), led.KEY, "left").withColumns({
        "status": F.when(done, "completed").otherwise(F.col("status")),
        "source_count": F.coalesce("_loaded", "source_count"),
        "target_count": F.coalesce("_loaded", "target_count"),
        "completed_at": F.when(done, clock.instant(rules.now)).otherwise(F.col("completed_at")),
    }).drop("_loaded")


def load_windows(ledger: DataFrame, source: DataFrame, ts: str, root: str, rules: LoadRules, buckets: int = keyed.BUCKETS) -> DataFrame:
    """Load the windows of the first records that need it into the stored table at ``root``; return the new ledger.

    The source knows no records: its rows belong to every record whose window holds them. The table has them
    with the record's key. Counting reads the source's times within the pending windows, and of the table the
    buckets of pending records. Records whose counts agree are completed. The first others are loaded: what the
    table holds of them is cleared and their rows are added in one published step, so a load that died half way
    doubles nothing. A record is completed when what is stored then equals its window in the source.
    """
    key = led.KEY
    recovered = led.recover(ledger, rules.now, rules.stuck_after)
    tested = cut_lineage(led.classify_window(recovered, rules.now, rules.max_age, rules.accessible_from))
    pending = tested.filter(F.col("status") == "pending")
    schema = T.StructType([*source.schema.fields, tested.schema[key]])
    there = count_in_windows(source, ts, pending, key, {"source_count": F.lit(1)})
    while True:
        stored = keyed.rows_of_keys(pending, root, schema, key, buckets).groupBy(key).agg(F.count(F.lit(1)).alias("target_count"))
        judged = cut_lineage(led.classify_processed(pending, there.join(stored, key, "left"), rules.now))
        batch = judged.filter(F.col("action") != "completed").orderBy("window_start", key).limit(rules.batch)
        batch = cut_lineage(batch.select(key, "window_start", "window_end"))
        rows = join_windows(source, ts, batch, key)
        if keyed.replace_keys(batch, rows, root, key, buckets):
            break
    loaded = keyed.rows_of_keys(batch, root, schema, key, buckets).groupBy(key).agg(F.count(F.lit(1)).alias("_stored"))
    proof = batch.select(key).join(loaded, key, "left").join(there.withColumnRenamed("source_count", "_source"), key)
    proof = proof.select(key, "_source", F.coalesce("_stored", F.lit(0)).alias("_stored")).filter("_source = _stored")
    found = judged.filter(F.col("action") == "completed").select(key, F.col("source_count").alias("_source"), F.col("target_count").alias("_stored"))
    done = small_side(proof.unionByName(found))
    completed = F.col("_stored").isNotNull()
    return tested.join(done, key, "left").withColumns({
        "status": F.when(completed, "completed").otherwise(F.col("status")),
        "source_count": F.col("_source"), "target_count": F.col("_stored"),
        "completed_at": F.when(completed, clock.instant(rules.now)),
    }).drop("_source", "_stored")
