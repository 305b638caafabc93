"""The work ledger: one row per window to load, with status, stages and counts."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import clock
from tidemark.operators.intervals import count_in_windows, join_windows
from tidemark.operators.ordered import small_side

# Stages in flow order, and the ledger's columns.
STAGES = ("export", "transfer", "audit")
KEY = "record_id"


def pick_pending(ledger: DataFrame, n: int) -> DataFrame:
    """The first ``n`` pending records, oldest window first; planned as a top-n."""
    return ledger.filter(F.col("status") == "pending").orderBy("window_start", KEY).limit(n)


def window_verdict(now, max_age: timedelta, accessible_from) -> Column:
    """Failure reason of a window, or null when it may run; the time range is tested first."""
    moment = clock.instant(now)
    oldest = clock.instant(clock.utc_naive(now) - max_age)
    in_range = (F.col("window_start") >= oldest) & (F.col("window_end") <= moment)
    return (
        F.when(~in_range | in_range.isNull(), "window_outside_range")
        .when(F.col("window_start") < clock.instant(accessible_from), "history_not_accessible")
    )


def classify_window(ledger: DataFrame, now, max_age: timedelta, accessible_from) -> DataFrame:
    """Pending records whose window cannot run become ``failed_permanently``, each with its reason."""
    reason = F.when(F.col("status") == "pending", window_verdict(now, max_age, accessible_from))
    return ledger.withColumn("reason", reason).withColumn(
        "status", F.when(F.col("reason").isNotNull(), "failed_permanently").otherwise(F.col("status"))
    )


def reconcile_counts(source: DataFrame, target: DataFrame, key: str = KEY, windows: DataFrame | None = None) -> DataFrame:
    """Rows per key on both sides, and whether they agree; a key missing on a side counts 0.

    Both sides are stacked and counted in one aggregation, reduced before its only shuffle.
    ``windows`` fixes the keys to report, also those on neither side.
    """
    tagged = source.select(key, F.lit(1).alias("_s"), F.lit(0).alias("_t")).unionAll(
        target.select(key, F.lit(0).alias("_s"), F.lit(1).alias("_t"))
    )
    counts = tagged.groupBy(key).agg(F.sum("_s").alias("source_count"), F.sum("_t").alias("target_count"))
    if windows is not None:
        counts = windows.select(key).join(counts, key, "left")
    return counts.select(
        key,
        F.coalesce("source_count", F.lit(0)).cast("bigint").alias("source_count"),
        F.coalesce("target_count", F.lit(0)).cast("bigint").alias("target_count"),
    ).withColumn("equal", F.col("source_count") == F.col("target_count"))


def with_record(rows: DataFrame, records: DataFrame, ts: str, key: str = KEY, closed: str = "left") -> DataFrame:
    """Rows of a table that knows no records, each with the record in whose window its time lies.

    A row in two windows appears twice; rows outside the span of all windows are filtered at the scan.
    """
    return join_windows(rows, ts, records, key, closed=closed)


def reconcile_windows(source: DataFrame, target: DataFrame, records: DataFrame, ts: str, key: str = KEY, closed: str = "left") -> DataFrame:
    """``reconcile_counts`` for tables without a record id: rows in each record's window, on both sides.

    Both sides go through one count over the time line, so windows may be short, many and overlapping.
    """
    sides = source.select(F.col(ts), F.lit(1).alias("_s"), F.lit(0).alias("_t")).unionAll(
        target.select(F.col(ts), F.lit(0).alias("_s"), F.lit(1).alias("_t")))
    counts = count_in_windows(sides, ts, records, key, {"source_count": F.col("_s"), "target_count": F.col("_t")}, closed=closed)
    return counts.withColumn("equal", F.col("source_count") == F.col("target_count"))


def clean_target(target: DataFrame, judged: DataFrame, key: str = KEY) -> DataFrame:
    """The target without the rows of records to ``clean_and_process``, so that loading them again doubles nothing."""
    dirty = judged.filter(F.col("action") == "clean_and_process").select(key)
    return target.join(small_side(dirty), key, "left_anti")


def classify_processed(records: DataFrame, counts: DataFrame, now) -> DataFrame:
    """Audited records whose counts agree are done and get counts and time; all others need work.

    ``action``: ``completed``, ``clean_and_process`` (counts differ) or ``process`` (not audited).
    """
    audited = F.coalesce(F.col("audit_enabled"), F.lit(False))
    both = records.join(counts.select(KEY, "source_count", "target_count"), KEY, "left").withColumns({
        "source_count": F.coalesce("source_count", F.lit(0)).cast("bigint"),
        "target_count": F.coalesce("target_count", F.lit(0)).cast("bigint"),
    })
    action = (
        F.when(~audited, "process")
        .when(F.col("source_count") == F.col("target_count"), "completed")
        .otherwise("clean_and_process")
    )
    done = F.col("action") == "completed"
    return both.withColumn("action", action).withColumns({
        "status": F.when(done, "completed").otherwise(F.col("status")),
        "source_count": F.when(done, F.col("source_count")),
        "target_count": F.when(done, F.col("target_count")),
        "completed_at": F.when(done, clock.instant(now)),
    })


def next_batch(ledger: DataFrame, counts: DataFrame, n: int, now, max_age: timedelta, accessible_from) -> DataFrame:
    """The first ``n`` pending records that can run and are not done yet; each appears once."""
    runnable = classify_window(ledger.filter(F.col("status") == "pending"), now, max_age, accessible_from)
    open_records = classify_processed(runnable.filter(F.col("status") == "pending"), counts, now)
    return open_records.filter(F.col("action") != "completed").orderBy("window_start", KEY).limit(n)


def settle(ledger: DataFrame, counts: DataFrame, now, max_age: timedelta, accessible_from) -> DataFrame:
    """The whole ledger after a check of its pending records: impossible ones failed, finished ones completed.

    Every record keeps its row, so the new status is computed in place: one join to the counts.
    """
    tested = classify_window(ledger, now, max_age, accessible_from)
    judged = classify_processed(tested.withColumn("_status", F.col("status")), counts, now)
    done = (F.col("_status") == "pending") & (F.col("action") == "completed")
    return judged.withColumns({
        "status": F.when(done, "completed").otherwise(F.col("_status")),
        "source_count": F.when(done, F.col("source_count")),
        "target_count": F.when(done, F.col("target_count")),
        "completed_at": F.when(done, F.col("completed_at")),
    }).select(*ledger.columns, "reason", "source_count", "target_count", "completed_at")


def stuck_stage(stages=STAGES) -> Column:
    """First stage, in flow order, that is not done; null when all are."""
    return F.coalesce(*[
        F.when(~F.col(f"stage_{s}").eqNullSafe("done"), F.lit(s)) for s in stages
    ])


def is_stuck(now, threshold: timedelta, since: str = "started_at") -> Column:
    """In progress for longer than ``threshold``, counted from when work began."""
    limit = clock.instant(clock.utc_naive(now) - threshold)
    return F.coalesce((F.col("status") == "in_progress") & (F.col(since) < limit), F.lit(False))


def find_stuck(ledger: DataFrame, now, threshold: timedelta, since: str = "started_at", stages=STAGES) -> DataFrame:
    """Stuck records, with the stage they stopped in."""
    return ledger.filter(is_stuck(now, threshold, since)).withColumn("stuck_stage", stuck_stage(stages))


def reset_stuck(ledger: DataFrame, stuck: DataFrame, stages=STAGES) -> DataFrame:
    """The ledger with the given stuck records pending again and only their stuck stage reopened."""
    fresh = stuck.withColumns({
        **{f"stage_{s}": F.when(F.col("stuck_stage") == s, F.lit("open")).otherwise(F.col(f"stage_{s}")) for s in stages},
        "status": F.lit("pending"),
    }).select(*ledger.columns)
    return upsert(ledger, fresh, KEY)


def recover(ledger: DataFrame, now, threshold: timedelta, since: str = "started_at", stages=STAGES) -> DataFrame:
    """Find and reset in one pass over the ledger, without a join."""
    marked = ledger.withColumn("_stuck", is_stuck(now, threshold, since)).withColumn("_stage", stuck_stage(stages))
    reopened = {
        f"stage_{s}": F.when(F.col("_stuck") & (F.col("_stage") == s), F.lit("open")).otherwise(F.col(f"stage_{s}"))
        for s in stages
    }
    status = F.when(F.col("_stuck"), F.lit("pending")).otherwise(F.col("status"))
    return marked.withColumns({**reopened, "status": status}).select(*ledger.columns)


def upsert(base: DataFrame, changes: DataFrame, key: str | list[str]) -> DataFrame:
    """``base`` with rows of equal key replaced by ``changes``, and new keys added."""
    keys = [key] if isinstance(key, str) else list(key)
    return base.join(changes.select(*keys), keys, "left_anti").unionByName(changes, allowMissingColumns=True)


def not_yet_loaded(candidates: DataFrame, loaded: DataFrame, week=("iso_year", "iso_week")) -> DataFrame:
    """Candidates of weeks that are not at the target yet; only the distinct weeks are joined."""
    weeks = small_side(loaded.select(*week).distinct())
    return candidates.join(weeks, list(week), "left_anti")


def alert_outcome(runs: DataFrame, interval_s: int, max_s: int, run_s: str = "run_s") -> DataFrame:
    """Outcome, number of checks and number of alerts of watching each run, in closed form."""
    if interval_s <= 0 or max_s <= 0:
        raise ValueError("interval_s and max_s must be positive")
    run, step, most = F.col(run_s).cast("bigint"), F.lit(int(interval_s)), -(-int(max_s) // int(interval_s))
    polls = F.ceil(run / step).cast("bigint")
    in_time = polls * step < F.lit(int(max_s))
    return runs.withColumns({
        "outcome": F.when((run <= 0) | in_time, "completed").otherwise("timeout"),
        "alerts": F.when(run <= 0, F.lit(0)).when(in_time, polls).otherwise(F.lit(most)).cast("bigint"),
        "checks": F.when(run <= 0, F.lit(1)).when(in_time, polls + 1).otherwise(F.lit(most)).cast("bigint"),
    })


def alert_events(runs: DataFrame, interval_s: int, max_s: int, run_s: str = "run_s") -> DataFrame:
    """One row per alert: every interval while the run lasts, the last one no later than ``max_s``."""
    numbered = alert_outcome(runs, interval_s, max_s, run_s).filter(F.col("alerts") > 0).withColumn(
        "alert_no", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("alerts")))
    )
    at = F.least(F.col("alert_no") * F.lit(int(interval_s)), F.lit(int(max_s)))
    return numbered.withColumn("alert_at_s", at.cast("bigint"))
