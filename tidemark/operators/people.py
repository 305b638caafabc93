"""Reporting lines: direct reports and per-report roll-ups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.ordered import small_side
from tidemark.operators.rollups import UnitStats


def direct_reports(users: DataFrame, execs: DataFrame) -> DataFrame:
    """(exec_id, user_id) of active users whose manager is the exec.

    No broadcast hint: adaptive execution broadcasts the exec list when its measured size allows.
    """
    active = users.filter(F.col("status") == "Active").select("user_id", F.col("manager").alias("exec_id"))
    return active.join(execs.select("exec_id"), "exec_id").select("exec_id", "user_id")


def exec_targets(users: DataFrame, execs: DataFrame) -> DataFrame:
    """Who to report on: each exec's direct reports, or the exec when there are none."""
    reports = direct_reports(users, execs)
    return execs.select("exec_id").join(reports, "exec_id", "left").select(
        "exec_id",
        F.coalesce(F.col("user_id"), F.col("exec_id")).alias("person"),
        F.col("user_id").isNotNull().alias("has_reports"),
    )


def rows_per_person(df: DataFrame, owner: str = "pri_owner", chain: str = "owner_mgr_chain") -> DataFrame:
    """One row per (row, person concerned): each person once, whether owner, in the chain, or both."""
    people = F.array_except(
        F.array_union(F.coalesce(F.col(chain), F.array().cast(df.schema[chain].dataType)), F.array(F.col(owner))),
        F.array(F.lit(None).cast(df.schema[owner].dataType)),
    )
    return df.withColumn("person", F.explode(people)).withColumn(
        "is_owner", F.coalesce(F.col("person") == F.col(owner), F.lit(False))
    )


def exec_rollup(inventory: DataFrame, users: DataFrame, execs: DataFrame, stats, dims: tuple[str, ...] = (),
                owner: str = "pri_owner", chain: str = "owner_mgr_chain") -> DataFrame:
    """``stats`` per (exec, report) and ``dims`` over rows with the report as owner or in the chain.

    An exec without reports gets the rows it owns. The either-or match is one equi join on the
    person: each row lists its people without repeats, so nothing has to be deduplicated after.
    Statistics that can be merged (``UnitStats``) are first taken per distinct owner, chain and unit, so what is
    listed by person follows the distinct chains and not the inventory's rows. Someone high up is in
    every chain; a counted, small target list is broadcast, so the listed rows are not shuffled by
    person, and adaptive execution splits such a person otherwise.
    """
    targets, keys = small_side(exec_targets(users, execs)), ["exec_id", "person", *dims]
    mergeable = isinstance(stats, UnitStats)
    rows = stats.partials(inventory, [owner, chain, *dims]) if mergeable else inventory
    wanted = rows_per_person(rows, owner, chain).join(targets, "person")
    wanted = wanted.filter(F.col("has_reports") | F.col("is_owner"))
    return stats.finish(stats.merge(wanted, keys), keys) if mergeable else stats(wanted, keys)
