"""Inventory predicates and per-kind column names."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# One concept has another column name in each inventory.
CONCEPTS = {
    "pri_owner": {"storage": "owner", "compute": "pri_owner"},
    "sec_owner": {"storage": "owner", "compute": "sec_owner"},
    "bg_code": {"storage": "bg_code", "compute": "bg_code"},
    "owner_vp": {"storage": "owner_vp", "compute": "owner_vp"},
    "owner_mgr": {"storage": "owner_manager", "compute": "owner_mgr"},
    "owner_mgr_chain": {"storage": "owner_mgr_chain", "compute": "owner_mgr_chain"},
    "mount_point": {"storage": "mount_point", "compute": "hostname"},
    "hostname": {"storage": "mount_point", "compute": "hostname"},
    "clust_vol_mount": {"storage": "clust_vol_mount", "compute": "clust_vol_mount"},
    "bu_code": {"storage": "bu_code", "compute": "bu_code"},
    "site": {"storage": "site", "compute": "site"},
    "farm": {"storage": "farm", "compute": "farm"},
    "service": {"storage": "service", "compute": "service"},
    "cpu_class": {"storage": "class", "compute": "cpu_class"},
    "cluster": {"storage": "cluster", "compute": "cluster"},
    "cpu": {"storage": "cpu_model", "compute": "cpu"},
    "server_category": {"storage": "category", "compute": "server_category"},
    "os_version": {"storage": "os_name", "compute": "os_version"},
    "status_name": {"storage": "state", "compute": "status_name"},
    "cpu_speed": {"storage": "cpu_speed", "compute": "cpu_speed"},
    "bu_project": {"storage": "bu_project", "compute": "bu_project"},
    "bu_product": {"storage": "bu_product", "compute": "bu_product"},
    "backup": {"storage": "backups", "compute": "backups"},
}

# Statistics carried by each inventory's detail rows.
STATS = {
    "compute": ("core_count", "ram", "total_runrate", "total_mins", "cpu_30d", "core_hours", "ram_hours"),
    "storage": ("totalsize", "usedsize", "disk_hours", "runrate", "total_mins", "used_pct"),
}

# Fields a caller may filter each inventory on.
FILTERABLE = {
    "compute": ("pri_owner", "bg_code", "owner_vp", "owner_manager", "owner_mgr_chain", "hostname",
                "owner_bu", "site", "farm", "service", "cpu_class"),
    "storage": ("owner", "bg_code", "owner_vp", "owner_manager", "owner_mgr_chain", "mount_point",
                "owner_bu", "site", "farm", "service", "class", "storage_type", "clust_vol_mount"),
}


def filter_terms(df: DataFrame, terms: dict[str, list], allowed, rename: dict[str, str] | None = None) -> DataFrame:
    """AND over fields of IN over values; fields outside ``allowed`` are ignored, as is an empty dict.

    An array matches when it holds any of the values.
    """
    rename = rename or {}
    tests = [holds_any(df, rename.get(f, f), v) for f, v in terms.items() if f in allowed]
    return df.filter(reduce(Column.__and__, tests)) if tests else df


def holds_any(df: DataFrame, column: str, values) -> Column:
    """True where the column, or an element of an array column, is one of the values; a null is none of them."""
    kind = df.schema[column].dataType
    if isinstance(kind, T.ArrayType):
        return F.coalesce(F.arrays_overlap(column, F.array(*[F.lit(v) for v in values]).cast(kind)), F.lit(False))
    return F.col(column).isin(list(values))


def filter_owner_or_chain(df: DataFrame, names: list[str], owner: str = "pri_owner", chain: str = "owner_mgr_chain") -> DataFrame:
    """Rows owned by one of ``names``, or with one of them anywhere in the management chain."""
    wanted = F.array(*[F.lit(n) for n in names])
    return df.filter(F.coalesce(F.arrays_overlap(chain, wanted), F.lit(False)) | F.col(owner).isin(list(names)))


def none_of(*tests: Column) -> Column:
    """True where no test is true; a test on a missing value counts as not true, so the row stays."""
    return ~reduce(Column.__or__, [F.coalesce(t, F.lit(False)) for t in tests])


def exclude(df: DataFrame, equals: dict[str, object] | None = None, like: dict[str, str] | None = None) -> DataFrame:
    """Drop rows equal to, or like, any of the given values; rows lacking the field are kept."""
    tests = [F.col(c) == F.lit(v) for c, v in (equals or {}).items()]
    tests += [F.col(c).like(p) for c, p in (like or {}).items()]
    return df.filter(none_of(*tests)) if tests else df


def status_test(kind: str, status: str) -> Column:
    """Production or Retired. Storage knows only 'offline': anything else, or nothing, is in production."""
    if status not in ("Production", "Retired"):
        raise ValueError(f"unknown status {status!r}")
    if kind == "compute":
        return F.col("status_name") == status
    offline = F.col("state") == "offline"
    return offline if status == "Retired" else none_of(offline)


def filter_status(df: DataFrame, kind: str, status: str) -> DataFrame:
    return df.filter(status_test(kind, status))


def project_fields(df: DataFrame, concepts: list[str], kind: str, ts: str = "ts", stats=None, names: dict[str, dict[str, str]] = CONCEPTS) -> DataFrame:
    """Time, the concepts under their common names, and the kind's statistics.

    ``names`` says which column holds a concept in each kind of inventory. A concept it does not list, or not
    for this kind, is read under its own name.
    """
    stats = STATS.get(kind, ()) if stats is None else stats
    return df.select(ts, *[F.col(names.get(c, {}).get(kind, c)).alias(c) for c in concepts], *stats)


# Log level ranks.
LEVEL_RANKS = {"DEBUG": 10, "INFO": 20, "WARNING": 30, "WARN": 30, "ERROR": 40, "CRITICAL": 50, "FATAL": 50}


def level_rank(level: Column) -> Column:
    """Rank of a level name in any letter case; an unknown name ranks as INFO."""
    ranks = F.create_map(*[F.lit(x) for pair in LEVEL_RANKS.items() for x in pair])
    return F.coalesce(F.try_element_at(ranks, F.upper(level)), F.lit(LEVEL_RANKS["INFO"]))


def filter_level(df: DataFrame, level: str, minimum: str) -> DataFrame:
    least = LEVEL_RANKS.get(minimum.upper(), LEVEL_RANKS["INFO"])
    return df.filter(level_rank(F.col(level)) >= least)


def union_kinds(frames: dict[str, DataFrame]) -> DataFrame:
    """Stack inventories with differing columns; ``kind`` tells where a row came from."""
    parts = [df.withColumn("kind", F.lit(kind)) for kind, df in frames.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def order_rows(df: DataFrame, *columns: str) -> DataFrame:
    return df.orderBy(*columns)


def newest(df: DataFrame, ts: str, tie: str, n: int = 1) -> DataFrame:
    """The newest ``n`` rows; planned as a top-n, not as a full sort."""
    return df.orderBy(F.col(ts).desc(), F.col(tie).desc()).limit(n)
