"""The fleet report: details, a snapshot or a trend over the compute and storage inventories."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import clock
from tidemark.operators import filters
from tidemark.operators.people import exec_rollup
from tidemark.operators.rollups import compute_unit_stats, nested_stats, storage_unit_stats
from tidemark.operators.trends import trend

@dataclass(frozen=True)
class Exclusion:
    """Rows that a report never counts: those equal to, or like, one of the values."""

    equals: dict[str, object] = field(default_factory=dict)
    like: dict[str, str] = field(default_factory=dict)


@dataclass(frozen=True)
class FleetRequest:
    """What to report. An empty filter, dimension list or status list places no condition.

    ``services`` names, per inventory, the services whose rows count; an inventory without any is left
    out. ``order`` names, per inventory, columns that tell the rows of a host or disk apart. A term on
    ``chain`` also finds rows owned by one of its values if ``owner_or_chain`` is set. ``bucket_size``
    keeps only the largest buckets of each dimension.
    """

    start: object
    end: object
    services: dict[str, tuple[str, ...]]
    order: dict[str, tuple[str, ...]]
    status: tuple[str, ...] = ("Production", "Retired")
    terms: dict[str, list] = field(default_factory=dict)
    dims: tuple[str, ...] = ()
    days: int = 1
    zone: str = "America/Los_Angeles"
    closed: str = "left"
    bucket_size: int | None = None
    disk: str = "clust_vol_mount"
    chain: str = "owner_mgr_chain"
    owner_or_chain: bool = False
    exclusions: dict[str, Exclusion] = field(default_factory=lambda: {
        "compute": Exclusion({"pri_owner": "na"}), "storage": Exclusion({"owner": "na"})})

    def kinds(self) -> list[str]:
        return [k for k in ("compute", "storage") if self.services.get(k)]


def selected(inventory: DataFrame, kind: str, request: FleetRequest, ts: str = "ts") -> DataFrame:
    """Rows of one inventory that the request covers: window, services, exclusions, status, terms."""
    window = clock.within(F.col(ts), clock.instant(request.start), clock.instant(request.end), request.closed)
    df = inventory.filter(window & F.col("service").isin(list(request.services[kind])))
    never = request.exclusions.get(kind, Exclusion())
    df = filters.exclude(df, never.equals, never.like)
    if request.status:
        df = df.filter(reduce(Column.__or__, [filters.status_test(kind, s) for s in request.status]))
    terms = dict(request.terms)
    if request.owner_or_chain and request.chain in terms:
        names = terms.pop(request.chain)
        df = filters.filter_owner_or_chain(df, names, filters.CONCEPTS["pri_owner"][kind], request.chain)
    return filters.filter_terms(df, terms, filters.FILTERABLE[kind])


def _stats(kind: str, request: FleetRequest, disk: str):
    order = request.order[kind]
    return compute_unit_stats(order) if kind == "compute" else storage_unit_stats(order, disk)


def _dims(kind: str, request: FleetRequest) -> list[str]:
    return [filters.CONCEPTS[d][kind] for d in request.dims]


def details(inventories: dict[str, DataFrame], request: FleetRequest, concepts: list[str]) -> DataFrame:
    """Matching rows of all inventories under common names, ready for the details file."""
    return filters.union_kinds({
        kind: filters.project_fields(
            selected(inventories[kind], kind, request), concepts, kind,
            stats=[s for s in filters.STATS[kind] if s in inventories[kind].columns])
        for kind in request.kinds()
    })


def snapshot(inventories: dict[str, DataFrame], request: FleetRequest) -> dict[str, DataFrame]:
    """Statistics of the whole window per inventory, within the largest buckets of each dimension."""
    out = {}
    for kind in request.kinds():
        rows, dims = selected(inventories[kind], kind, request), _dims(kind, request)
        stats = _stats(kind, request, request.disk)
        out[kind] = nested_stats(rows, dims, stats, request.bucket_size) if dims else stats(rows, [])
    return out


def fleet_trend(inventories: dict[str, DataFrame], request: FleetRequest) -> dict[str, DataFrame]:
    """Statistics per trend window and inventory. Trends tell disks apart by mount point."""
    return {
        kind: trend(selected(inventories[kind], kind, request), "ts", request.zone, request.start, request.end,
                    _stats(kind, request, "mount_point"), _dims(kind, request), request.days, request.bucket_size)
        for kind in request.kinds()
    }


def exec_snapshot(inventories: dict[str, DataFrame], request: FleetRequest, users: DataFrame,
                  execs: DataFrame) -> dict[str, DataFrame]:
    """The snapshot per (exec, report), with its dimensions; each exec's filter applies to that exec alone."""
    out = {}
    for kind in request.kinds():
        owner, stats, dims = filters.CONCEPTS["pri_owner"][kind], _stats(kind, request, request.disk), _dims(kind, request)
        rows = selected(inventories[kind], kind, request)
        if owner not in dims:
            rows = rows.withColumnRenamed(owner, "pri_owner")
        else:
            rows = rows.withColumn("pri_owner", F.col(owner))

        def report(df, people, stats=stats, dims=dims):
            return nested_stats(df, dims, stats, request.bucket_size, tuple(people))

        if dims and request.bucket_size is not None:
            out[kind] = exec_rollup(rows, users, execs, report)
        else:
            rows = rows.filter(reduce(Column.__and__, [F.col(d).isNotNull() for d in dims])) if dims else rows
            out[kind] = exec_rollup(rows, users, execs, stats, tuple(dims))
    return out
