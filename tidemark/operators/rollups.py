"""Grouped metrics: counts, latest row per key, fleet statistics, nested top buckets."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tidemark.functions import clock
from tidemark.operators.ordered import null_safe_join, small_side
from tidemark.session import cut_lineage

#: Buckets of one top-level key that are nested into one value at most.
NESTED_BUCKETS = 200_000
#: Combinations that ``nested_terms`` counts one by one; of more it counts only the frequent ones.
MOST_COUNTS = 5_000_000
#: Cells for the keys that a sketch does not name, and the fewest and most keys that it tracks.
CELLS, LEAST_TRACKED, MOST_TRACKED = 4_096, 1_024, 1_000_000


def count_window(df: DataFrame, ts: str, start, end, closed: str = "both") -> DataFrame:
    """One row with the number of rows in the window, 0 when there are none."""
    return df.filter(
        clock.within(F.col(ts), clock.instant(start), clock.instant(end), closed)
    ).agg(F.count(F.lit(1)).alias("row_count"))


def _as_long(column: str, kind: T.DataType) -> Column | None:
    """A time, date or whole number as a long in the same order; null for any other type."""
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(F.col(column).cast("timestamp"))
    if isinstance(kind, T.DateType):
        return F.unix_date(column).cast("bigint")
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return F.col(column).cast("bigint")
    return None


def with_order_key(df: DataFrame, order: list[str]) -> DataFrame:
    """Add ``_order``, by which ``latest`` compares rows; a null sorts first.

    Aggregation hashes only while its buffers have fixed width. So an order of one time or number,
    or of a time and a number that breaks its ties, becomes one number. Any other order stays a
    struct, which makes Spark sort the rows before it reduces them.
    """
    kinds = [df.schema[c].dataType for c in order]
    longs = [_as_long(c, k) for c, k in zip(order, kinds)]
    timed = isinstance(kinds[0], (T.TimestampType, T.TimestampNTZType, T.DateType))
    lowest = F.lit(-(2**63)).cast("bigint")
    if len(order) == 1 and longs[0] is not None:
        key = F.coalesce(longs[0], lowest)
    elif len(order) == 2 and timed and longs[1] is not None:
        # The factor exceeds the span of a long, so the second number never reaches into the first.
        wide = F.coalesce(longs[0], F.lit(-(10**17))).cast("decimal(18,0)") * F.lit(Decimal(2 * 10**19))
        key = wide + F.coalesce(longs[1], lowest).cast("decimal(19,0)")
    else:
        key = F.struct(*order)
    return df.withColumn("_order", key)


def latest(df: DataFrame, fields: list[str]) -> Column:
    """Aggregate over ``with_order_key`` rows: ``fields`` of the last row, as a struct."""
    if isinstance(df.schema["_order"].dataType, T.StructType):
        return F.max_by(F.struct(*fields), "_order")
    return F.struct(*[F.max_by(f, "_order").alias(f) for f in fields])


def latest_per_key(df: DataFrame, key: str | list[str], order: list[str], fields: list[str]) -> DataFrame:
    """The last row of each key. Reduced before the shuffle, so one hot key costs one row per task."""
    keys = [key] if isinstance(key, str) else list(key)
    known = df.filter(reduce(Column.__and__, [F.col(k).isNotNull() for k in keys]))
    ordered = with_order_key(known, order)
    return ordered.groupBy(*keys).agg(latest(ordered, fields).alias("_last")).select(*keys, "_last.*")


@dataclass(frozen=True)
class UnitStats:
    """Fleet statistics whose parts can be merged: call it with rows and dimensions, or take its steps apart.

    ``partials`` groups by (keys, unit): sums and the unit's latest row, by an ``order`` that tells its rows
    apart. ``merge`` brings partials of finer keys to coarser ones. ``finish`` folds the units, so the distinct
    count is a plain count, with no distinct shuffle and no join back.
    """

    order: tuple[str, ...]
    unit: str
    units: str
    sums: tuple[tuple[str, str], ...]
    mean: str
    held: tuple[tuple[str, str], ...]
    shown: Callable[[DataFrame, list[str]], DataFrame]

    def partials(self, df: DataFrame, keys: list[str]) -> DataFrame:
        ordered = with_order_key(df, list(self.order))
        return ordered.groupBy(*keys, self.unit).agg(
            *[F.sum(c).alias(f"_{n}") for n, c in self.sums],
            F.sum(self.mean).alias("_mean_sum"), F.count(self.mean).alias("_mean_n"),
            latest(ordered, [c for _, c in self.held]).alias("_last"), F.max("_order").alias("_order"),
        )

    def merge(self, partials: DataFrame, keys: list[str]) -> DataFrame:
        held = [f"_last.{c}" for _, c in self.held]
        if isinstance(partials.schema["_order"].dataType, T.StructType):
            last = F.max_by("_last", "_order")
        else:
            last = F.struct(*[F.max_by(c, "_order").alias(c.partition(".")[2]) for c in held])
        return partials.groupBy(*keys, self.unit).agg(
            *[F.sum(f"_{n}").alias(f"_{n}") for n, _ in self.sums],
            F.sum("_mean_sum").alias("_mean_sum"), F.sum("_mean_n").alias("_mean_n"), last.alias("_last"), F.max("_order").alias("_order"),
        )

    def finish(self, partials: DataFrame, dims: list[str]) -> DataFrame:
        known = F.col(self.unit).isNotNull()
        out = partials.groupBy(*dims).agg(
            F.count(self.unit).alias(self.units),
            *[F.coalesce(F.sum(f"_{n}").cast("double"), F.lit(0.0)).alias(n) for n, _ in self.sums],
            (F.sum("_mean_sum").cast("double") / F.nullif(F.sum("_mean_n"), F.lit(0))).alias("_mean"),
            *[F.coalesce(F.sum(F.when(known, F.col(f"_last.{c}"))).cast("double"), F.lit(0.0)).alias(n) for n, c in self.held],
        )
        return self.shown(out, dims)

    def __call__(self, df: DataFrame, dims: list[str]) -> DataFrame:
        return self.finish(self.partials(df, dims), dims)


def _compute_columns(out: DataFrame, dims: list[str]) -> DataFrame:
    return out.select(*dims, "count", "run_rate", "core_hours", "ram_hours", (F.col("_mean") * 100).alias("efficiency"), "core_count", "ram")


def _storage_columns(out: DataFrame, dims: list[str]) -> DataFrame:
    share = F.when(F.col("total_size") != 0, F.col("used_size") / F.col("total_size") * 100).otherwise(0.0)
    return out.select(*dims, "disk_count", "run_rate", "disk_hours", F.col("_mean").alias("efficiency"),
                      "total_size", "used_size", share.alias("disk_efficiency"))


def compute_unit_stats(order, host: str = "hostname") -> UnitStats:
    """Compute metrics; cores and memory are summed over each host's latest row."""
    return UnitStats(tuple(order), host, "count", (("run_rate", "total_runrate"), ("core_hours", "core_hours"), ("ram_hours", "ram_hours")),
                     "cpu_30d", (("core_count", "core_count"), ("ram", "ram")), _compute_columns)


def storage_unit_stats(order, disk: str = "mount_point") -> UnitStats:
    """Storage metrics; sizes are summed over each disk's latest row."""
    return UnitStats(tuple(order), disk, "disk_count", (("run_rate", "runrate"), ("disk_hours", "disk_hours")),
                     "used_pct", (("total_size", "totalsize"), ("used_size", "usedsize")), _storage_columns)


def compute_stats(df: DataFrame, dims: list[str], order, host: str = "hostname") -> DataFrame:
    """Compute metrics per group; ``order`` must tell a host's rows apart, or the latest of equals is left open."""
    return compute_unit_stats(order, host)(df, dims)


def storage_stats(df: DataFrame, dims: list[str], order, disk: str = "mount_point") -> DataFrame:
    """Storage metrics per group, by a unique ``order``."""
    return storage_unit_stats(order, disk)(df, dims)


def distinct_values(column: str, exact: bool = False, rsd: float = 0.01) -> Column:
    """Aggregate: distinct values; the approximate form keeps a sketch of fixed size per group."""
    return F.count_distinct(column) if exact else F.approx_count_distinct(column, rsd)


def distinct_count(df: DataFrame, column: str, exact: bool = False, rsd: float = 0.01) -> DataFrame:
    return df.agg(distinct_values(column, exact, rsd).alias("n_distinct"))


def _key_hash(df: DataFrame, name: str) -> Column:
    """A long that is the same for keys that grouping holds equal."""
    number = isinstance(df.schema[name].dataType, (T.FloatType, T.DoubleType))
    return F.xxhash64(F.col(name) + F.lit(0.0) if number else F.col(name))  # -0.0 + 0.0 is 0.0


def _ranked(level: DataFrame, parent: list[str], name: str, size: int) -> DataFrame:
    order = [F.col("n").desc(), F.col(name).asc()]
    if not parent:
        return level.orderBy(*order).limit(size)
    rank = F.row_number().over(Window.partitionBy(*parent).orderBy(*order))
    return level.withColumn("_rank", rank).filter(F.col("_rank") <= size).drop("_rank")


def frequent_keys(df: DataFrame, parent: list[str], name: str, size: int, cells: int = CELLS) -> DataFrame:
    """The ``size`` largest keys of each parent with their exact row counts, without counting every key.

    A sketch of frequent items per parent names candidates. The next pass counts each of them exactly and all
    other keys together, in ``cells`` cells by hash. A cell with fewer rows than the parent's last kept candidate
    holds no key that belongs in the result. Only the keys of the other cells are counted one by one: none where
    keys are skewed, all where they are alike, so the answer never rests on what the sketch saw. Each pass
    reduces before its shuffle, to at most the candidates and cells of each parent in the first two.
    """
    top = max(1, min(4 * size, MOST_TRACKED))
    tracked = min(max(LEAST_TRACKED, 4 * top), MOST_TRACKED)
    groups = parent or ["_all"]
    keyed = df.withColumn("_hash", _key_hash(df, name))
    keyed = (keyed if parent else keyed.withColumn("_all", F.lit(0))).select(*groups, name, "_hash")
    sketched = keyed.groupBy(*groups).agg(F.expr(f"approx_top_k(_hash, {top}, {tracked})").alias("_top"))
    named = sketched.select(*groups, F.explode("_top.item").alias("_hash"), F.lit(True).alias("_named"))
    marked = null_safe_join(keyed, small_side(named), [*groups, "_hash"], "left")
    cell = F.when(F.col("_named").isNull(), F.pmod("_hash", F.lit(cells)))
    marked = marked.select(*groups, name, cell.alias("_cell"))
    known = F.when(F.col("_cell").isNull(), F.col(name)).alias(name)
    counted = cut_lineage(marked.groupBy(*groups, "_cell", known).agg(F.count(F.lit(1)).alias("n")))
    sure = counted.filter(F.col("_cell").isNull()).select(*groups, name, "n")
    last = _ranked(sure, groups, name, size).groupBy(*groups).agg(F.min("n").alias("_last"), F.count(F.lit(1)).alias("_kept"))
    last = last.filter(F.col("_kept") == size).drop("_kept")
    open_cells = null_safe_join(counted.filter(F.col("_cell").isNotNull()), last, groups, "left").filter(
        F.col("_last").isNull() | (F.col("n") >= F.col("_last")))
    open_cells = cut_lineage(open_cells.select(*groups, "_cell"))
    if not open_cells.isEmpty():
        rest = null_safe_join(marked.filter(F.col("_cell").isNotNull()), small_side(open_cells), [*groups, "_cell"], "left_semi")
        sure = sure.unionByName(rest.groupBy(*groups, name).agg(F.count(F.lit(1)).alias("n")))
    return _ranked(sure if parent else sure.drop("_all"), parent, name, size)


def nested_terms(df: DataFrame, dims: list[str], size: int | None = None, within: tuple[str, ...] = (),
                 most_counts: int = MOST_COUNTS) -> DataFrame:
    """Row counts of nested buckets: all of them, or at each level the ``size`` largest keys of each parent.

    Ranks use a bucket's full count, before its children are cut; ties go to the smaller key. Each
    combination of ``within`` values has buckets of its own and is never cut.

    With a ``size`` the combinations are estimated first, when this is called. Up to about ``most_counts``
    are counted in one more scan, and each level works on the checkpointed counts. More of them are never
    listed: ``frequent_keys`` finds each level from the rows of the level above. Both give the same buckets.
    """
    outer = list(within)
    present = reduce(Column.__and__, [F.col(d).isNotNull() for d in dims])
    rows = df.filter(present).select(*outer, *dims)
    counts = rows.groupBy(*outer, *dims).agg(F.count(F.lit(1)).alias("n"))
    if size is None:
        return counts
    hashable = all(isinstance(rows.schema[d].dataType, T.AtomicType) for d in dims)
    if hashable and rows.agg(F.approx_count_distinct(F.xxhash64(*outer, *dims))).first()[0] > most_counts:
        kept = None
        for depth, name in enumerate(dims, start=1):
            parent = [*outer, *dims[:depth - 1]]
            level = rows if kept is None else null_safe_join(rows, small_side(kept.select(*parent)), parent, "left_semi")
            kept = cut_lineage(frequent_keys(level, parent, name, size))
        return kept
    counts = cut_lineage(counts)
    kept = None
    for depth, name in enumerate(dims, start=1):
        path = [*outer, *dims[:depth]]
        parent = path[:-1]
        level = counts if kept is None else null_safe_join(counts, kept.select(*parent), parent, "left_semi")
        if depth < len(dims):
            level = level.groupBy(*path).agg(F.sum("n").alias("n"))
        kept = _ranked(level, parent, name, size)
    return kept


def nested_stats(df: DataFrame, dims: list[str], stats, size: int | None = None, within: tuple[str, ...] = ()) -> DataFrame:
    """``stats(df, dims)`` for all buckets, or the surviving ones; rows of cut buckets never reach the shuffle.

    The survivors are at most ``size ** len(dims)`` per ``within`` value; a small list is broadcast.
    """
    keys = [*within, *dims]
    if size is None:
        return stats(df.filter(reduce(Column.__and__, [F.col(d).isNotNull() for d in dims])), keys)
    kept = small_side(nested_terms(df, dims, size, within).drop("n"))
    return stats(df.join(kept, keys, "left_semi"), keys)


def nest_buckets(df: DataFrame, dims: list[str], max_buckets: int = NESTED_BUCKETS) -> DataFrame:
    """Fold bucket rows into one nested JSON object per top-level key; leaves hold the metrics.

    There is one row per top-level key, and a key's tree is one value. So the buckets of every key are counted
    first, and a key of more than ``max_buckets`` fails the job before anything is gathered: state a ``size``
    for ``nested_terms`` or ``nested_stats`` there.
    """
    metrics = [c for c in df.columns if c not in dims]
    df = cut_lineage(df)  # buckets, counted and folded
    most = df.groupBy(dims[0]).agg(F.count(F.lit(1)).alias("n")).agg(F.max_by(dims[0], "n"), F.max("n")).first()
    if most[1] is not None and most[1] > max_buckets:
        raise ValueError(f"{dims[0]} {most[0]!r} has {most[1]} buckets, more than the {max_buckets} that one tree may hold")
    out = df.withColumn("_tree", F.struct(*metrics))
    for depth in range(len(dims) - 1, 0, -1):
        entry = F.struct(F.col(dims[depth]).cast("string").alias("key"), F.col("_tree").alias("value"))
        out = out.groupBy(*dims[:depth]).agg(
            F.map_from_entries(F.array_sort(F.collect_list(entry), lambda a, b: F.when(
                a["key"] < b["key"], -1).when(a["key"] > b["key"], 1).otherwise(0))).alias("_tree")
        )
    return out.select(dims[0], F.to_json("_tree", {"ignoreNullFields": "false"}).alias("buckets"))


def part_sizes(df: DataFrame, part: str, text: Column | None = None) -> DataFrame:
    """Lines and raw bytes per part; bytes of ``text``, or of the row as compact JSON."""
    raw = F.to_json(F.struct("*"), {"ignoreNullFields": "false"}) if text is None else text
    return df.groupBy(part).agg(
        F.count(F.lit(1)).alias("lines"),
        F.coalesce(F.sum(F.octet_length(raw).cast("bigint")), F.lit(0)).cast("bigint").alias("raw_bytes"),
    )


def compression_ratio(raw: Column, packed: Column) -> Column:
    """Percent saved; 0 when there was nothing to pack."""
    return F.when(raw > 0, F.lit(100.0) * (1 - packed / raw)).otherwise(F.lit(0.0))


def rows_per_part(df: DataFrame, max_bytes: int = 250 * 1024 * 1024, text: Column | None = None,
                  least_read: int = 100, most_read: int = 200_000) -> DataFrame:
    """Rows that fill a part on average, over all rows; ``read_rows`` is kept within the given bounds.

    A row's bytes are those of ``text``, or of the row as compact JSON. This is a mean: writers
    that must keep a cap add up the bytes of their rows instead.
    """
    raw = F.to_json(F.struct("*"), {"ignoreNullFields": "false"}) if text is None else text
    per_row = F.greatest(F.lit(1.0), F.coalesce(F.avg("_b"), F.lit(1.0)))
    rows = F.greatest(F.lit(1), F.floor(F.lit(float(max_bytes)) / per_row)).cast("bigint")
    return (
        df.select(F.octet_length(raw).alias("_b"))
        .agg(F.count(F.lit(1)).alias("measured"), per_row.alias("bytes_per_row"), rows.alias("rows_per_part"))
        .withColumn("read_rows", F.least(F.greatest("rows_per_part", F.lit(least_read)), F.lit(most_read)).cast("bigint"))
    )
