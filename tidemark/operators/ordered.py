"""Running totals over ordered groups of any size, and size-checked joins."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tidemark.session import cut_lineage

GROUP_ROWS = 2_000_000
GROUP_BYTES = 2 * 1024**3
#: Rows that one task of a window or an aggregation gets where their number is known, about.
TASK_ROWS = 500_000
BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 64 * 1024**2


def small_side(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """The narrow side of a join, computed once (checkpointed) and measured when this is called.

    It is marked for broadcast only if it has at most ``max_rows`` rows and, written as JSON,
    ``max_bytes``; otherwise the planner decides.
    """
    fixed = cut_lineage(df)
    width = F.octet_length(F.to_json(F.struct("*"))).cast("bigint")
    rows, size = fixed.agg(F.count(F.lit(1)), F.coalesce(F.sum(width), F.lit(0))).first()
    return F.broadcast(fixed) if rows <= max_rows and size <= max_bytes else fixed


def null_safe_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Equi join in which a null key matches a null key, as in grouping."""
    renamed = {k: f"_right_{k}" for k in keys}
    same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(renamed[k])) for k in keys])
    return left.join(right.withColumnsRenamed(renamed), same, how).drop(*renamed.values())


def dealt(df: DataFrame, keys: list[str], rows: int) -> DataFrame:
    """``df`` by ``keys`` in as many tasks as its ``rows`` ask for; so few that one task takes them are left to the planner.

    A session's number of partitions does not grow with the rows, and adaptive execution joins partitions by their
    compressed bytes, which say little about what a sort or a hash table of their rows takes.
    """
    return df.repartition(-(-rows // TASK_ROWS), *keys) if rows > TASK_ROWS else df


def chunks_needed(df: DataFrame, keys: list[str], max_rows: int = GROUP_ROWS, size: str | None = None,
                  max_size: int = GROUP_BYTES) -> int:
    """0 when every group fits one task, else how many chunks bring all rows down to that measure."""
    return rows_and_chunks(df, keys, max_rows, size, max_size)[1]


def rows_and_chunks(df: DataFrame, keys: list[str], max_rows: int = GROUP_ROWS, size: str | None = None,
                    max_size: int = GROUP_BYTES) -> tuple[int, int]:
    """The number of rows, and ``chunks_needed``.

    One count per group over the key columns (and ``size``), reduced before its shuffle.
    """
    amount = F.coalesce(F.sum(size), F.lit(0)) if size else F.lit(0)
    groups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"), amount.alias("size"))
    most = groups.agg(F.max("rows"), F.max("size"), F.sum("rows"), F.sum("size")).first()
    if most[0] is None or (most[0] <= max_rows and most[1] <= max_size):
        return most[2] or 0, 0
    # Range bounds come from a sample, so aim at half the measure.
    return most[2], 2 * max(-(-most[2] // max_rows), -(-int(most[3]) // max_size))


def ordered_chunks(df: DataFrame, keys: list[str], order: list[str], chunks: int) -> DataFrame:
    """Add ``_chunk``: consecutive pieces of the (keys, order) sequence, each one partition in size.

    A large group spans many chunks. Range bounds are sampled, so they are fixed by a reliable
    checkpoint before two branches of a plan rely on them.
    """
    ranged = df.repartitionByRange(chunks, *[F.col(c) for c in (*keys, *order)])
    return cut_lineage(ranged.withColumn("_chunk", F.spark_partition_id()))


def exact(amount: Column, kind: T.DataType, scale: int) -> Column:
    """Fractions as decimals of ``scale`` digits, whose sums are the same in any order."""
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return amount.cast(T.DecimalType(28, scale))
    return amount


def running_total(df: DataFrame, keys: list[str], order: list[str], amount: Column, name: str,
                  max_rows: int = GROUP_ROWS, chunks: int | None = None, scale: int = 6, rows: int = 0) -> DataFrame:
    """Add the sum of ``amount`` over the group's earlier rows; ``order`` must tell rows apart.

    A fractional amount is rounded to ``scale`` digits and summed exactly, so the plan does not
    change the answer. Groups of at most ``max_rows`` rows are one sorted window. The rows of a
    larger group are cut into ordered chunks: a window per chunk, plus the totals of the chunks
    before it. Only keys, order and amount of such groups are fixed on disk. ``chunks`` and ``rows`` state
    the number of chunks (0 for none) and of rows where the caller knows them.
    """
    if chunks is None:
        rows, chunks = rows_and_chunks(df, keys, max_rows)
    kind = df.select(amount.alias("a")).schema["a"].dataType
    df = df.withColumn("_amount", exact(amount, kind, scale))
    total = kind if isinstance(kind, (T.FloatType, T.DoubleType)) else None
    zero = F.lit(0).cast(df.schema["_amount"].dataType)

    def shown(column: Column) -> Column:
        return column.cast(total) if total else column

    def by_window(part: DataFrame) -> DataFrame:
        before = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
        return dealt(part, keys, rows).withColumn(name, shown(F.coalesce(F.sum("_amount").over(before), zero))).drop("_amount")

    if not chunks:
        return by_window(df)
    # At most rows / max_rows groups are larger than max_rows.
    large = small_side(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > max_rows).select(*keys))
    hot = null_safe_join(df, large, keys, "left_semi")
    cut = ordered_chunks(hot.select(*dict.fromkeys([*keys, *order]), "_amount"), keys, order, chunks)
    whole = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = cut.groupBy(*keys, "_chunk").agg(F.sum("_amount").alias("_sum")).select(
        *keys, "_chunk", F.coalesce(F.sum("_sum").over(whole), zero).alias("_offset")
    )
    inside = Window.partitionBy(*keys, "_chunk").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = cut.withColumn("_local", F.coalesce(F.sum("_amount").over(inside), zero))
    placed = null_safe_join(local, offsets, [*keys, "_chunk"])
    where = list(dict.fromkeys([*keys, *order]))
    totals = placed.select(*where, shown(F.col("_local") + F.col("_offset")).alias(name))
    return by_window(null_safe_join(df, large, keys, "left_anti")).unionByName(
        null_safe_join(hot.drop("_amount"), totals, where))


def as_of(rows: DataFrame, markers: DataFrame, keys: list[str], at: str, held: str, chunks: int = 0, known: int = 0) -> DataFrame:
    """Add ``held`` of the group's last marker at or before the row, null before the first.

    ``markers`` has ``keys``, ``at`` and ``held``. Rows and markers go through one sort, in which the last marker
    is carried on; no row looks through a list. With ``chunks`` the sequence is cut by range into so many pieces,
    each of which begins with the last marker of the pieces before it, so a group of any size is spread.
    ``known`` is the number of rows, where the caller knows it.
    """
    both = rows.withColumns({held: F.lit(None).cast(markers.schema[held].dataType), "_marks": F.lit(1)}).unionByName(
        markers.select(*keys, at, held).withColumn("_marks", F.lit(0)), allowMissingColumns=True)
    place = [at, "_marks"]
    if not chunks:
        carried = Window.partitionBy(*keys).orderBy(*place).rowsBetween(Window.unboundedPreceding, 0)
        return dealt(both, keys, known).withColumn(held, F.last(held, ignorenulls=True).over(carried)).filter("_marks = 1").drop("_marks")
    cut = ordered_chunks(both, keys, place, chunks)
    inside = Window.partitionBy(*keys, "_chunk").orderBy(*place).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    entries = cut.groupBy(*keys, "_chunk").agg(F.max_by(held, F.when(F.col("_marks") == 0, F.col(at))).alias("_entry"))
    entries = entries.select(*keys, "_chunk", F.last("_entry", ignorenulls=True).over(before).alias("_entry"))
    local = cut.withColumn(held, F.last(held, ignorenulls=True).over(inside)).filter("_marks = 1")
    joined = null_safe_join(local, entries, [*keys, "_chunk"])
    return joined.withColumn(held, F.coalesce(held, "_entry")).drop("_marks", "_chunk", "_entry")
