"""A stored table by key: rows lie in buckets of their key's hash, and a change replaces only the buckets it touches.

The new buckets and all others become the table's state at once (see ``publish``).
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.ordered import small_side
from tidemark.sinks import publish

BUCKET = "bucket"
#: Buckets of a table. A change rewrites about as many of them as it has keys, so they bound what it reads.
BUCKETS = 64


def bucket_of(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def _touched(keys: DataFrame, key: str, buckets: int) -> set[int]:
    return {r[0] for r in keys.select(bucket_of(F.col(key), buckets)).distinct().collect()}  # at most ``buckets``


def _in_buckets(state: publish.State, wanted: set[int]) -> publish.State:
    return publish.State(state.number, [s for s in state.slices if dict(s.values)[BUCKET] in wanted])


def read_keyed(spark: SparkSession, root: str, schema: T.StructType, state: publish.State | None = None) -> DataFrame:
    """The stored rows; ``schema`` is theirs, without the bucket."""
    return publish.read_state(spark, root, _stored(schema), state).drop(BUCKET)


def _stored(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(BUCKET, T.IntegerType())])


def rows_of_keys(keys: DataFrame, root: str, schema: T.StructType, key: str, buckets: int = BUCKETS) -> DataFrame:
    """The stored rows of some keys; only their buckets are read."""
    spark = keys.sparkSession
    state = _in_buckets(publish.current(spark, root), _touched(keys, key, buckets))
    return read_keyed(spark, root, schema, state).join(keys.select(key), key, "left_semi")


def replace_keys(gone: DataFrame, rows: DataFrame, root: str, key: str, buckets: int = BUCKETS) -> bool:
    """Publish the table without the rows of the keys in ``gone`` and with ``rows``, whose keys must be among them.

    False where another change was published meanwhile; then nothing is changed. A table keeps the number of
    buckets it began with. Both frames are read more than once, so they should be fixed where that is costly.
    """
    spark, run, base = rows.sparkSession, publish.new_run(), publish.current(rows.sparkSession, root)
    schema = _stored(rows.schema)
    touched = _touched(gone, key, buckets)
    if not touched:
        return True
    old = publish.read_state(spark, root, schema, _in_buckets(base, touched)).drop(BUCKET)
    keep = old.join(small_side(gone.select(key).distinct()), key, "left_anti")
    try:
        changed = keep.unionByName(rows).withColumn(BUCKET, bucket_of(F.col(key), buckets))
        publish.write_run(changed, root, [BUCKET], run, publish.slice_bytes(changed, [BUCKET]))
        at = publish.now_text()
        fresh = [publish.Slice(((BUCKET, b),), run, n, at) for b, n in sorted(_written(spark, root, run, schema).items())]
        if publish.publish(spark, root, base, [s for s in base.slices if dict(s.values)[BUCKET] not in touched] + fresh):
            return True
    except Exception:
        publish.forget_run(spark, root, run, 1)
        raise
    publish.forget_run(spark, root, run, 1)
    return False


def _written(spark: SparkSession, root: str, run: str, schema) -> dict[int, int]:
    """Rows per bucket of a run; buckets without rows have no folder."""
    try:
        rows = spark.read.schema(schema).option("basePath", f"{root}/data").parquet(f"{root}/data/{BUCKET}=*/run={run}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return {}
    return {r[0]: r.n for r in rows.groupBy(BUCKET).agg(F.count(F.lit(1)).alias("n")).collect()}


def upsert_stored(changes: DataFrame, root: str, key: str, buckets: int = BUCKETS) -> bool:
    """Stored rows of equal key replaced by ``changes``, and new keys added."""
    return replace_keys(changes, changes, root, key, buckets)
