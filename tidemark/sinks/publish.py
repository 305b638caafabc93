"""States of a stored table that change all at once.

A run writes its files into folders of its own, where no reader looks. A version file then names every folder
of the new state. It appears whole and only if nobody else has published that version, so a reader sees the old
state or the new one, and of two runs that build on the same state one has to look again.

    <root>/data/<slice columns>/run=<run id>/...   rows
    <root>/versions/v00000001.json                 {"slices": [{"slice": {...}, "run": ..., "rows": ..., "at": ...}]}
"""

from __future__ import annotations

import json
import os
import re
import uuid
from dataclasses import dataclass, field
from datetime import datetime, timezone
from urllib.parse import unquote, urlparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.ordered import null_safe_join

_VERSION = re.compile(r"v(\d+)\.json")
#: Bytes, uncompressed, that one task of a run sorts and writes, about, where the sizes of its slices are known.
TASK_BYTES = 64 * 1024 * 1024


@dataclass(frozen=True)
class Slice:
    """One folder of a state: its slice values by column, the run that wrote it, its rows, and when it was published."""

    values: tuple[tuple[str, object], ...]
    run: str
    rows: int
    at: str


@dataclass
class State:
    """What a version names. ``number`` 0 is the empty state before the first version."""

    number: int = 0
    slices: list[Slice] = field(default_factory=list)

    def by_value(self) -> dict[tuple, Slice]:
        return {s.values: s for s in self.slices}


def _hadoop(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def create_once(spark: SparkSession, path: str, text: str) -> bool:
    """Make a small file appear with all its text, unless it is there already; whether it was made."""
    jvm = spark.sparkContext._jvm
    fs, where = _hadoop(spark, path)
    draft = f"{path}.{uuid.uuid4().hex}"
    if urlparse(path).scheme in ("", "file"):  # a rename would replace what is there; a link does not
        place, draft = (unquote(urlparse(p).path) for p in (path, draft))
        os.makedirs(os.path.dirname(place), exist_ok=True)
        with open(draft, "w", encoding="utf-8") as out:
            out.write(text)
        try:
            os.link(draft, place)
            return True
        except FileExistsError:
            return False
        finally:
            os.unlink(draft)
    early = jvm.org.apache.hadoop.fs.Path(draft)
    out = fs.create(early, False)
    out.write(bytearray(text, "utf-8"))
    out.close()
    made = not fs.exists(where) and fs.rename(early, where)  # refuses where the name is taken by then
    if not made:
        fs.delete(early, False)
    return made


def _name(number: int) -> str:
    return f"v{number:08d}.json"


def _numbers(spark: SparkSession, root: str) -> list[int]:
    fs, where = _hadoop(spark, f"{root}/versions")
    if not fs.exists(where):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(where)]
    return sorted(int(m[1]) for name in names if (m := _VERSION.fullmatch(name)))


def state_at(spark: SparkSession, root: str, number: int) -> State:
    """A published state; earlier ones stay readable until ``sweep_runs`` forgets them."""
    text = spark.read.text(f"{root}/versions/{_name(number)}", wholetext=True).first().value
    return State(number, [Slice(tuple(s["slice"].items()), s["run"], s["rows"], s["at"]) for s in json.loads(text)["slices"]])


def current(spark: SparkSession, root: str) -> State:
    """The newest published state."""
    numbers = _numbers(spark, root)
    return state_at(spark, root, numbers[-1]) if numbers else State()


def publish(spark: SparkSession, root: str, base: State, slices: list[Slice]) -> bool:
    """Make ``slices`` the state after ``base``; false where another run has published one meanwhile."""
    body = {"slices": [{"slice": dict(s.values), "run": s.run, "rows": s.rows, "at": s.at} for s in slices]}
    return create_once(spark, f"{root}/versions/{_name(base.number + 1)}", json.dumps(body))


def _folder(root: str, piece: Slice) -> str:
    return "/".join([f"{root}/data", *(f"{k}={v}" for k, v in piece.values), f"run={piece.run}"])


def read_state(spark: SparkSession, root: str, schema, state: State | None = None) -> DataFrame:
    """The rows of a state, the newest by default; ``schema`` (with the slice columns) stands in where there is none."""
    state = current(spark, root) if state is None else state
    none = spark.createDataFrame([], schema)
    if not state.slices:
        return none
    rows = spark.read.schema(schema).option("basePath", f"{root}/data").parquet(*[_folder(root, s) for s in state.slices])
    return rows.select(*[f"`{f.name}`" for f in none.schema.fields])


def new_run() -> str:
    return "r" + uuid.uuid4().hex


def slice_bytes(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Bytes per slice, uncompressed, about: eight per column, and what texts and nested values hold."""
    width = F.lit(8 * (len(rows.columns) + 1)).cast("bigint")
    for f in rows.schema.fields:
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            width = width + F.coalesce(F.octet_length(F.col(f"`{f.name}`")), F.lit(0))
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            width = width + F.octet_length(F.to_json(F.struct(F.col(f"`{f.name}`"))))
    return rows.groupBy(*columns).agg(F.sum(width).alias("_bytes"))


def _dealt(rows: DataFrame, columns: list[str], sizes: DataFrame) -> DataFrame:
    """Rows in tasks of about ``TASK_BYTES``: slices lie one after another, a row somewhere in its slice."""
    places, end = [], 0
    for row in sizes.collect():  # one row per slice
        places.append((*row, end))
        end += row[-1]
    known = rows.sparkSession.createDataFrame(places, T.StructType([*sizes.schema.fields, T.StructField("_before", T.LongType())]))
    at = F.col("_before") + F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.col("_bytes"))
    task = F.coalesce(F.call_function("div", at, F.lit(TASK_BYTES)), F.lit(0)).cast("int")
    placed = null_safe_join(rows, F.broadcast(known), columns, "left").withColumn("_task", task)
    return placed.repartitionById(-(-end // TASK_BYTES) or 1, F.col("_task")).drop("_bytes", "_before", "_task")


def write_run(rows: DataFrame, root: str, columns: list[str], run: str, sizes: DataFrame | None = None) -> None:
    """Write rows into folders of a run below their slices, unseen by readers. Slices are whole numbers.

    A task sorts its rows by slice. Where rows compress well, a limit on compressed bytes does not bound that sort,
    so ``sizes`` (see ``slice_bytes``) deals them by what they take in memory.
    """
    spread = rows.hint("rebalance", *[F.col(c) for c in columns]) if sizes is None else _dealt(rows, columns, sizes)
    spread.withColumn("run", F.lit(run)).write.mode("append").partitionBy(*columns, "run").parquet(f"{root}/data")


def forget_run(spark: SparkSession, root: str, run: str, depth: int) -> None:
    """Delete the folders of a run that is not published."""
    fs, pattern = _hadoop(spark, "/".join([f"{root}/data", *["*=*"] * depth, f"run={run}"]))
    for status in fs.globStatus(pattern) or []:
        fs.delete(status.getPath(), True)


def sweep_runs(spark: SparkSession, root: str, depth: int) -> int:
    """Delete the folders that the current state does not name, as killed and replaced runs leave them; how many.

    Not while a run or a reader of an older state is at work.
    """
    kept = {(tuple((k, str(v)) for k, v in s.values), s.run) for s in current(spark, root).slices}
    fs, pattern = _hadoop(spark, "/".join([f"{root}/data", *["*=*"] * depth, "run=*"]))
    gone = 0
    for status in fs.globStatus(pattern) or []:
        pieces = [p.partition("=") for p in status.getPath().toString().split("/")[-depth - 1:]]
        if (tuple((k, v) for k, _, v in pieces[:-1]), pieces[-1][2]) not in kept:
            fs.delete(status.getPath(), True)
            gone += 1
    return gone


def now_text() -> str:
    return datetime.now(timezone.utc).replace(tzinfo=None).isoformat(timespec="microseconds")
