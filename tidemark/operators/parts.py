"""Greedy part numbers under a size cap, exact for streams of any length.

A stream fills a part until the next record would exceed the cap. Where a part ends depends on all
parts before it, yet a piece of the stream only needs one number from its past: the bytes already
in the open part. So each chunk is reduced to a step function of that number, the functions are
chained in a tree of bounded fan-in, and then every chunk is numbered on its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.ordered import GROUP_BYTES, GROUP_ROWS, chunks_needed, null_safe_join, ordered_chunks
from tidemark.session import cut_lineage

_STEP_SCHEMA = "total long, edges array<long>, opened array<long>, filled array<long>, zero_opened long, zero_filled long"


@dataclass
class Steps:
    """Effect of a run of records on the open part.

    Entering with ``c > 0`` bytes, the first ``edges`` value above ``cap - c`` tells the entry:
    parts opened on the way and bytes in the last one. No such edge: nothing opens, ``total`` is added.
    """

    total: int
    edges: np.ndarray
    opened: np.ndarray
    filled: np.ndarray
    zero: tuple[int, int]

    def after(self, held: np.ndarray, cap: int) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(self.edges, cap - held, side="right")
        inside = at < len(self.edges)
        safe = np.where(inside, at, 0)
        opened = np.where(inside, self.opened[safe], 0)
        filled = np.where(inside, self.filled[safe], held + self.total)
        empty = held == 0
        return np.where(empty, self.zero[0], opened), np.where(empty, self.zero[1], filled)

    def compact(self, cap: int) -> Steps:
        """Drop edges no entry can reach, and merge neighbours with the same effect."""
        reach = np.searchsorted(self.edges, cap, side="right") + 1
        edges, opened, filled = self.edges[:reach], self.opened[:reach], self.filled[:reach]
        keep = np.ones(len(edges), dtype=bool)
        keep[:-1] = (opened[1:] != opened[:-1]) | (filled[1:] != filled[:-1])
        return Steps(self.total, edges[keep], opened[keep], filled[keep], self.zero)

    def row(self) -> dict:
        return {"total": self.total, "edges": self.edges, "opened": self.opened, "filled": self.filled,
                "zero_opened": self.zero[0], "zero_filled": self.zero[1]}

    @staticmethod
    def of(row) -> Steps:
        arrays = (np.asarray(a, dtype=np.int64) for a in (row.edges, row.opened, row.filled))
        return Steps(int(row.total), *arrays, (int(row.zero_opened), int(row.zero_filled)))


def next_starts(sizes: np.ndarray, cap: int) -> tuple[np.ndarray, np.ndarray]:
    """Running ends of the records, and for a part begun at each record the start of the part after it."""
    ends = np.cumsum(sizes)
    n = len(sizes)
    positive = np.where(sizes > 0, np.arange(n), n)
    first_filled = np.minimum.accumulate(positive[::-1])[::-1]
    full = np.searchsorted(ends, ends - sizes + cap, side="right")
    return ends, np.minimum(np.maximum(full, first_filled + 1), n)


def steps_of(sizes: np.ndarray, cap: int) -> Steps:
    ends, following = next_starts(sizes, cap)
    n = len(sizes)
    reach = min(int(np.searchsorted(ends, cap, side="right")) + 1, n)
    at = np.arange(reach)
    opened = np.ones(reach, dtype=np.int64)
    while True:
        going = following[at] < n
        if not going.any():
            break
        at = np.where(going, following[at], at)
        opened = opened + going
    filled = ends[-1] - (ends[at] - sizes[at])
    zero = (int(opened[0]) - 1, int(filled[0]))
    return Steps(int(ends[-1]), ends[:reach], opened, filled, zero).compact(cap)


def chain(first: Steps, second: Steps, cap: int) -> Steps:
    more, filled = second.after(first.filled, cap)
    start_opened, start_filled = second.after(np.array([first.zero[1]]), cap)
    return Steps(
        first.total + second.total,
        np.concatenate([first.edges, second.edges + first.total]),
        np.concatenate([first.opened + more, second.opened]),
        np.concatenate([filled, second.filled]),
        (first.zero[0] + int(start_opened[0]), int(start_filled[0])),
    ).compact(cap)


def part_numbers(sizes: np.ndarray, cap: int, held: int, part: int) -> tuple[np.ndarray, int]:
    """Part of each record, entering with ``held`` bytes in part number ``part``; and the bytes held after."""
    ends, following = next_starts(sizes, cap)
    n = len(sizes)
    starts = np.zeros(n, dtype=np.int64)
    at = int(following[0]) if held == 0 else int(np.searchsorted(ends, cap - held, side="right"))
    left = held + int(ends[-1])
    while at < n:
        starts[at] = 1
        left = int(ends[-1] - ends[at] + sizes[at])
        at = int(following[at])
    return part + np.cumsum(starts), left


def _runs(batch: pa.RecordBatch, stream: str) -> Iterator[tuple[tuple, int, int]]:
    """Neighbouring rows of the same stream and chunk: their key, first row and end."""
    if not batch.num_rows:
        return
    names, chunk = batch.column(stream), batch.column("_chunk").to_numpy()
    codes = names.dictionary_encode().indices.fill_null(-1).to_numpy()
    cuts = (np.flatnonzero((codes[1:] != codes[:-1]) | (chunk[1:] != chunk[:-1])) + 1).tolist()
    for low, high in zip([0, *cuts], [*cuts, batch.num_rows]):
        yield (names[low].as_py(), int(chunk[low])), low, high


def _sizes(batch: pa.RecordBatch, size: str) -> np.ndarray:
    return batch.column(size).fill_null(0).to_numpy().astype(np.int64)


def _steps_batch(rows: list[tuple[tuple, Steps]], stream: str, kind: pa.DataType) -> pa.RecordBatch:
    keys, steps = zip(*rows)
    numbers = pa.list_(pa.int64())
    columns = {stream: pa.array([k[0] for k in keys], kind), "node": pa.array([k[1] for k in keys], pa.int64())}
    for name, type_ in (("total", pa.int64()), ("edges", numbers), ("opened", numbers), ("filled", numbers)):
        columns[name] = pa.array([getattr(s, name) for s in steps], type_)
    for at, name in enumerate(("zero_opened", "zero_filled")):
        columns[name] = pa.array([s.zero[at] for s in steps], pa.int64())
    return pa.RecordBatch.from_pydict(columns)


def _entries(nodes: DataFrame, stream: str, group: list[str], cap: int, field: T.StructField) -> DataFrame:
    """Walk the nodes of each group in order: bytes held and part number on entering each of them."""
    def walk(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("node")
        held, part, rows = int(pdf["held"].iloc[0]), int(pdf["part"].iloc[0]), []
        for row in pdf.itertuples(index=False):
            rows.append((row.node, held, part))
            opened, filled = Steps.of(row).after(np.array([held]), cap)
            held, part = int(filled[0]), part + int(opened[0])
        out = pd.DataFrame(rows, columns=["node", "held", "part"])
        out.insert(0, stream, pdf[stream].iloc[0])
        return out

    schema = T.StructType([field, *T.StructType.fromDDL("node long, held long, part long").fields])
    return nodes.groupBy(*group).applyInPandas(walk, schema)


def _chunk_entries(cut: DataFrame, stream: str, order: list[str], size: str, cap: int, fan_in: int) -> DataFrame:
    """(stream, chunk, held, part) on entering each chunk of the streams that lie in several.

    At most two rows per chunk: a chunk holds whole streams and at most the ends of two others.
    """
    field = cut.schema[stream]
    schema = T.StructType([field, T.StructField("node", T.LongType()), *T.StructType.fromDDL(_STEP_SCHEMA).fields])

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, steps, kind = None, None, None
        for batch in batches:
            sizes, kind, done = _sizes(batch, size), batch.schema.field(stream).type, []
            for run_key, low, high in _runs(batch, stream):
                one = steps_of(sizes[low:high], cap)
                if run_key == key:
                    steps = chain(steps, one, cap)
                    continue
                if key is not None:
                    done.append((key, steps))
                key, steps = run_key, one
            if done:
                yield _steps_batch(done, stream, kind)
        if key is not None:
            yield _steps_batch([(key, steps)], stream, kind)

    def fold(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("node")
        steps = None
        for row in pdf.itertuples(index=False):
            steps = Steps.of(row) if steps is None else chain(steps, Steps.of(row), cap)
        return pd.DataFrame([{stream: pdf[stream].iloc[0], "node": int(pdf["_parent"].iloc[0]), **steps.row()}])

    spread = cut.groupBy(stream).agg(F.min("_chunk").alias("_low"), F.max("_chunk").alias("_high"))
    spread = F.broadcast(spread.filter("_low < _high").select(stream))
    narrow = null_safe_join(cut.select(stream, "_chunk", *order, size), spread, [stream], "left_semi")
    narrow = narrow.sortWithinPartitions(stream, *order).select(stream, "_chunk", size)
    levels = [cut_lineage(narrow.mapInArrow(summarise, schema))]
    width = (levels[0].agg(F.max("node")).first()[0] or 0) + 1
    parent = F.floor(F.col("node") / fan_in).alias("_parent")
    while width > fan_in:
        grouped = levels[-1].select("*", parent).groupBy(stream, "_parent")
        levels.append(cut_lineage(grouped.applyInPandas(fold, schema)))
        width = -(-width // fan_in)
    top = levels[-1].withColumns({"held": F.lit(0).cast("long"), "part": F.lit(1).cast("long")})
    entries = _entries(top, stream, [stream], cap, field)
    for nodes in reversed(levels[:-1]):
        known = entries.withColumnRenamed("node", "_parent")
        below = null_safe_join(nodes.select("*", parent), known, [stream, "_parent"])
        entries = _entries(below, stream, [stream, "_parent"], cap, field)
    return entries.withColumnRenamed("node", "_chunk")


def assign_parts(df: DataFrame, stream: str, order: list[str], size: str, cap: int = 250 * 1024 * 1024,
                 max_rows: int = GROUP_ROWS, max_bytes: int = GROUP_BYTES, fan_in: int = 32) -> DataFrame:
    """Add ``part``: records of a stream, in ``order``, share a part while their sizes stay within ``cap``.

    A record larger than the cap has a part of its own. ``size`` counts bytes as an integer of at
    least 0. While all streams stay within ``max_rows`` and ``max_bytes`` a task numbers whole
    streams; otherwise the sequence is cut into chunks within those measures, and a chunk starts
    from what the chunks before it leave. Rows pass through Python in sorted Arrow batches, so no
    task holds a stream in memory and no value changes its type.
    """
    chunks = chunks_needed(df, [stream], max_rows, size, max_bytes)
    if chunks:
        cut = ordered_chunks(df, [stream], order, chunks).withColumn("_chunk", F.col("_chunk").cast("long"))
        entries = F.broadcast(_chunk_entries(cut, stream, order, size, cap, fan_in))
        ready = null_safe_join(cut, entries, [stream, "_chunk"], "left")
    else:
        ready = df.repartition(stream).withColumns({c: F.lit(None).cast("long") for c in ("held", "part")})
        ready = ready.withColumn("_chunk", F.lit(0).cast("long"))
    ready = ready.fillna({"held": 0, "part": 1}).sortWithinPartitions(stream, *order)
    columns = list(df.columns)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, part = None, 0, 1
        for batch in batches:
            sizes, numbers = _sizes(batch, size), []
            for run_key, low, high in _runs(batch, stream):
                if run_key != key:
                    key, held, part = run_key, batch.column("held")[low].as_py(), batch.column("part")[low].as_py()
                parts, held = part_numbers(sizes[low:high], cap, held, part)
                part = int(parts[-1])
                numbers.append(parts)
            if numbers:
                kept = [batch.column(c) for c in columns]
                yield pa.RecordBatch.from_arrays([*kept, pa.array(np.concatenate(numbers))], names=[*columns, "part"])

    schema = T.StructType([*df.schema.fields, T.StructField("part", T.LongType())])
    return ready.mapInArrow(number, schema)
