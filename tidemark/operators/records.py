"""A Python function over records, in parallel, with a choice of what an error does."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema


def map_records(df: DataFrame, fn: Callable[[dict], dict], schema: str, on_error: str = "fail") -> DataFrame:
    """``fn`` over each record, batch by batch where the record already is: no shuffle.

    ``fail`` lets the first error stop the job; ``collect`` adds ``ok`` and ``error`` columns and
    leaves the outputs of a failed record null; ``skip`` drops failed records.
    """
    if on_error not in ("fail", "collect", "skip"):
        raise ValueError(f"unknown policy {on_error!r}")
    out_schema = T.StructType.fromDDL(f"{schema}, ok boolean, error string" if on_error == "collect" else schema)
    arrow_schema = to_arrow_schema(out_schema)

    def converted(rows: list[dict]) -> list[pa.RecordBatch]:
        """The rows as Arrow. A batch that cannot be converted is halved until the rows at fault stand alone."""
        try:
            return [pa.RecordBatch.from_pylist(rows, schema=arrow_schema)]
        except Exception as error:
            if on_error == "fail":
                raise
            if len(rows) == 1:
                return [failed(error)] if on_error == "collect" else []
        half = len(rows) // 2
        return converted(rows[:half]) + converted(rows[half:])

    def failed(error: Exception) -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist([failure(error)], schema=arrow_schema)

    def failure(error: Exception) -> dict:
        return {"ok": False, "error": f"{type(error).__name__}: {error}"}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for record in batch.to_pylist():
                try:
                    rows.append({**fn(record), "ok": True} if on_error == "collect" else {**fn(record)})
                except Exception as error:
                    if on_error == "fail":
                        raise
                    if on_error == "collect":
                        rows.append(failure(error))
            if rows:
                yield from converted(rows)

    return df.mapInArrow(run, out_schema)


def map_record_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str) -> DataFrame:
    """``fn`` over whole Arrow batches, for functions that work on columns; any error stops the job."""
    names = [f.name for f in T.StructType.fromDDL(schema).fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield fn(batch).select(names)

    return df.mapInArrow(run, schema)
