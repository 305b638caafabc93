"""What the training-data operators share: text columns, row-wise Arrow functions, shared files."""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Callable, Sequence
from urllib.parse import urlparse

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Characters of text that one step inside a task works on, so that memory does not follow the batch.
PIECE_CHARS = 1_000_000


def text_of(column: str = "text") -> Column:
    """The text, null as empty."""
    return F.coalesce(F.col(f"`{column}`").cast("string"), F.lit(""))


def ascii_lower(column: Column) -> Column:
    """A-Z only; ``lower`` would change other alphabets too."""
    return F.translate(column, ASCII_UPPER, ASCII_UPPER.lower())


def fold_of(column: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id is in no fold."""
    return F.crc32(F.col(f"`{column}`").cast("string").cast("binary")) % folds


def fold_of_id(value: int, folds: int) -> int:
    return zlib.crc32(str(value).encode()) % folds


def pieces(texts: Sequence[str], most: int = PIECE_CHARS):
    """Consecutive runs of whole texts, each of about ``most`` characters or of a single longer text."""
    run, chars = [], 0
    for text in texts:
        run.append(text)
        chars += len(text)
        if chars >= most:
            yield run
            run, chars = [], 0
    if run:
        yield run


def row_wise(df: DataFrame, keep: Sequence[str], text: str, schema: str, make: Callable[[], Callable[[list[str]], list]]) -> DataFrame:
    """One output row per input row: ``keep`` columns as they are, then the columns of ``schema``.

    ``make()`` runs once per task and gives a function from a list of texts to a list of arrays, one per
    column of ``schema``. Only the named columns are read, so other columns may have any names.
    """
    chosen = df.select(*[F.col(f"`{k}`") for k in keep], text_of(text).alias("text"))
    kept_types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in chosen.schema.fields[:-1])
    width = len(keep)

    def run(batches):
        fn = make()
        for batch in batches:
            texts, start = batch.column(width).to_pylist(), 0
            for part in pieces(texts):
                made = fn(part)
                left = [c.slice(start, len(part)) for c in batch.columns[:width]]
                start += len(part)
                yield pa.RecordBatch.from_arrays([*left, *made], names=[f"c{i}" for i in range(width + len(made))])

    return chosen.mapInArrow(_renamed(run, [*keep, *_names(schema)]), f"{kept_types}, {schema}" if keep else schema)


def _names(schema: str) -> list[str]:
    return [f.name for f in StructType.fromDDL(schema)]


def _renamed(fn, names):
    def run(batches):
        for batch in fn(batches):
            yield pa.RecordBatch.from_arrays(batch.columns, names=names)

    return run


def filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a shared folder, and the path in it. Works for file:, s3:, gs: and hdfs: addresses."""
    if urlparse(uri).scheme in ("", "file"):
        return pafs.LocalFileSystem(), urlparse(uri).path
    return pafs.FileSystem.from_uri(uri)


def fresh(prefix: str) -> str:
    """A name no other attempt of the same task uses."""
    return f"{prefix}-{uuid.uuid4().hex}"
