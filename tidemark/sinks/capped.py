"""Files that are closed by the bytes really written, as a Spark data source with a commit protocol.

Each task writes the batches it gets, in their order, and closes a file when the next rows would take it over the
cap or, with leading key columns, when the key changes. It reports what it wrote. Only when all tasks are done do
the files of the attempts that count move from the run's own folder to the target, with the manifest of them; if a
task fails, the run's folder is deleted. Rows are read once and the layout is the same whatever their sizes.
"""

from __future__ import annotations

import gzip
import json
import os
import time
import uuid
from collections.abc import Iterator
from dataclasses import asdict, dataclass
from urllib.parse import unquote, urlparse

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from tidemark.session import prepare

MANIFEST = "_manifest"
_FILE = "name string, key string, rows bigint, bytes bigint, file_bytes bigint, started double, finished double"
#: What a parquet file takes besides its pages: at least, per column, and per column and row group.
_FOOTER, _COLUMN, _CHUNK = 2_048, 256, 256
#: Copies of a row group's smallest and largest values that the footer holds, and the page headers again.
_EXTREMES = 2
#: A row group holds at most this share of a file's cap and so many bytes in memory.
_GROUP_SHARE, _GROUP_BYTES = 8, 64 * 1024 * 1024


def store_of(address: str) -> tuple[pafs.FileSystem, str]:
    """The file system of an address and the path in it."""
    parts = urlparse(address)
    if parts.scheme in ("", "file"):
        return pafs.LocalFileSystem(), unquote(parts.path)
    return pafs.FileSystem.from_uri(address)


@dataclass
class Written:
    """A closed file: its name, key, rows, bytes before compression, bytes on disk, and when it was begun and closed."""

    name: str
    key: str | None
    rows: int
    bytes: int
    file_bytes: int
    started: float
    finished: float


@dataclass
class TaskFiles(WriterCommitMessage):
    files: list[Written]


class _Output:
    """An open file in a store, which counts what is written to it."""

    def __init__(self, store: pafs.FileSystem, folder: str, name: str, key: str | None):
        self.name, self.key, self.rows, self.raw, self.started = name, key, 0, 0, time.time()
        self.sink = store.open_output_stream(f"{folder}/{name}", compression=None)

    def closed(self) -> Written:
        self.finish()
        size = self.sink.tell()
        self.sink.close()
        return Written(self.name, self.key, self.rows, self.raw, size, self.started, time.time())


class _Lines(_Output):
    """Ready lines, maybe below a header and gzipped; the cap is on the bytes before compression."""

    def __init__(self, store, folder, name, key, options):
        super().__init__(store, folder, name, key)
        self.out = gzip.GzipFile(fileobj=self.sink, mode="wb", mtime=0, compresslevel=int(options.get("level", 6))) if options.get("gzip") == "true" else self.sink
        header = options.get("header", "").encode()
        self.out.write(header)
        self.raw = self.head = len(header)

    def put(self, lines: _LineBatch, low: int, high: int) -> None:
        self.out.write(lines.data[lines.ends[low]:lines.ends[high]])
        self.raw += int(lines.ends[high] - lines.ends[low])
        self.rows += high - low

    def fits(self, lines: _LineBatch, low: int, high: int, cap: int) -> int:
        """Where the rows that still fit end; a first row always does."""
        end = int(np.searchsorted(lines.ends, lines.ends[low] + cap - self.raw, "right")) - 1
        return min(high, max(end, low + (self.rows == 0)))

    def finish(self) -> None:
        if self.out is not self.sink:
            self.out.close()


class _LineBatch:
    """The bytes of an Arrow text column and where its rows end in them."""

    def __init__(self, batch: pa.RecordBatch, keys: int):
        column = batch.column(keys)
        wide = pa.types.is_large_string(column.type)
        _, offsets, data = column.buffers()
        self.ends = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
        self.data = memoryview(data) if data is not None else memoryview(b"")


class _Parquet(_Output):
    """Snappy parquet whose size on disk stays within the cap: a row group is written only if it fits uncompressed."""

    def __init__(self, store, folder, name, key, options):
        super().__init__(store, folder, name, key)
        self.writer, self.groups, self.footer = None, 0, 0

    def put(self, rows: _Rows, low: int, high: int) -> None:
        part = pa.Table.from_batches([rows.batch.slice(low, high - low)])
        if self.writer is None:
            self.writer = pq.ParquetWriter(self.sink, part.schema, compression="snappy")
        self.writer.write_table(part, row_group_size=high - low)
        self.groups += 1
        self.footer += _EXTREMES * rows.largest(low, high)
        self.rows += high - low
        self.raw += part.nbytes

    def fits(self, rows: _Rows, low: int, high: int, cap: int) -> int:
        columns = rows.batch.num_columns
        room = cap - self.sink.tell() - self.footer - _FOOTER - _COLUMN * columns - _CHUNK * columns * (self.groups + 1)
        group = min(room, cap // _GROUP_SHARE, _GROUP_BYTES)
        end = int(np.searchsorted(rows.ends, rows.ends[low] + group, "right")) - 1
        while end > low:  # smallest and largest values stand in page headers and the footer too
            held = rows.ends[end] - rows.ends[low] + 2 * _EXTREMES * rows.largest(low, end)
            if held <= group:
                break
            end = low + (end - low) // 2
        alone = self.rows == 0 or (1 + 2 * _EXTREMES) * rows.largest(low, low + 1) <= room  # a row group of one larger row
        return min(high, max(end, low + alone))

    def finish(self) -> None:
        if self.writer is not None:
            self.writer.close()


class _Rows:
    """A batch and, per row, where its bytes would end if the rows lay one after another."""

    def __init__(self, batch: pa.RecordBatch, keys: int):
        self.batch = batch.select(range(keys, batch.num_columns))
        sizes = np.zeros(batch.num_rows, np.int64)
        for column in self.batch.columns:
            sizes += _row_bytes(column)
        self.ends = np.concatenate([[0], np.cumsum(sizes)])

    def largest(self, low: int, high: int) -> int:
        return int(np.diff(self.ends[low:high + 1]).max())


def _row_bytes(column: pa.Array) -> np.ndarray:
    """Bytes of each value: exact for texts and fixed widths, nested ones by their parts."""
    kind = column.type
    n = len(column)
    if pa.types.is_string(kind) or pa.types.is_binary(kind) or pa.types.is_large_string(kind) or pa.types.is_large_binary(kind):
        width = np.int64 if pa.types.is_large_string(kind) or pa.types.is_large_binary(kind) else np.int32
        return np.diff(np.frombuffer(column.buffers()[1], width)[column.offset:column.offset + n + 1].astype(np.int64)) + 5 if n else np.zeros(0, np.int64)
    if pa.types.is_list(kind) or pa.types.is_map(kind):
        ends = np.concatenate([[0], np.cumsum(_row_bytes(column.values if pa.types.is_list(kind) else pa.StructArray.from_arrays([column.keys, column.items], ["k", "v"])))])
        offsets = column.offsets.to_numpy()
        return ends[offsets[1:]] - ends[offsets[:-1]] + 5
    if pa.types.is_struct(kind):
        return sum((_row_bytes(column.field(i)) for i in range(kind.num_fields)), np.ones(n, np.int64))
    return np.full(n, (getattr(kind, "bit_width", 64) + 7) // 8 + 1, np.int64)


def _runs(batch: pa.RecordBatch, keys: int) -> list[tuple[str | None, int, int]]:
    """(key, low, high) of neighbouring rows of one key; the key's columns are joined by slashes."""
    n = batch.num_rows
    if not keys:
        return [(None, 0, n)]
    columns = [batch.column(i).to_pylist() for i in range(keys)]
    names = ["/".join("" if v is None else str(v) for v in row) for row in zip(*columns)]
    cuts = [0, *[i for i in range(1, n) if names[i] != names[i - 1]], n]
    return [(names[a], a, b) for a, b in zip(cuts, cuts[1:])]


class CappedWriter(DataSourceArrowWriter):
    def __init__(self, options: dict):
        self.options = dict(options)
        self.run = self.options["staging"]

    def write(self, iterator: Iterator[pa.RecordBatch]) -> TaskFiles:
        options, keys, files = self.options, int(self.options["keys"]), []
        cap, most, suffix = int(options["maxbytes"]), int(options["maxrows"]), options["suffix"]
        kind, wrap = (_Parquet, _Rows) if options["kind"] == "parquet" else (_Lines, _LineBatch)
        store, folder = store_of(self.run)
        task, out, attempt = TaskContext.get().partitionId(), None, uuid.uuid4().hex[:12]
        for batch in iterator:
            if not batch.num_rows:
                continue
            rows = wrap(batch, keys)
            for key, low, high in _runs(batch, keys):
                while low < high:
                    if out is not None and (out.key != key or out.rows >= most):
                        files.append(out.closed())
                        out = None
                    if out is None:
                        out = kind(store, folder, f"part-{task:05d}-{len(files):05d}-{attempt}{suffix}", key, options)
                    end = min(out.fits(rows, low, high, cap), low + most - out.rows)
                    if end > low:
                        out.put(rows, low, end)
                        low = end
                    if low < high:
                        full = kind is _Lines or out.fits(rows, low, high, cap) <= low
                        if full and out.rows:
                            files.append(out.closed())
                            out = None
        if out is not None:
            files.append(out.closed())
        return TaskFiles(files)

    def commit(self, messages: list[TaskFiles | None]) -> None:
        store, staged = store_of(self.run)
        _, target = store_of(self.options["target"])
        files = [f for m in messages if m for f in m.files]
        store.create_dir(f"{staged}/{MANIFEST}", recursive=True)
        named = f"{MANIFEST}/{uuid.uuid4().hex}.json"
        with store.open_output_stream(f"{staged}/{named}") as out:
            out.write("".join(json.dumps(asdict(f)) + "\n" for f in files).encode())
        kept = {f.name for f in files}
        for info in store.get_file_info(pafs.FileSelector(staged)):  # of attempts that do not count
            if info.type == pafs.FileType.File and info.base_name not in kept:
                store.delete_file(info.path)
        if self.options["mode"] == "overwrite" and store.get_file_info(target).type != pafs.FileType.NotFound:
            store.delete_dir(target)
        if store.get_file_info(target).type == pafs.FileType.NotFound:
            store.create_dir(os.path.dirname(target), recursive=True)
            store.move(staged, target)
            return
        store.create_dir(f"{target}/{MANIFEST}", recursive=True)
        for f in files:
            store.move(f"{staged}/{f.name}", f"{target}/{f.name}")
        store.move(f"{staged}/{named}", f"{target}/{named}")  # last: readers by the manifest see all of them or none
        store.delete_dir(staged)

    def abort(self, messages: list[TaskFiles | None]) -> None:
        _drop(self.run)


class CappedFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return "tidemark_capped"

    def writer(self, schema, overwrite: bool) -> CappedWriter:
        return CappedWriter(self.options)


def _exists(path: str) -> bool:
    store, place = store_of(path)
    return store.get_file_info(place).type != pafs.FileType.NotFound


def _drop(folder: str) -> None:
    """Delete a run's folder, also while tasks that are being stopped still close their files in it."""
    store, place = store_of(folder)
    for wait in (0.0, 0.1, 0.5, 2.0):
        time.sleep(wait)
        if not _exists(folder):
            return
        try:
            store.delete_dir(place)
        except OSError:
            continue


def write_capped(df: DataFrame, path: str, kind: str, max_bytes: int, suffix: str, mode: str = "errorifexists", max_rows: int | None = None,
                 keys: int = 0, **options: str) -> None:
    """Write ``df`` below ``path`` in files of at most ``max_bytes`` (but for a single larger row) and ``max_rows``.

    ``kind`` is ``parquet``, or ``lines`` for one text column whose values end their lines. The first ``keys``
    columns name a file's key and are not written; a task's rows should come in their order.
    """
    if mode not in ("errorifexists", "error", "overwrite", "append", "ignore"):
        raise ValueError(f"unknown mode {mode!r}")
    spark = prepare(df.sparkSession)
    if _exists(path):
        if mode == "ignore":
            return
        if mode in ("errorifexists", "error"):
            raise FileExistsError(f"{path} already exists")
    spark.dataSource.register(CappedFiles)
    target = path.rstrip("/")
    folder, _, name = target.rpartition("/")
    given = {"target": target, "staging": f"{folder}/_{name}-{uuid.uuid4().hex}", "kind": kind, "maxbytes": max_bytes, "maxrows": max_rows or 1 << 62,
             "suffix": suffix, "keys": keys, "mode": mode, **options}
    store, staged = store_of(given["staging"])
    store.create_dir(staged, recursive=True)  # here and not in tasks, so that none that outlives an abort brings it back
    try:
        df.write.format("tidemark_capped").mode("append").options(**given).save()
    finally:
        _drop(given["staging"])


def csv_lines(df: DataFrame, *keys: str) -> tuple[DataFrame, str]:
    """Rows as CSV lines behind their key columns, and the header line."""
    fields = [c for c in df.columns if c not in keys]
    plain = df.select(*keys, F.concat(F.to_csv(F.struct(*[F.col(f"`{c}`") for c in fields]), {"escape": '"'}), F.lit("\n")).alias("line"))
    quoted = [f'"{c.replace(chr(34), chr(34) * 2)}"' if any(s in c for s in ',"\n\r') else c for c in fields]
    return plain, ",".join(quoted) + "\n"


def json_line(*columns: str) -> Column:
    return F.concat(F.to_json(F.struct(*[F.col(f"`{c}`") for c in columns]), {"ignoreNullFields": "false"}), F.lit("\n"))


def written_files(spark: SparkSession, path: str) -> DataFrame:
    """The manifest of a folder: one row per file with its key, rows, bytes before compression and on disk, start and end."""
    rows = spark.read.schema(_FILE).json(f"{path}/{MANIFEST}")
    return rows.select(F.concat(F.lit(f"{path}/"), "name").alias("file_path"), "key", "rows", "bytes", "file_bytes",
                       F.timestamp_micros((F.col("started") * 1_000_000).cast("bigint")).alias("started_at"),
                       F.timestamp_micros((F.col("finished") * 1_000_000).cast("bigint")).alias("finished_at"))
