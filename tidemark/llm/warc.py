"""WARC archives with a two-level capture index.

Archives hold one gzip member per record, so a record can be read by its offset and length alone. Their captures
are sorted by URL key (host reversed) into blocks of compressed lines. A sparse directory names the first key of
each block, and a manifest (Parquet) the first and last key of each part of the index, so that finding a key
takes a binary search in each and a range read of the blocks that can hold it.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import zlib
from bisect import bisect_left, bisect_right
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import filesystem, fresh, text_of
from tidemark.session import cut_lineage, scratch_path

#: Captures per compressed block, bytes at which an archive file ends, and rows per batch.
BLOCK_LINES, FILE_BYTES, BATCH_ROWS = 3_000, 1 << 30, 2_000
# Fixed values of the format.
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
CAPTURE = "key string, page_id long, file string, offset long, length long"
RECORD = "page_id long, record_type string, refers_to long, payload_bytes long, payload_digest string"


def url_key(url: str | None) -> str:
    """Reversed host, port if it is not the usual one, then path and query: ``com,example)/a?b``. Null: empty."""
    if not url:
        return ""
    try:
        parts = urlsplit(url.strip())
        host, port = parts.hostname or "", parts.port
    except ValueError:
        return url.strip()
    named = ",".join(reversed(host.split("."))) if host else ""
    if port and (parts.scheme.lower(), port) not in (("http", 80), ("https", 443)):
        named += f":{port}"
    return f"{named}){parts.path or '/'}" + (f"?{parts.query}" if parts.query else "")


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _name(page_id: int | None) -> str:
    return f"<urn:x-page:{'' if page_id is None else page_id}>"


def _page(name: str) -> int | None:
    digits = name[len("<urn:x-page:"):-1]
    return int(digits) if digits else None


def make_record(page_id, url, payload: bytes, refers_to, revisit: bool, date: str) -> bytes:
    body = HTTP_HEAD if revisit else HTTP_HEAD + payload
    target = (url or "").replace("\r", "%0D").replace("\n", "%0A")
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_name(page_id)}", f"WARC-Date: {date}",
             f"WARC-Target-URI: {target}", f"WARC-Payload-Digest: sha1:{payload_digest(payload)}"]
    if revisit:
        lines += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: {_name(refers_to)}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}", "", ""]
    return gzip.compress("\r\n".join(lines).encode() + body + b"\r\n\r\n", 6, mtime=0)


def parse_record(member: bytes) -> dict:
    """Headers and payload of one record; the payload is None for a revisit. A wrong digest is an error."""
    head, _, rest = gzip.decompress(member).partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    headers = dict(line.split(": ", 1) for line in lines[1:] if ": " in line)
    body = rest[:int(headers["Content-Length"])]
    digest = headers["WARC-Payload-Digest"].removeprefix("sha1:")
    payload = None if headers["WARC-Type"] == "revisit" else body.partition(b"\r\n\r\n")[2]
    if payload is not None and payload_digest(payload) != digest:
        raise ValueError(f"payload of {headers['WARC-Record-ID']} does not have its digest")
    return headers | {"payload": payload, "digest": digest}


def _write_archive(folder: str, date: str):
    def run(batches):
        files, place = filesystem(folder)
        out, name, at, rows = None, "", 0, []
        info = gzip.compress(f"WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:x-info:0>\r\nWARC-Date: {date}\r\nContent-Length: 0\r\n\r\n\r\n\r\n".encode(), 6, mtime=0)
        for batch in batches:
            for row in range(batch.num_rows):
                page_id, url, html, refers_to, revisit = (c[row].as_py() for c in batch.columns)
                if out is None or at > FILE_BYTES:
                    if out is not None:
                        out.close()
                    name, at = fresh("pages") + ".warc.gz", len(info)
                    out = files.open_output_stream(f"{place}/{name}", compression=None)
                    out.write(info)
                record = make_record(page_id, url, html.encode(), refers_to, revisit, date)
                out.write(record)
                rows.append((url_key(url), page_id, name, at, len(record)))
                at += len(record)
                if len(rows) == BATCH_ROWS:
                    yield _captures(rows)
                    rows = []
        if out is not None:
            out.close()
        yield _captures(rows)

    return run


def _captures(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [("key", pa.string()), ("page_id", pa.int64()), ("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64())]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, (_, kind) in enumerate(kinds)], names=[n for n, _ in kinds])


def write_archives(
    pages: DataFrame, folder: str, page_id: str = "page_id", url: str = "url", html: str = "html",
    least_revisit_bytes: int = 0, date: str = "1970-01-01T00:00:00Z",
) -> None:
    """One record per row into archives under ``folder``; their captures go to ``folder``/captures as Parquet.

    Of equal payloads of at least ``least_revisit_bytes``, the rows of the smallest page_id are responses and the
    others revisits of it. A payload that only rows without an id have is a response each time. Groups of equal
    payloads are counted before the shuffle; where few payloads repeat, no html is shuffled.
    """
    files, place = filesystem(folder)
    files.create_dir(place, recursive=True)
    rows = pages.select(F.col(f"`{page_id}`").cast("long").alias("page_id"), F.col(f"`{url}`").cast("string").alias("url"), text_of(html).alias("html"))
    bytes_of, size = F.sha1(F.col("html").cast("binary")), F.octet_length("html")
    groups = rows.select("page_id", bytes_of.alias("digest"), size.alias("size")).where(F.col("size") >= least_revisit_bytes)
    repeated = cut_lineage(groups.groupBy("digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").select("digest", "first"))
    marked = rows.withColumn("digest", F.when(size >= least_revisit_bytes, bytes_of)).join(repeated, "digest", "left")
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    ready = marked.select("page_id", "url", "html", "first", revisit.alias("revisit"))
    ready.mapInArrow(_write_archive(folder, date), CAPTURE).write.parquet(f"{folder}/captures")


def _write_index(folder: str, block_lines: int):
    def run(batches):
        files, place = filesystem(folder)
        name, blocks, at, lines, keys, total = fresh("index"), [], 0, [], [], 0
        with files.open_output_stream(f"{place}/{name}.cdx", compression=None) as out:

            def close_block():
                nonlocal at, lines, keys
                packed = zlib.compress("\n".join(lines).encode(), 6)
                out.write(packed)
                blocks.append((keys[0], at, len(packed)))
                at, lines, keys, last = at + len(packed), [], [], keys[-1]
                return last

            last = ""
            for batch in batches:
                for row in zip(*(c.to_pylist() for c in batch.columns)):
                    lines.append(json.dumps(row))
                    keys.append(row[0])
                    total += 1
                    if len(lines) == block_lines:
                        last = close_block()
            if lines:
                last = close_block()
        with files.open_output_stream(f"{place}/{name}.dir", compression=None) as out:
            out.write(json.dumps(blocks).encode())
        if total:
            yield pa.RecordBatch.from_pydict({"name": [name], "first": [blocks[0][0]], "last": [last], "blocks": [len(blocks)], "lines": [total]})

    return run


def write_index(spark: SparkSession, folder: str, block_lines: int = BLOCK_LINES) -> None:
    """Sort the captures of ``folder`` into index parts; a key with very many captures runs over several parts."""
    captures = spark.read.schema(CAPTURE).parquet(f"{folder}/captures")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = captures.repartitionByRange(parts, "key", "page_id").sortWithinPartitions("key", "page_id", "file", "offset")
    ordered.mapInArrow(_write_index(folder, block_lines), "name string, first string, last string, blocks long, lines long").write.parquet(f"{folder}/index")


class IndexPart:
    """One part of the index: its directory, and the block that was read last."""

    def __init__(self, files, path: str):
        with files.open_input_file(f"{path}.dir") as directory:
            self.blocks = json.loads(directory.read())
        self.firsts = [b[0] for b in self.blocks]
        self.file = files.open_input_file(f"{path}.cdx")
        self.number, self.rows, self.keys = -1, [], []

    def read(self, number: int) -> None:
        if number != self.number:
            _, offset, length = self.blocks[number]
            self.rows = [json.loads(line) for line in zlib.decompress(self.file.read_at(length, offset)).decode().split("\n")]
            self.keys, self.number = [r[0] for r in self.rows], number

    def find(self, key: str):
        """All captures of a key. It can begin in the block before the first that starts with it."""
        number = max(0, bisect_left(self.firsts, key) - 1)
        while number < len(self.blocks) and self.firsts[number] <= key:
            self.read(number)
            yield from self.rows[bisect_left(self.keys, key):bisect_right(self.keys, key)]
            number += 1


def lookup(keys: DataFrame, folder: str) -> DataFrame:
    """The captures of the distinct values of the string column ``key``: key, page_id, file, offset, length.

    Only the manifest of the index, a row per part, comes to the driver.
    """
    spark = keys.sparkSession
    parts = sorted((r["first"], r["last"], r["name"]) for r in spark.read.parquet(f"{folder}/index").collect())
    firsts, lasts, names = ([p[i] for p in parts] for i in range(3))

    def route(batches):
        for batch in batches:
            found = [(n, key) for key in batch.column(0).to_pylist() for n in range(bisect_left(lasts, key), bisect_right(firsts, key))]
            yield pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.string())], names=["part", "key"])

    def search(batches):
        files, place = filesystem(folder)
        number, part, rows = -1, None, []
        for batch in batches:
            for n, key in zip(*(c.to_pylist() for c in batch.columns)):
                if n != number:
                    number, part = n, IndexPart(files, f"{place}/{names[n]}")
                for row in part.find(key):
                    rows.append(tuple(row))
                    if len(rows) == BATCH_ROWS:
                        yield _captures(rows)
                        rows = []
        yield _captures(rows)

    routed = keys.select("key").distinct().mapInArrow(route, "part long, key string")
    return routed.repartitionByRange(max(1, len(parts)), "part").sortWithinPartitions("part", "key").mapInArrow(search, CAPTURE)


def read_records(captures: DataFrame, folder: str) -> DataFrame:
    """The records at the captures' places, by range reads in the order of the files."""

    def run(batches):
        files, place = filesystem(folder)
        name, file = "", None
        for batch in batches:
            out = []
            for here, offset, length in zip(*(c.to_pylist() for c in batch.columns)):
                if here != name:
                    name, file = here, files.open_input_file(f"{place}/{here}")
                found = parse_record(file.read_at(length, offset))
                refers = found.get("WARC-Refers-To")
                payload = found["payload"]
                out.append((_page(found["WARC-Record-ID"]), found["WARC-Type"], _page(refers) if refers else None, None if payload is None else len(payload), found["digest"]))
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], k) for i, k in enumerate(kinds)], names=["page_id", "record_type", "refers_to", "payload_bytes", "payload_digest"])

    parts = int(captures.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = captures.select("file", "offset", "length").repartitionByRange(parts, "file", "offset").sortWithinPartitions("file", "offset")
    return placed.mapInArrow(run, RECORD)


def resolve_revisits(records: DataFrame) -> DataFrame:
    """Records with the payload size of a revisit taken from the response it refers to."""
    records = cut_lineage(records)
    sizes = records.where("record_type = 'response' and page_id is not null").groupBy("page_id", "payload_digest").agg(F.max("payload_bytes").alias("bytes"))
    sizes = sizes.select(F.col("page_id").alias("target"), F.col("payload_digest").alias("target_digest"), "bytes")
    again = records.where("record_type = 'revisit'")
    joined = again.join(cut_lineage(sizes), (again.refers_to == F.col("target")) & (again.payload_digest == F.col("target_digest")), "left")
    return records.where("record_type = 'response'").unionByName(joined.select("page_id", "record_type", "refers_to", F.col("bytes").alias("payload_bytes"), "payload_digest"))


def archive_round_trip(pages: DataFrame, folder: str | None = None, url: str = "url", **options) -> DataFrame:
    """Write archives and index, look every page's key up in the index, and read the records found.

    Per row: page_id, payload_bytes, payload_digest, record_type, refers_to.
    """
    spark = pages.sparkSession
    folder = folder or scratch_path(spark, "warc")
    write_archives(pages, folder, url=url, **options)
    write_index(spark, folder)
    keyed = F.arrow_udf(lambda urls: pa.array([url_key(u) for u in urls.to_pylist()], pa.string()), "string")
    captures = lookup(pages.select(keyed(F.col(f"`{url}`").cast("string")).alias("key")), folder)
    return resolve_revisits(read_records(captures, folder)).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
