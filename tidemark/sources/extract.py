"""Reading tables: windows, page envelopes, parameterised rows, text lines, worksheet contracts."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import clock, texts

# Names that may appear in a query text.
_TABLE = re.compile(r"^[A-Za-z0-9_.]+$")
_COLUMN = re.compile(r"^[A-Za-z0-9_]+$")


def checked_table(name: str) -> str:
    if not _TABLE.match(name):
        raise ValueError(f"invalid table name: {name!r}")
    return name


def checked_column(name: str) -> str:
    if not _COLUMN.match(name):
        raise ValueError(f"invalid identifier: {name!r}")
    return name


def extract_window(df: DataFrame, ts: str, start, end, closed: str = "both", fields=None, extra=None,
                   max_rows: int | None = None, order=()) -> DataFrame:
    """Rows of a time window, optionally narrowed by a predicate, to some fields, and to the first rows in an order.

    The bounds are literals on the bare column, so they and the fields reach the file scan.
    """
    if max_rows is not None and not order:
        raise ValueError("max_rows needs an order")
    opened, closing = clock.instant(start), clock.instant(end)
    if clock.utc_naive(start) > clock.utc_naive(end):
        raise ValueError("start is after end")
    out = df.filter(clock.within(F.col(ts), opened, closing, closed))
    if extra is not None:
        out = out.filter(extra)
    if max_rows is not None:
        out = out.orderBy(*order).limit(max_rows)
    return out.select(*fields) if fields else out


def flatten_envelope(df: DataFrame, body: str, row_schema: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per element of each page's ``result``; a null, missing or empty list gives none."""
    pages = F.from_json(F.col(body), f"result array<struct<{row_schema}>>")
    return df.select(*keep, F.explode(pages["result"]).alias("_row")).select(*keep, "_row.*")


def query_rows(spark: SparkSession, sql_or_table: str, params: dict[str, object], order_by: str | None = None,
               limit: int | None = None) -> DataFrame:
    """``SELECT * FROM table WHERE c1 = :c1 AND ... ORDER BY ... LIMIT n``, or a SQL text with ``:name`` marks.

    All rows, unless the caller states a limit, which needs an order.

    Names are checked and values are bound, never pasted; a null value matches no row, as in SQL.
    """
    if limit is not None and not order_by:
        raise ValueError("a limit needs order_by")
    if re.match(r"\s*(select|with)\s", sql_or_table, re.I):
        rows = spark.sql(sql_or_table, args=dict(params))
    else:
        tests = " AND ".join(f"{checked_column(c)} = :{c}" for c in params)
        where = f" WHERE {tests}" if tests else ""
        rows = spark.sql(f"SELECT * FROM {checked_table(sql_or_table)}{where}", args=dict(params))
    rows = rows.orderBy(checked_column(order_by)) if order_by else rows
    return rows if limit is None else rows.limit(limit)


def read_lines_utf8(spark: SparkSession, path: str) -> DataFrame:
    """Text lines, without those that are not valid UTF-8."""
    return spark.read.text(path).filter(F.is_valid_utf8("value"))


def read_header_csv(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """CSV whose first line is the header; all columns are text unless a schema is declared."""
    reader = spark.read.option("header", True).option("escape", '"')
    return (reader.schema(schema) if schema else reader).csv(path)


def worksheet_contract(df: DataFrame, required: list[str], hash_cols: list[str] | None = None,
                       link_col: str = "link", date_cols: tuple[str, ...] = (), zone: str = "UTC",
                       formats=clock.WORKSHEET_FORMATS) -> DataFrame:
    """Required columns in order, dates read as UTC, and a hash that tells changed rows.

    The hash covers the required columns without the link, unless columns are named.
    """
    if not required:
        raise ValueError("required columns missing")
    hash_cols = list(hash_cols) if hash_cols else [c for c in required if c != link_col]
    stray = [c for c in hash_cols if c not in required]
    if stray:
        raise ValueError(f"hash columns not in required columns: {stray}")
    absent = [c for c in required if c not in df.columns]
    if absent:
        raise ValueError(f"worksheet lacks required columns: {absent}")
    values = [
        clock.parse_utc(F.col(c), formats, zone).alias(c) if c in date_cols else F.col(c) for c in required
    ]
    return df.select(*values, texts.fingerprint(*[F.col(c) for c in hash_cols]).alias("row_hash"))
