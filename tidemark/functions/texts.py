"""Column helpers for object addresses, names and row fingerprints."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_KEY = r"^s3://[^/]*/+(.*?)/*$"


def uri_is_valid(uri: Column) -> Column:
    """An ``s3://`` address with a non-empty key after the bucket."""
    return F.coalesce(F.regexp_extract(uri, _KEY, 1) != "", F.lit(False))


def uri_bucket(uri: Column) -> Column:
    return F.regexp_extract(uri, r"^s3://([^/]*)", 1)


def uri_prefix(uri: Column) -> Column:
    return F.regexp_extract(F.regexp_extract(uri, _KEY, 1), r"^(.*)/[^/]*$", 1)


def uri_name(uri: Column) -> Column:
    return F.regexp_extract(F.regexp_extract(uri, _KEY, 1), r"([^/]*)$", 1)


_URL = r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)([^?#]*)"


def url_base_name(url: Column) -> Column:
    """Last path segment of a URL, or its host when there is none; null for what is no URL.

    Addresses are only cut apart, so blanks, bars and braces in them do no harm.
    """
    name = F.regexp_extract(F.regexp_extract(url, _URL, 2), r"([^/]*)$", 1)
    host = F.regexp_extract(url, _URL, 1)
    return F.when(name != "", name).when(host != "", host)


def under(prefix: str, name: Column) -> Column:
    prefix = prefix.rstrip("/")
    return F.concat(F.lit(f"{prefix}/"), name) if prefix else name


def fingerprint(*values: Column) -> Column:
    """md5 over the values in order; a null is marked, so it never equals an empty or missing text.

    Each text is prefixed by its length, so no value can imitate a separator.
    """
    def piece(value: Column) -> Column:
        text = value.cast("string")
        return F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("null"))

    return F.md5(F.concat_ws("|", *[piece(v) for v in values]))


def part_object_name(index: Column, epoch: Column, part: Column) -> Column:
    return F.concat(index, F.lit("_"), epoch.cast("string"), F.format_string("_part-%05d.json", part))


def window_object_name(table: Column, start: Column, end: Column, epoch: Column) -> Column:
    stamp = "yyyy-MM-dd_HH-mm-ss"
    return F.concat_ws(
        "_", table, F.date_format(start, stamp), F.date_format(end, stamp),
        F.concat(epoch.cast("string"), F.lit(".json")),
    )


def range_object_name(table: Column, start_text: Column, end_text: Column, part: Column) -> Column:
    """Name from raw window texts: colons dropped, plus signs and blanks made safe."""
    def safe(text: Column) -> Column:
        return F.translate(text, "+ :", "__")

    return F.concat_ws(
        "_", table, safe(start_text), safe(end_text), F.concat(F.lit("part"), part.cast("string"), F.lit(".parquet"))
    )
