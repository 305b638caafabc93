"""Column helpers for instants, zones and calendars.

Naive timestamps mean UTC and the session clock is UTC (see ``session.prepare``), so a cast between
naive and zoned timestamps moves nothing. Zone shifts use ``from_utc_timestamp``, which resolves a
constant zone once; ``convert_timezone`` resolves it for every row.
"""

from __future__ import annotations

import re
from datetime import datetime, timezone
from zoneinfo import ZoneInfo

from pyspark.sql import Column
from pyspark.sql import functions as F


def naive(ts: Column) -> Column:
    return ts.cast("timestamp_ntz")


def _shifted(ts: Column, zone: str) -> Column:
    return F.from_utc_timestamp(ts.cast("timestamp"), zone)


def to_local(ts: Column, zone: str) -> Column:
    """UTC wall clock -> wall clock of ``zone``."""
    return naive(_shifted(ts, zone))


def to_utc(local: Column, zone: str) -> Column:
    """Wall clock of ``zone`` -> UTC wall clock."""
    return naive(F.to_utc_timestamp(local.cast("timestamp"), zone))


def local_date(ts: Column, zone: str) -> Column:
    return F.to_date(_shifted(ts, zone))


def instant(value: datetime | str) -> Column:
    """A literal instant as naive UTC; offsets are converted, naive input is taken as UTC."""
    return F.lit(utc_naive(value)).cast("timestamp_ntz")


def utc_naive(value: datetime | str) -> datetime:
    if isinstance(value, str):
        value = datetime.fromisoformat(value)
    if value.tzinfo is not None:
        value = value.astimezone(timezone.utc).replace(tzinfo=None)
    return value


def local_midnight_utc(day, zone: str) -> datetime:
    """UTC instant (naive) at which ``day`` begins in ``zone``."""
    return utc_naive(datetime(day.year, day.month, day.day, tzinfo=ZoneInfo(zone)))


def within(ts: Column, start: Column, end: Column, closed: str = "left") -> Column:
    """``closed='left'`` is ``[start, end)``; ``closed='both'`` keeps rows at ``end`` too."""
    if closed == "left":
        return (ts >= start) & (ts < end)
    if closed == "both":
        return (ts >= start) & (ts <= end)
    raise ValueError(f"closed must be 'left' or 'both', not {closed!r}")


def offset_text(ts: Column, zone: str) -> Column:
    """UTC offset of ``zone`` at the instant, as ``+05:30``."""
    shift = F.unix_micros(_shifted(ts, zone)) - F.unix_micros(ts.cast("timestamp"))
    minutes = _whole(F.abs(shift), 60_000_000)
    return F.concat(
        F.when(shift < 0, "-").otherwise("+"),
        F.lpad(_whole(minutes, 60).cast("string"), 2, "0"),
        F.lit(":"),
        F.lpad((minutes % 60).cast("string"), 2, "0"),
    )


def _whole(value: Column, by: int) -> Column:
    return F.call_function("div", value, F.lit(by).cast("bigint"))


def iso_text(ts: Column, zone: str) -> Column:
    """ISO 8601 text in ``zone`` with offset, to the second."""
    return F.concat(F.date_format(_shifted(ts, zone), "yyyy-MM-dd'T'HH:mm:ss"), offset_text(ts, zone))


def iso_year(day: Column) -> Column:
    return F.extract(F.lit("YEAROFWEEK"), day).cast("int")


def iso_week(day: Column) -> Column:
    return F.weekofyear(day)


def week_folder(day: Column) -> Column:
    """``2025/week_10``, from the ISO year and ISO week together."""
    return F.format_string("%04d/week_%02d", iso_year(day), iso_week(day))


# Formats of the worksheet contract, tried in this order.
WORKSHEET_FORMATS = ("yyyy-MM-dd'T'HH:mm:ss'Z'", "dd/MM/yyyy HH:mm:ss", "MM/dd/yyyy HH:mm:ss")
# ISO texts that carry their own offset.
_OFFSET_TAIL = r"\d(Z|[+-]\d\d:\d\d)$"
_NAIVE = r"^\d{4}-\d\d-\d\d[T ]\d\d:\d\d:\d\d(\.\d{3}|\.\d{6})?$"
OFFSET_FORMATS = ("yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][.SSS]XXX", "yyyy-MM-dd HH:mm:ss[.SSSSSS][.SSS]XXX")


def parse_utc(text: Column, formats=WORKSHEET_FORMATS, assume_zone: str | None = None) -> Column:
    """Text -> naive UTC, or null. Offset-carrying ISO text wins; then ``formats`` in order.

    A format without an offset, and ISO text without one, reads a wall clock of ``assume_zone``; with
    no zone given such text stays null, because its instant is unknown. A quoted ``'Z'`` in a format
    means UTC.
    """
    tries = [F.when(text.rlike(_OFFSET_TAIL), read_as(text, f)) for f in OFFSET_FORMATS]
    if assume_zone is not None:
        clean = F.replace(text, F.lit("T"), F.lit(" "))
        wall = naive(F.try_to_timestamp(clean, F.lit("yyyy-MM-dd HH:mm:ss[.SSSSSS][.SSS]")))
        tries.append(F.when(text.rlike(_NAIVE), to_utc(wall, assume_zone)))
    for fmt in formats:
        if fmt.endswith("'Z'"):
            tries.append(read_as(text, fmt))
        elif assume_zone is not None:
            tries.append(to_utc(read_as(text, fmt), assume_zone))
    return F.coalesce(*tries)


def read_as(text: Column, fmt: str) -> Column:
    """Text of one format -> wall clock, or null. Text of another shape is never parsed: a failed
    parse costs far more than a look at its digits."""
    parsed = naive(F.try_to_timestamp(text, F.lit(fmt)))
    shape = _shape(fmt)
    return parsed if shape is None else F.when(text.rlike(shape), parsed)


def _shape(fmt: str) -> str | None:
    """Regex of the texts a format of fixed-width digits can read; null for any other format."""
    out, quoted = "", False
    for piece in re.findall(r"([A-Za-z])(\1*)|(.)", fmt, re.S):
        letters, other = piece[0] + piece[1], piece[2]
        if other == "'":
            quoted = not quoted
        elif other:
            out += re.escape(other)
        elif quoted:
            out += letters
        elif letters in ("yyyy", "MM", "dd", "HH", "mm", "ss"):
            out += rf"\d{{{len(letters)}}}"
        else:
            return None
    return None if re.search(r"[\[\]]", fmt) else f"^{out}$"


def seconds_between(later: Column, earlier: Column) -> Column:
    """Whole seconds, cut toward zero."""
    return _whole(F.unix_micros(later.cast("timestamp")) - F.unix_micros(earlier.cast("timestamp")), 1_000_000)


# A count and its unit, and the seconds a unit is worth.
DURATION_PIECE = r"(\d+)\s*([dhms])"
UNIT_SECONDS = {"d": 86400, "h": 3600, "m": 60, "s": 1}


def duration_s(text: Column) -> Column:
    """``1m:40s``, ``2d 3h`` -> seconds; text without a number and unit gives 0."""
    clean = F.lower(F.regexp_replace(F.trim(text), ":", " "))
    pattern = F.lit(DURATION_PIECE)
    counts = F.regexp_extract_all(clean, pattern, F.lit(1))
    units = F.regexp_extract_all(clean, pattern, F.lit(2))
    worth = F.create_map(*[F.lit(x) for pair in UNIT_SECONDS.items() for x in pair])
    parts = F.zip_with(counts, units, lambda n, u: n.cast("bigint") * worth[u])
    return F.aggregate(parts, F.lit(0).cast("bigint"), lambda acc, x: acc + x)
