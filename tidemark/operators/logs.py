"""Structured log lines: build, parse, flatten, and spans per correlation id."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import clock
from tidemark.operators.windows import LOG_ZONES

# The line layout
# LEVEL | [Thread] | logger func: message | UTC: ts | zone: ts | ... | ctx={json}
_LINE = (
    r"(?s)^(\w+) \| \[([^\x01]*?)\] \| ([^\s\x01]+) ([^\s\x01]+): (.*?) \| UTC: "
    r"(\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d[+-]\d\d:\d\d)(?: \| [^|]*?: \S+)* \| ctx=(\{[^\x01]*\})$"
)
# One pass over the line sets a mark between the pieces; the message, which may hold any text, is last.
_PIECES = "\x01".join(["$1", "$2", "$3", "$4", "$6", "$7", "$5"])
_FIELDS = ("level", "thread", "logger", "function", "utc_text", "ctx_json", "message")


def flatten_context(user_message: Column, extra_json: Column) -> Column:
    """Context map: ``user_message`` first, then the extra object's other keys.

    Extra that is not an object goes whole under ``extra_data``; it never replaces ``user_message``.
    """
    kind = "map<string,string>"
    empty = F.create_map().cast(kind)
    is_object = F.coalesce(F.ltrim(extra_json).startswith("{"), F.lit(False))
    parsed = F.map_filter(F.from_json(extra_json, kind), lambda k, v: k != "user_message")
    extra = (
        F.when(extra_json.isNull(), empty)
        .when(is_object, F.coalesce(parsed, empty))
        .otherwise(F.create_map(F.lit("extra_data"), extra_json))
    )
    lead = F.when(user_message.isNull(), empty).otherwise(F.create_map(F.lit("user_message"), user_message))
    return F.map_concat(lead, extra)


def format_log_lines(df: DataFrame, ts: str, ctx_json: str, zones=LOG_ZONES) -> DataFrame:
    """Add the ``line`` text for level, thread, logger, function, message, time and context columns."""
    stamps = [F.concat(F.lit(f"{z}: "), clock.iso_text(F.col(ts), z)) for z in zones]
    return df.withColumn("line", F.concat_ws(
        " | ",
        F.col("level"),
        F.concat(F.lit("["), F.col("thread"), F.lit("]")),
        F.concat(F.col("logger"), F.lit(" "), F.col("function"), F.lit(": "), F.col("message")),
        *stamps,
        F.concat(F.lit("ctx="), F.col(ctx_json)),
    ))


def _pieces(line: Column) -> Column:
    """The seven pieces of a line of the known layout; fewer for any other line."""
    return F.split(F.regexp_replace(line, _LINE, _PIECES), "\x01", len(_FIELDS))


def parse_log_lines(df: DataFrame, line: str = "value") -> DataFrame:
    """Columns of every line of the known layout; the context becomes ``map<string,string>``.

    Keeping the good lines by an explode, not by a filter, lets the pattern run once per line: a
    filter would be pushed below and run it again.
    """
    good = F.filter(F.array(_pieces(F.col(line))), lambda p: F.size(p) == len(_FIELDS))
    cut = df.select("*", F.explode(good).alias("_p"))
    out = cut.withColumns({name: F.col("_p")[at] for at, name in enumerate(_FIELDS)})
    return out.withColumns({
        "ts_utc": clock.parse_utc(F.col("utc_text"), ()),
        "ctx": F.from_json("ctx_json", "map<string,string>"),
    }).drop("_p", "utc_text", "ctx_json")


def unparsed_lines(df: DataFrame, line: str = "value") -> DataFrame:
    """Quarantine: lines of any other layout."""
    known = F.coalesce(F.size(_pieces(F.col(line))) == len(_FIELDS), F.lit(False))
    return df.filter(~known)


def spans(df: DataFrame, corr_id: str, ts: str, mark: str) -> DataFrame:
    """Start, end, failure and length per correlation id; spans without end or failure are unfinished."""
    def at(name: str, pick) -> Column:
        return pick(F.when(F.col(mark) == name, F.col(ts)))

    return df.groupBy(corr_id).agg(
        at("sub_start", F.min).alias("started_at"),
        at("sub_end", F.max).alias("ended_at"),
        at("sub_exception", F.max).alias("failed_at"),
        F.count(F.lit(1)).alias("marks"),
    ).filter(F.col("started_at").isNotNull()).withColumns({
        "failed": F.col("failed_at").isNotNull(),
        "unfinished": F.col("ended_at").isNull() & F.col("failed_at").isNull(),
    }).withColumn("span_s", clock.seconds_between(F.greatest("ended_at", "failed_at"), F.col("started_at")))
