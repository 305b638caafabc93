"""The weekly transfer: links out of an export result, their destinations, one load per ISO week."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import texts
from tidemark.operators.links import extract_links
from tidemark.session import cut_lineage


def weekly_prefix(base: str, run_date: date) -> str:
    """``<base>/<ISO year>/week_<ISO week>``."""
    return "/".join([*filter(None, [base.rstrip("/")]), run_date.strftime("%G/week_%V")])


def transfer_plan(results: DataFrame, src: str, body: str, base: str, run_date: date) -> DataFrame:
    """One row per link: its destination, and whether another URL claims the same one.

    A URL is stored under its own name. A prefix is copied object by object (``plan_copies``) below
    the week's folder, which is its destination here and may be shared.
    """
    folder = weekly_prefix(base, run_date)
    links = cut_lineage(extract_links(results, src, body))  # narrow, and read twice: by row and by key
    key = F.when(F.col("kind") == "url", texts.under(folder, texts.url_base_name(F.col("value")))).otherwise(F.lit(folder))
    planned = links.withColumn("dest_key", key)
    repeated = planned.filter("kind = 'url'").groupBy("kind", "dest_key").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    marked = planned.join(repeated, ["kind", "dest_key"], "left")
    return marked.select(*links.columns, "dest_key", F.col("_n").isNotNull().alias("duplicate"))
