"""Links out of export results, and where each one goes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import texts

# The marks around a tagged reply.
_TAGGED = r"(?s)BEGIN_JSON_RESULT\s*(\{.*?\})\s*END_JSON_RESULT"
_LINKS = "array<struct<kind:string,value:string,loose:boolean>>"


def _text(value: Column) -> Column:
    """A variant's text when it holds a JSON string, else null."""
    return F.when(F.schema_of_variant(value) == "STRING", F.try_variant_get(value, "$", "string"))


def _link(kind: Column | str, value: Column, loose: bool) -> Column:
    kind = F.lit(kind) if isinstance(kind, str) else kind
    return F.struct(kind.alias("kind"), value.alias("value"), F.lit(loose).alias("loose"))


def _filled(value: Column) -> Column:
    return F.coalesce(F.trim(value) != "", F.lit(False))


def _facts(item: Column) -> Column:
    """What one element of a result offers: its text, or an object's urls, prefix and loose values."""
    urls = F.try_variant_get(item, "$.urls", "array<variant>")
    loose = F.transform(F.map_values(F.try_variant_get(item, "$", "map<string,variant>")), _text)
    return F.struct(
        _text(item).alias("text"),
        F.coalesce(F.schema_of_variant(item).startswith("OBJECT"), F.lit(False)).alias("is_object"),
        (F.coalesce(F.size(urls), F.lit(0)) > 0).alias("has_urls"),
        F.filter(F.transform(urls, _text), _filled).alias("urls"),
        _text(F.try_variant_get(item, "$.prefix", "variant")).alias("prefix"),
        F.filter(loose, lambda v: F.coalesce(v.rlike("^(https?|s3)://"), F.lit(False))).alias("loose"),
    )


def _urls(values: Column) -> Column:
    return F.transform(values, lambda u: _link("url", u, False))


def _object_links(facts: Column, otherwise: Column) -> Column:
    """Links of one object: its ``urls``, else its ``prefix``, else what the caller makes of it."""
    return (
        F.when(facts["has_urls"], _urls(facts["urls"]))
        .when(_filled(facts["prefix"]), F.array(_link("prefix", facts["prefix"], False)))
        .otherwise(otherwise)
    )


def _listed_object(facts: Column) -> Column:
    """In a list, any value that looks like a link counts when an object has neither urls nor prefix."""
    return _object_links(facts, F.transform(
        facts["loose"], lambda v: _link(F.when(v.startswith("http"), "url").otherwise("prefix"), v, True)))


def _first_mentions(links: DataFrame, src: str) -> DataFrame:
    """Rows of all links but the loose ones that repeat an earlier link of the same result.

    Results without loose links are exploded where they are. In the others, equal links of a result
    meet in one group, which keeps its stated links and, if it came first, one loose link.
    """
    some = F.exists("_links", lambda e: e["loose"])
    stated = links.filter(~some).select(src, F.explode("_links").alias("_l")).select(src, "_l.kind", "_l.value")
    mixed = links.filter(some).withColumn("_row", F.monotonically_increasing_id())
    each = mixed.select(src, "_row", F.posexplode("_links").alias("_at", "_l")).select(src, "_row", "_at", "_l.*")
    groups = each.groupBy(src, "_row", "kind", "value").agg(
        F.count_if(~F.col("loose")).alias("_n"), F.min("_at").alias("_first"), F.min(F.when(F.col("loose"), F.col("_at"))).alias("_loose"))
    times = F.col("_n") + F.when(F.col("_loose") == F.col("_first"), 1).otherwise(0)
    again = groups.withColumn("_again", F.explode(F.array_repeat(F.lit(1), times.cast("int"))))
    return stated.unionByName(again.select(src, "kind", "value"))


def _lead(body: Column) -> Column:
    return F.substring(F.ltrim(body), 1, 1)


def extract_links(df: DataFrame, src: str, body: str) -> DataFrame:
    """Rows (src, kind, value) of every link; results of another shape are left to ``bad_results``.

    Each step is a column of its own, so a result is parsed once and every element read once.
    """
    tree = F.col("_tree")
    parsed = df.select(src, F.try_parse_json(F.col(body)).alias("_tree"), _lead(F.col(body)).alias("_lead"))
    items = F.when(F.col("_lead") == "[", F.try_variant_get(tree, "$", "array<variant>")).when(
        F.col("_lead") == "{", F.array(tree))
    facts = parsed.select(src, "_lead", F.transform(items, _facts).alias("_facts"))
    of_text = F.forall("_facts", lambda f: f["text"].isNotNull())
    texts_only = _urls(F.filter(F.transform("_facts", lambda f: f["text"]), _filled))
    objects = F.filter("_facts", lambda f: f["is_object"])
    found = (
        F.when(F.col("_lead") == "{", F.flatten(F.transform(objects, lambda f: _object_links(f, F.array().cast(_LINKS)))))
        .when(of_text, texts_only)
        .otherwise(F.flatten(F.transform(objects, _listed_object)))
    )
    return _first_mentions(facts.select(src, found.alias("_links")), src)


def bad_results(df: DataFrame, body: str) -> DataFrame:
    """Quarantine: rows whose result is no JSON object or list."""
    shaped = F.try_parse_json(F.col(body)).isNotNull() & _lead(F.col(body)).isin("{", "[")
    return df.filter(~F.coalesce(shaped, F.lit(False)))


def dedupe_links(df: DataFrame, keys=("src_id", "kind", "value")) -> DataFrame:
    return df.dropDuplicates(list(keys))


def plan_destinations(df: DataFrame, url: str, weekly_prefix: str) -> DataFrame:
    """Add the object key each URL is stored under, and whether another row has the same key.

    Keys are counted with a map-side reduction; only repeated keys are joined back, so a key shared
    by a third of the rows never gathers in one task.
    """
    planned = df.withColumn("dest_key", texts.under(weekly_prefix, texts.url_base_name(F.col(url))))
    repeated = planned.groupBy("dest_key").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select(
        "dest_key", F.lit(True).alias("_again")
    )
    return planned.join(repeated, "dest_key", "left").withColumn(
        "duplicate", F.coalesce("_again", F.lit(False))
    ).drop("_again")


def plan_copies(objects: DataFrame, prefix: str, key: str, weekly_prefix: str) -> DataFrame:
    """Destination of each object below a copied prefix: the rest of its key, under the week's prefix."""
    rest = F.ltrim(F.substr(F.col(key), F.length(F.col(prefix)) + 1), F.lit("/"))
    base = weekly_prefix.rstrip("/")
    return objects.withColumn(
        "dest_key", F.when(rest != "", F.concat(F.lit(f"{base}/"), rest)).otherwise(F.lit(base))
    )


def split_object_uri(df: DataFrame, column: str) -> DataFrame:
    """Add bucket, prefix and name of an ``s3://`` address, and whether it is a valid one."""
    uri, valid = F.col(column), texts.uri_is_valid(F.col(column))
    return df.withColumns({
        "valid": valid,
        "bucket": F.when(valid, texts.uri_bucket(uri)),
        "prefix": F.when(valid, texts.uri_prefix(uri)),
        "name": F.when(valid, texts.uri_name(uri)),
    })


def extract_tagged_json(df: DataFrame, column: str, result_schema: str) -> DataFrame:
    """The JSON between BEGIN_JSON_RESULT and END_JSON_RESULT: its ``result``, or an error text."""
    body = F.regexp_extract(F.col(column), _TAGGED, 1)
    reply = F.from_json(body, f"struct<ok:boolean,result:{result_schema}>", {"mode": "PERMISSIVE"})
    parsed = df.withColumn("_body", body).withColumn("_reply", reply)
    good = F.coalesce(F.col("_reply.ok"), F.lit(False))
    return parsed.withColumns({
        "result": F.when(good, F.col("_reply.result")),
        "error": F.when(F.coalesce(F.col("_body") == "", F.lit(True)), "no result found").when(~good, "reported an error"),
    }).drop("_body", "_reply")


def name_objects(df: DataFrame, index: str, epoch: str, part: str) -> DataFrame:
    return df.withColumn("object_name", texts.part_object_name(F.col(index), F.col(epoch), F.col(part)))


def row_fingerprint(df: DataFrame, columns: list[str], name: str = "row_hash") -> DataFrame:
    return df.withColumn(name, texts.fingerprint(*[F.col(c) for c in columns]))
