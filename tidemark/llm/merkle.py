"""Merkle dataset manifest with proofs by pointer jumping.

Rows become leaves, leaves of one group (a source) form a tree of runs of ``FAN`` nodes, and the groups' subroots
form one more tree over all of them. A node's proof segment holds the digests beside it in its run, and points to
its parent. Joining the nodes with themselves on that pointer doubles the distance to the ancestor a segment ends
at and chains the segments, so all nodes reach the root after as many joins as the depth has binary digits. The
nodes of the lowest run share the path above it, so the joins carry one row per run, and the last join hands it
to the leaves.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import ascii_lower
from tidemark.operators.ordered import small_side
from tidemark.session import cut_lineage

#: Consecutive nodes that one parent covers.
FAN = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Name of the tree over the subroots, and what its levels are raised by; no group's tree is called so.
TOP, ABOVE = "top", 1_000
KEY = ["tree", "level", "idx"]


class Manifest(NamedTuple):
    """``runs``: per lowest run its leaves (``kids``). ``nodes``: all nodes above the leaves. ``root``: its digest."""

    runs: DataFrame
    nodes: list[DataFrame]
    root: str
    depth: int


def digest_of(values: list[Column]) -> Column:
    """Lowercase hex sha256 of the values in a row: ``-`` for null, else UTF-8 byte count, ``:``, value."""
    texts = [v.cast("string") for v in values]
    marked = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat(*marked).cast("binary"), 256)


def _joined(digests: Column) -> Column:
    return F.array_join(digests, "")


def _hash(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def placed(rows: DataFrame, order: list[str]) -> DataFrame:
    """Add ``pos``, the row's place from 0 within its ``tree``, and ``n``, the rows of that tree.

    Rows are cut by range into sorted partitions, so a tree of any size is spread over tasks; the places
    continue from one partition to the next by the counts per tree and partition.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = cut_lineage(rows.repartitionByRange(parts, "tree", *order).sortWithinPartitions("tree", *order))
    numbered = spread.withColumn("at", F.monotonically_increasing_id()).withColumn("part", F.shiftright("at", 33))
    spans = numbered.groupBy("tree", "part").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("rows"))
    tree = Window.partitionBy("tree")
    earlier = F.coalesce(F.sum("rows").over(tree.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    spans = small_side(spans.select("tree", "part", (earlier - F.col("first")).alias("shift"), F.sum("rows").over(tree).alias("n")))
    return numbered.join(spans, ["tree", "part"]).withColumn("pos", F.col("at") + F.col("shift")).drop("at", "part", "shift")


def _parents(rows: DataFrame, place: str, level: int, *carried: str) -> DataFrame:
    """The runs of ``rows`` (tree, n, ``place``, digest, ...) as nodes of ``level``: tree, level, idx, n, digest, kids."""
    runs = rows.groupBy("tree", "n", F.expr(f"{place} div {FAN}").alias("idx")).agg(
        F.array_sort(F.collect_list(F.struct(place, "digest", *carried))).alias("kids"))  # at most FAN of them
    return runs.select("tree", F.lit(level).alias("level"), "idx", F.expr(f"(n + {FAN - 1}) div {FAN}").alias("n"),
                       _hash(_joined(F.col("kids.digest"))).alias("digest"), "kids", (F.col("n") == 1).alias("lone"))


def _grow(runs: DataFrame, level: int, most: int) -> list[DataFrame]:
    """``runs`` and the levels over them, until every tree has one node; ``most`` is the largest number of runs."""
    levels = [runs]
    while most > 1:
        level, most = level + 1, -(-most // FAN)
        below = levels[-1].where("n > 1").withColumnRenamed("level", "low").withColumn("of", F.col("tree"))
        levels.append(cut_lineage(_parents(below, "idx", level, "of", "low").drop("lone")))
    return levels


def build_manifest(leaves: DataFrame, order: list[str], *carried: str) -> Manifest | None:
    """The trees over ``leaves`` (tree, digest, ``order`` and ``carried`` columns), or None if there is none.

    A tree of one leaf has that leaf as its subroot; else the last node that remains is.
    """
    rows = placed(leaves, order)
    runs = _parents(rows, "pos", 1, *dict.fromkeys(c for c in (*order, *carried) if c not in ("tree", "digest")))
    runs = cut_lineage(runs.withColumn("digest", F.when(F.col("lone"), F.col("kids")[0]["digest"]).otherwise(F.col("digest"))))
    most = runs.agg(F.max("n")).first()[0]
    if most is None:
        return None
    levels = _grow(runs, 1, most)
    plain = ["tree", "level", "idx", "n", "digest"]
    nodes = [level.select(*plain, *(["kids"] if i else [])) for i, level in enumerate(levels)]
    subroots = nodes[0].where("n = 1").select(*plain)
    for level in nodes[1:]:
        subroots = subroots.unionByName(level.where("n = 1").select(*plain))
    top = placed(subroots.select(F.lit(TOP).alias("tree"), F.col("tree").alias("of"), F.col("level").alias("low"), "digest"), ["of"])
    trees = top.agg(F.max("n")).first()[0]
    if trees > 1:
        first = cut_lineage(_parents(top, "pos", ABOVE, "of", "low").drop("lone"))
        above = _grow(first, ABOVE, -(-trees // FAN))
        nodes += [level.select(*plain, "kids") for level in above]
        root = above[-1].first()["digest"]
        return Manifest(runs, nodes, root, len(levels) + len(above))
    return Manifest(runs, nodes, subroots.first()["digest"], len(levels))


def _segments(manifest: Manifest) -> DataFrame:
    """Per node its pointer to the parent, the segment beside it, and the subroot where it is one itself."""
    child = F.struct(F.col("kid.of").alias("tree"), F.col("kid.low").cast("int").alias("level"), F.coalesce("kid.idx", F.lit(0)).cast("bigint").alias("idx"))
    steps = []
    for level in manifest.nodes:
        if "kids" not in level.columns:
            continue
        if "pos" in level.schema["kids"].dataType.elementType.names:  # subroots: each is the only node of its level
            level = level.withColumn("kids", F.transform("kids", lambda k: F.struct(F.lit(0).cast("bigint").alias("idx"), k["digest"].alias("digest"), k["of"].alias("of"), k["low"].alias("low"))))
        beside = level.select(F.struct(*KEY).alias("up"), F.col("kids.digest").alias("all"), F.posexplode("kids").alias("k", "kid"))
        steps.append(beside.select(
            child.alias("node"), "up",
            F.array(F.struct(_joined(F.slice("all", F.lit(1), F.col("k"))).alias("left"), _joined(F.slice("all", F.col("k") + 2, F.lit(FAN))).alias("right"))).alias("steps")))
    every = None
    for level in manifest.nodes:
        part = level.select(F.struct(F.col("tree"), F.col("level").cast("int").alias("level"), F.col("idx").cast("bigint").alias("idx")).alias("node"),
                            F.when((F.col("n") == 1) & (F.col("tree") != TOP), F.col("digest")).alias("subroot"))
        every = part if every is None else every.unionByName(part)
    if not steps:
        return every.select("node", F.lit(None).cast(every.schema["node"].dataType).alias("up"), "subroot",
                            F.array().cast("array<struct<left:string,right:string>>").alias("steps"))
    beside = steps[0]
    for more in steps[1:]:
        beside = beside.unionByName(more)
    return every.join(beside, "node", "left").select(
        "node", "up", "subroot", F.coalesce("steps", F.array().cast("array<struct<left:string,right:string>>")).alias("steps"))


def paths(manifest: Manifest) -> DataFrame:
    """Per node (tree, level, idx): steps to the root, each the digests left and right of the way, and the subroot.

    Every join reads the nodes that pointers can have reached by then; their number falls with the fan to the
    power of the distance, so a node that very many point at is one of a few and is broadcast after measuring.
    """
    nodes, far = cut_lineage(_segments(manifest)), 1
    while far < manifest.depth:
        ends = small_side(nodes.where(F.col("node.level") >= 1 + far).select(
            F.col("node").alias("up"), F.col("up").alias("up2"), F.col("subroot").alias("subroot2"), F.col("steps").alias("steps2")))
        joined = nodes.join(ends, "up", "left")
        nodes = cut_lineage(joined.select(
            "node", F.coalesce("up2", "up").alias("up"), F.coalesce("subroot", "subroot2").alias("subroot"),
            F.when(F.col("steps2").isNull(), F.col("steps")).otherwise(F.concat("steps", "steps2")).alias("steps")))
        far *= 2
    return nodes.select("node.tree", "node.level", "node.idx", "subroot", "steps")


def fold(start: Column, steps: Column) -> Column:
    """The root that a digest and the siblings along its way give."""
    return F.aggregate(steps, start, lambda acc, s: _hash(F.concat(s["left"], acc, s["right"])))


def prove(manifest: Manifest) -> DataFrame:
    """One row per leaf: kid (the leaf's struct), subroot, before and after (siblings in its run), tail (those further up), steps, lone."""
    above = paths(manifest).where(F.col("level") == 1).select("tree", "idx", "subroot", "steps")
    runs = manifest.runs.select("tree", "idx", "lone", "kids").join(above, ["tree", "idx"])
    tail = _joined(F.transform("steps", lambda s: F.concat(s["left"], s["right"])))
    rows = runs.select("subroot", "steps", "lone", tail.alias("tail"), F.col("kids.digest").alias("all"), F.posexplode("kids").alias("k", "kid"))
    return rows.select(
        "kid", "subroot", "steps", "lone", "tail", _joined(F.slice("all", F.lit(1), F.col("k"))).alias("before"),
        _joined(F.slice("all", F.col("k") + 2, F.lit(FAN))).alias("after"))


def dataset_manifest(docs: DataFrame, doc_id: str = "doc_id", group: str = "source", fields: tuple = FIELDS, text: str = "text") -> DataFrame:
    """One row per document: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

    Leaves of a group ascend by doc_id (null first), then by digest, so rows that repeat an id have a fixed order
    and equal rows have equal proofs. A null group is a group of its own, before all others. Every fifth document
    (crc32 of its id) is folded from a leaf whose text has A-Z lower-cased; one without an id never is. Null and
    empty texts, and texts of any length, are hashed where they are read; other columns may have any names. An
    empty table gives no rows.
    """
    column = {f: F.col(f"`{f}`") for f in {*fields, doc_id, group, text}}
    hit = F.crc32(column[doc_id].cast("string").cast("binary")) % 5 == 0
    altered = digest_of([ascii_lower(column[f].cast("string")) if f == text else column[f] for f in fields])
    leaves = docs.select(
        F.coalesce(F.concat(F.lit("="), column[group].cast("string")), F.lit("")).alias("tree"), column[doc_id].alias("id"),
        digest_of([column[f] for f in fields]).alias("digest"), F.when(hit, altered).alias("altered"))
    manifest = build_manifest(leaves, ["id", "digest"], "altered")
    if manifest is None:
        return docs.sparkSession.createDataFrame([], f"doc_id {leaves.schema['id'].dataType.simpleString()}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean")
    rows = prove(manifest)
    shown = F.coalesce("kid.altered", "kid.digest")
    start = F.when(F.col("lone"), shown).otherwise(_hash(F.concat("before", shown, "after")))
    out = rows.select(
        F.col("kid.id").alias("doc_id"), F.col("kid.digest").alias("leaf"), "subroot", F.lit(manifest.root).alias("root"),
        _hash(F.when(F.col("lone"), F.col("tail")).otherwise(F.concat("before", "after", "tail"))).alias("proof_sha256"),
        fold(start, F.col("steps")).alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
