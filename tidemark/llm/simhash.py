"""SimHash near-duplicates by vantage-point trees over the fingerprints.

Distinct fingerprints are dealt to shards by a vantage-point tree that is built on a bounded sample. A node
parts its fingerprints by their distance from a vantage point: at most ``mu``, or more. By the triangle
inequality, all partners of a fingerprint at distance d from the vantage point are at distances d - r to d + r,
so it visits only the sides that this ring touches. A shard holds the tree's leaf and the visitors from over
its borders, and finds their exact pairs with a tree of its own. Of the pairs only a spanning star per shard
leaves the task; stars are joined to components with minima, shuffles and checkpoints.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import row_wise, text_of
from tidemark.operators.ordered import small_side
from tidemark.session import cut_lineage

WORDS, BITS, SEED = 3, 2, 42
#: Fingerprints of a shard's own (about), fewest shards, sample per shard, and members of a leaf inside a shard.
SHARD_ROWS, LEAST_SHARDS, SAMPLE_PER_SHARD, LEAF = 8_192, 64, 64, 256
#: Vantage points that are tried at a node, and the smallest share of members on either side.
TRIED, LEAST_SIDE = 12, 0.2
#: Shingles whose bits are held unpacked at a time, and pairs compared at a time.
SHINGLES, PAIRS = 1 << 18, 1 << 22


class Node(NamedTuple):
    vantage: np.int64
    mu: int
    inside: Node | Leaf
    outside: Node | Leaf


class Leaf(NamedTuple):
    number: int
    members: np.ndarray


def fingerprint(text: str, words: int = WORDS) -> int:
    """Majority bits of XXH64 over the word shingles of a text, A-Z lower-cased; 0 without a word."""
    found = text.encode().lower().split()
    if not found:
        return 0
    joined = b" ".join(found)
    ends = np.cumsum([len(w) + 1 for w in found]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(1, len(found) - words + 1)
    spans = zip(starts[:n].tolist(), ends[min(words, len(found)) - 1:].tolist())
    hashes = np.fromiter((xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in spans), "<u8", n)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, SHINGLES):
        part = hashes[at:at + SHINGLES].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints_of(texts, words: int, n: int) -> pa.Array:
    return pa.array(np.fromiter((fingerprint(t, words) for t in texts), "<u8", n).view("<i8"), pa.int64())


def distances(fingerprints: np.ndarray, other) -> np.ndarray:
    return np.bitwise_count((fingerprints ^ other).view(np.uint64))  # of signed numbers it would count the absolute value


def build(members: np.ndarray, leaf: int, radius: int = BITS) -> Node | Leaf:
    """The tree over ``members`` (distinct), with leaves of at most ``leaf`` where distances part them.

    Of the vantage points and distances that leave enough on both sides, the one whose border ring holds the
    fewest members is taken, since those are looked for on both sides.
    """
    leaves = [0]

    def grow(inner: np.ndarray) -> Node | Leaf:
        best = None
        if len(inner) > leaf:
            for vantage in inner[np.linspace(0, len(inner) - 1, TRIED).astype(int)]:
                upto = np.cumsum(np.bincount(distances(inner, vantage), minlength=65 + radius))
                for mu in range(64):
                    if LEAST_SIDE * len(inner) <= upto[mu] <= (1 - LEAST_SIDE) * len(inner):
                        ring = int(upto[min(mu + radius, 64)] - (upto[mu - radius] if mu >= radius else 0))
                        cost = (ring / len(inner) + 1) * max(upto[mu], len(inner) - upto[mu])
                        if best is None or cost < best[0]:
                            best = (cost, vantage, mu)
        if best is None:
            leaves[0] += 1
            return Leaf(leaves[0] - 1, inner)
        near = distances(inner, best[1]) <= best[2]
        return Node(best[1], best[2], grow(inner[near]), grow(inner[~near]))

    return grow(np.sort(members))


def visits(tree: Node | Leaf, fingerprints: np.ndarray, radius: int = BITS):
    """(leaf, rows, at home) for every leaf that can hold a partner of some of the fingerprints."""
    waiting = [(tree, np.arange(len(fingerprints)), np.ones(len(fingerprints), bool))]
    while waiting:
        node, rows, home = waiting.pop()
        if not len(rows):
            continue
        if isinstance(node, Leaf):
            yield node, rows, home
            continue
        far = distances(fingerprints[rows], node.vantage).astype(np.int64)
        for side, goes, belongs in ((node.inside, far <= node.mu + radius, far <= node.mu), (node.outside, far > node.mu - radius, far > node.mu)):
            waiting.append((side, rows[goes], (home & belongs)[goes]))


def spanning_star(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, smallest node) for every node of the links a-b that is not the smallest of its component."""
    nodes, place = np.unique(np.concatenate([a, b]), return_inverse=True)
    u, v = place[:len(a)], place[len(a):]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[u], label[v])
        new = label.copy()
        np.minimum.at(new, label[u], low)
        np.minimum.at(new, label[v], low)
        while (new != new[new]).any():
            new = new[new]
        if (new == label).all():
            break
        label = new
    moved = label != np.arange(len(nodes))
    return nodes[moved], nodes[label[moved]]


def close_pairs(own: np.ndarray, visitors: np.ndarray, radius: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Spanning star of all pairs of a visitor and a larger own member at most ``radius`` bits apart."""
    star = (np.empty(0, np.int64), np.empty(0, np.int64))
    for leaf, rows, _ in visits(build(own, LEAF, radius), visitors, radius):
        step = max(1, PAIRS // max(1, len(leaf.members)))
        for at in range(0, len(rows), step):
            some = visitors[rows[at:at + step]]
            i, j = np.nonzero((distances(some[:, None], leaf.members[None, :]) <= radius) & (some[:, None] < leaf.members[None, :]))
            if len(i):
                star = spanning_star(np.concatenate([star[0], some[i]]), np.concatenate([star[1], leaf.members[j]]))
    return star


def _deal(tree: Node | Leaf, radius: int):
    def run(batches):
        for batch in batches:
            found = batch.column(0).to_numpy()
            for leaf, rows, home in visits(tree, found, radius):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(rows), leaf.number, np.int64)), pa.array(found[rows]), pa.array(home)], names=["shard", "fp", "home"])

    return run


def links(fingerprints: DataFrame, radius: int = BITS) -> DataFrame:
    """Links (u, v) with v < u that connect the distinct values of the long column fp as all pairs within ``radius`` bits do."""
    spark = fingerprints.sparkSession
    total = fingerprints.count()
    shards = max(LEAST_SHARDS, total // SHARD_ROWS)
    # The sample is bounded by a million fingerprints; the tree over it by twice as many nodes as shards.
    size = min(shards * SAMPLE_PER_SHARD, 1 << 20)
    spread = F.pmod(F.xxhash64("fp"), F.lit(1 << 30))
    sample = fingerprints.where(spread < int(min(1.0, size / max(1, total)) * (1 << 30))).collect()
    tree = build(np.array([r.fp for r in sample], np.int64), max(2, size // shards), radius)
    shared = spark.sparkContext.broadcast(tree)

    def deal(batches):
        return _deal(shared.value, radius)(batches)

    def pairs(group: pd.DataFrame) -> pd.DataFrame:
        u, v = close_pairs(group.loc[group.home, "fp"].to_numpy(np.int64), group["fp"].to_numpy(np.int64), radius)
        return pd.DataFrame({"u": u, "v": v})

    return fingerprints.mapInArrow(deal, "shard long, fp long, home boolean").groupBy("shard").applyInPandas(pairs, "u long, v long")


def components(edges: DataFrame) -> DataFrame:
    """(u, v): every node of the links that is not the smallest of its component, and that smallest node.

    Large-star and small-star steps until nothing changes. Minima are fixed before they are joined back, so a
    node with very many links is an ordinary skewed join.
    """
    edges = cut_lineage(edges.where("u != v").distinct())

    def signature():
        return edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    before = signature()
    while before[0]:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = cut_lineage(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
        large = cut_lineage(both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        low = cut_lineage(large.groupBy("u").agg(F.min("v").alias("m")))
        hooked = large.join(low, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = cut_lineage(hooked.union(low.select("u", F.col("m").alias("v"))).distinct())
        after = signature()
        if after == before:
            break
        before = after
    return edges


def _fingerprinted(docs: DataFrame, doc_id: str, text: str, words: int) -> DataFrame:
    """(doc_id, key, fp): a row's id, a hash of its text, and its fingerprint. Narrow, and fixed."""

    def make():
        return lambda texts: [fingerprints_of(texts, words, len(texts))]

    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), _key(text).alias("key"), F.col(f"`{text}`").alias("text"))
    return cut_lineage(row_wise(rows, ["doc_id", "key"], "text", "fp long", make))


def _key(text: str):
    return F.xxhash64(text_of(text))


def _named(marked: DataFrame, radius: int) -> DataFrame:
    """``marked`` with the component_id of every row."""
    distinct = cut_lineage(marked.groupBy("fp").agg(F.min("doc_id").alias("first")))
    roots = components(links(distinct.select("fp"), radius))
    placed = distinct.join(roots, distinct.fp == roots.u, "left").select("fp", "first", F.coalesce("v", "fp").alias("root"))
    names = cut_lineage(placed.groupBy("root").agg(F.min("first").alias("component_id")))
    return marked.join(cut_lineage(placed.join(names, "root").select("fp", "component_id")), "fp")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = WORDS, radius: int = BITS) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id.

    The component is named by its smallest doc_id; null ids are not used as names, so a component of null ids
    only has a null name. Null texts count as empty; texts without a word have fingerprint 0 and link like any
    other; texts of any length are read whole. Rows of one doc_id and different texts are different members with
    the same id. An empty table gives no rows.
    """
    named = _named(_fingerprinted(docs, doc_id, text, words), radius)
    return named.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_per_group(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = WORDS, radius: int = BITS) -> DataFrame:
    """The documents with the smallest id of each component, all their columns kept. Rows without an id stay.

    Rows go by their id and a hash of their text, so one of several texts under an id may go and another stay, and
    texts are fingerprinted once. What goes is decided on narrow rows; it is broadcast where it is measured small.
    """
    named = _named(_fingerprinted(docs, doc_id, text, words), radius)
    mark = "_" * (1 + max(map(len, docs.columns)))  # a name no column has
    gone = named.where("doc_id != component_id").select(F.col("doc_id").alias(doc_id), F.col("key").alias(mark)).distinct()
    left = docs.withColumn(mark, _key(text)).join(small_side(gone), [doc_id, mark], "left_anti")
    return left.select(*[F.col(f"`{c}`") for c in docs.columns])
