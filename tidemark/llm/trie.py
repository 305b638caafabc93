"""Conversation prefix trie by a splitter skeleton.

Every conversation is a path of turn digests. Paths are sorted by range into shards, with the conversation's id
last, so that copies of one conversation are spread too. What the shards on both sides of a cut share is the path
of that cut's splitter: only the nodes on it can have members in several shards. The trie of these paths, the
skeleton, is broadcast. Every other node lies in one shard, which finishes it in one walk over its sorted paths;
for skeleton nodes it writes partial aggregates, which are reduced by node and then added up towards the root.

A long conversation is cut into segments of fixed length. The node at which a later segment begins is named by a
digest of the turns before it, so equal beginnings meet under one name and the segments below it form a trie of
their own. These tries are finished first; what they hold is summed up their chain by pointer doubling and added to
the node at the end of the segment above.
"""

from __future__ import annotations

import hashlib
from decimal import Decimal
from os.path import commonprefix

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.ordered import running_total, small_side
from tidemark.session import cut_lineage, scratch_path

#: Hex digits of a turn's digest in a path.
WIDTH = 32
#: Conversations that share a first part, and the most turns that may be: their ids agree but for the last two digits.
BLOCK, SHARED = 100, 6
#: Bytes of ids that one row hands over for a skeleton node, and rows that a task hands over at a time.
ENDS_BYTES, OUT_ROWS = 1 << 16, 20_000
NODE, PARTIAL, ENDS = 0, 1, 2
#: Turns of a conversation that one row holds.
SEGMENT = 1_024
#: What the segments below add to the node at which they begin.
MORE = ["more_children", "more_leaves", "more_saved"]
OUT = "kind int, skel long, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved long, ends string, shard long, seq long, root string, base long, over long, more_children long, more_leaves long, more_saved long"
RESULT = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"


def turn_rows(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, key, chars): a digest of every turn in place of its text. A null role or text counts as empty."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    whole = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    return turns.where("conv_id is not null").select(
        F.col("conv_id").cast("long"), "turn", F.substring(F.sha2(whole.cast("binary"), 256), 1, WIDTH).alias("key"), F.length(text).alias("chars"))


def _repeated(runs: Column) -> Column:
    """An array of (key, chars, times) with every entry as often as it says."""
    return F.flatten(F.transform(runs, lambda x: F.array_repeat(F.struct(x["key"], x["chars"]), x["times"].cast("int"))))


def _shared(conv_id: str = "conv_id") -> Column:
    """How many first turns a conversation takes from its block's first conversation."""
    return (F.crc32(F.col(conv_id).cast("string").cast("binary")) % SHARED).cast("int")


def _base(conv_id: str = "conv_id") -> Column:
    return F.expr(f"{conv_id} - {conv_id} % {BLOCK}")


def _root_of(seg: Column, before: Column) -> Column:
    """Key of the node at which segment ``seg`` begins, by all turns before it; a constant for the first."""
    named = F.concat_ws(":", seg.cast("string"), before.cast("decimal(38,0)").cast("string"))
    return F.when(seg == 0, F.lit("0" * WIDTH)).otherwise(F.substring(F.sha2(named.cast("binary"), 256), 1, WIDTH))


def _long_segments(rows: DataFrame, large: DataFrame, leads: DataFrame, segment: int) -> tuple[DataFrame, DataFrame]:
    """Leads with those of long conversations, and (conv_id, seg, segs, all) of the rebuilt long conversations.

    Positions are running totals, which split a hot conversation; equal rows count as one run.
    """
    runs = rows.join(large.select("conv_id"), "conv_id", "left_semi").groupBy("conv_id", "turn", "key", "chars").agg(F.count(F.lit(1)).alias("times"))
    placed = cut_lineage(running_total(runs, ["conv_id"], ["turn", "key"], F.col("times"), "pos"))
    few = F.struct("pos", "key", "chars", F.least("times", F.lit(SHARED)).alias("times"))
    first = placed.where(f"conv_id % {BLOCK} = 0 and pos < {SHARED - 1}").groupBy("conv_id").agg(F.sort_array(F.collect_list(few)).alias("runs"))
    leads = leads.unionByName(first.select(F.col("conv_id").alias("base"), F.slice(_repeated(F.col("runs")), 1, SHARED - 1).alias("lead")))

    about = large.withColumn("h", _shared()).join(leads, _base() == F.col("base"), "left")
    about = about.select("conv_id", "n", "h", F.slice(F.coalesce("lead", F.array().cast(leads.schema["lead"].dataType)), F.lit(1), F.col("h")).alias("lead"))
    about = about.withColumn("shift", F.size("lead") - F.col("h"))
    about = small_side(about.withColumn("segs", F.expr(f"(n + shift + {segment - 1}) div {segment}")))
    own = placed.join(about.select("conv_id", "h", "shift", "segs"), "conv_id").select(
        "conv_id", "segs", "key", "chars", (F.greatest("pos", "h") + F.col("shift")).alias("at"), F.expr("pos + times + shift").alias("until"))
    led = about.select("conv_id", "segs", F.posexplode("lead").alias("at", "x")).select(
        "conv_id", "segs", "x.key", "x.chars", F.col("at").cast("long"), (F.col("at") + 1).cast("long").alias("until"))
    spans = own.where("until > at").unionByName(led).withColumn("seg", F.explode(F.expr(f"sequence(at div {segment}, (until - 1) div {segment})")))
    piece = F.expr(f"struct(greatest(at, seg * {segment}) as at, key, chars, least(until, (seg + 1) * {segment}) - greatest(at, seg * {segment}) as times)")
    return leads, spans.groupBy("conv_id", "seg", "segs").agg(_repeated(F.sort_array(F.collect_list(piece))).alias("all"))


def segments(rows: DataFrame, segment: int) -> tuple[DataFrame, bool]:
    """(conv_id, seg, path, chars, root, next_root, goes) of the rebuilt conversations, and whether any has several segments.

    A rebuilt conversation is the first turns of the block's first conversation, then its own after as many. It is
    cut after every ``segment`` turns; ``root`` names the node at which a segment begins, ``next_root`` the node at
    the end of a full one, ``goes`` tells that the conversation goes on there.
    """
    large = small_side(rows.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > segment))
    long = not large.isEmpty()
    short = rows.join(large.select("conv_id"), "conv_id", "left_anti") if long else rows
    paths = cut_lineage(short.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "key", "chars"))).alias("turns")))
    plain = F.transform("turns", lambda x: F.struct(x["key"], x["chars"]))
    paths = paths.select("conv_id", plain.alias("turns"))
    leads = paths.where(f"conv_id % {BLOCK} = 0").select(F.col("conv_id").alias("base"), F.slice("turns", 1, SHARED - 1).alias("lead"))
    if long:
        leads, cut = _long_segments(rows, large, leads, segment)
    joined = paths.join(leads, _base() == F.col("base"), "left").withColumn("h", _shared())
    whole = F.concat(F.slice(F.coalesce("lead", F.slice("turns", F.lit(1), F.lit(0))), F.lit(1), F.col("h")),
                     F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns"), F.lit(1))))
    rebuilt = joined.select("conv_id", F.lit(0).cast("long").alias("seg"), F.lit(1).cast("long").alias("segs"), whole.alias("all"))

    def shown(df):
        return df.select("conv_id", "seg", "segs", F.array_join("all.key", "").alias("path"), F.col("all.chars").alias("chars"))

    rebuilt = shown(rebuilt)
    if not long:
        return rebuilt.select("conv_id", "seg", "path", "chars", F.lit("0" * WIDTH).alias("root"), F.lit(None).cast("string").alias("next_root"), F.lit(False).alias("goes")), False
    # The turns before a segment are named by the sum of a 96-bit digest of (number, turns) of every segment before it.
    named = F.sha2(F.concat_ws(":", F.col("seg").cast("string"), "path").cast("binary"), 256)
    high, low = (F.conv(F.substring(named, at, 12), 16, 10).cast("decimal(15,0)") for at in (1, 13))
    amount = (high * F.lit(Decimal(1 << 48)) + low).cast("decimal(29,0)").alias("amount")
    cut = cut_lineage(shown(cut).select("*", amount))
    before = running_total(cut.select("conv_id", "seg", "amount"), ["conv_id"], ["seg"], F.col("amount"), "before").select(
        "conv_id", "seg", F.col("before").cast("decimal(38,0)").alias("before"))
    both = cut.join(before, ["conv_id", "seg"]).unionByName(rebuilt.select("*", amount, F.lit(0).cast("decimal(38,0)").alias("before")))
    end = F.when(F.size("chars") == segment, _root_of(F.col("seg") + 1, F.col("before") + F.col("amount")))
    return cut_lineage(both.select("conv_id", "seg", "path", "chars", _root_of(F.col("seg"), F.col("before")).alias("root"),
                                   end.alias("next_root"), (F.col("seg") + 1 < F.col("segs")).alias("goes"))), True


class Skeleton:
    """The trie of the splitters' paths. Node 0 is above the roots of all segments; parents come before their children."""

    def __init__(self, paths: list[str]):
        self.ids: dict[tuple[int, str], int] = {}
        self.parent, self.depth, self.key = [-1], [0], [None]
        for path in paths:
            at = 0
            for i in range(0, len(path), WIDTH):
                step = (at, path[i:i + WIDTH])
                if step not in self.ids:
                    self.ids[step] = len(self.parent)
                    self.parent.append(at)
                    self.depth.append(self.depth[at] + 1)
                    self.key.append(path[i:i + WIDTH])
                at = self.ids[step]


def skeleton_of(shards: DataFrame) -> Skeleton:
    """Built from the first and the last path of every shard, so one pair of paths per shard reaches the driver."""
    ends = shards.groupBy("shard").agg(F.min("path").alias("low"), F.max("path").alias("high")).orderBy("shard").collect()
    shared = [commonprefix([a.high, b.low]) for a, b in zip(ends, ends[1:])]
    return Skeleton([s[:len(s) // WIDTH * WIDTH] for s in shared])


class _Node:
    __slots__ = ("skel", "n", "least", "children", "leaves", "saved", "chars", "ids", "ids_bytes", "digest", "waiting", "seq", "base", "over", "more")

    def __init__(self, skel: int, chars: int, base: int = 0, over: int | None = None):
        self.skel, self.chars, self.base, self.over, self.more = skel, chars, base, over, None
        self.n = self.children = self.leaves = self.saved = self.ids_bytes = self.seq = 0
        self.least = self.digest = None
        self.ids, self.waiting = [], []


EMPTY = hashlib.sha256().hexdigest()


def _walk(skeleton: Skeleton, shard: int, rows, emit):
    """Finish the nodes of one shard from its sorted (path, conv_id, chars, base, over, goes, more...) rows.

    ``base`` is the depth at which the segment begins, ``over`` the smallest member of the node there. Where a member
    goes on, its node takes the children, leaves and saved tokens that the segments below hold (``more``).
    """
    keys: list[str] = []
    stack = [_Node(0, 0)]

    def hand_over(node):
        emit((ENDS, node.skel, None, None, None, None, None, None, None, ",".join(node.ids), shard, node.seq, None, None, None, None, None, None))
        node.ids, node.ids_bytes, node.seq = [], 0, node.seq + 1

    def ended(node, conv_id, goes, more):
        node.n += 1
        node.least = conv_id if node.least is None else min(node.least, conv_id)
        if goes:
            node.more = more
        elif node.skel >= 0:
            node.ids.append(str(conv_id))
            node.ids_bytes += len(node.ids[-1]) + 1
            if node.ids_bytes >= ENDS_BYTES:
                hand_over(node)
        elif node.digest is None:
            node.digest = hashlib.sha256(str(conv_id).encode())
        else:
            node.digest.update(f",{conv_id}".encode())

    def close():
        node = stack.pop()
        if node.skel >= 0:
            if node.ids:
                hand_over(node)
            emit((PARTIAL, node.skel, node.least, node.chars, None, node.n, node.children, node.leaves, node.saved, None, shard, None,
                  None, node.base, node.over, *(node.more or (None, None, None))))
            return
        up = stack[-1]
        leaves, saved = node.leaves if node.children else 1, node.saved + (node.n - 1) * node.chars
        if node.more:
            node.children, leaves, saved = node.more[0], node.more[1], saved + node.more[2]
        least = node.least if node.over is None else node.over
        for row in node.waiting:
            emit(row[:4] + (least,) + row[5:])
        row = (NODE, up.skel, node.least, node.base + len(stack) - 1, None, node.n, node.children, leaves, saved,
               node.digest.hexdigest() if node.digest else EMPTY, None, None, keys[0] if len(stack) == 1 else None, None, None, None, None, None)
        if up.skel >= 0:
            emit(row)
        else:
            up.waiting.append(row)
        up.n += node.n
        up.least = node.least if up.least is None else min(up.least, node.least)
        up.children += 1
        up.leaves += leaves
        up.saved += saved

    for path, conv_id, chars, base, over, goes, *more in rows:
        now = [path[i:i + WIDTH] for i in range(0, len(path), WIDTH)]
        same = 0
        for a, b in zip(keys, now):
            if a != b:
                break
            same += 1
        while len(stack) > same + 1:
            close()
        for key, size in zip(now[same:], chars[same:]):
            above = stack[-1].skel
            stack.append(_Node(skeleton.ids.get((above, key), -1) if above >= 0 else -1, size, base, over if len(stack) == 1 else None))
        ended(stack[-1], conv_id, goes, more)
        keys = now
    while stack:
        close()


def _finish_shards(shared):
    names = [part.split()[0] for part in OUT.split(", ")]
    types = [pa.int32() if " int" in part else pa.string() if " string" in part else pa.int64() for part in OUT.split(", ")]

    def table(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    def run(batches):
        out, shard = [], None

        def rows():
            nonlocal shard
            for batch in batches:
                columns = [column.to_pylist() for column in batch.columns]
                for number, *row in zip(*columns):
                    shard = number
                    yield row

        feed = rows()
        first = next(feed, None)
        if first is None:
            return

        def again():
            yield first
            for row in feed:
                yield row
                if len(out) >= OUT_ROWS:
                    ready.append(table(out))
                    out.clear()

        ready = []
        _walk(shared.value, shard, again(), out.append)
        yield from ready
        if out:
            yield table(out)

    return run


def _hash_ends(batches):
    """Rows (skel, shard, seq, ends) in this order to (skel, ends): the digest of all ids of a node, one row held at a time."""
    skel, digest = None, None

    def done():
        return pa.RecordBatch.from_arrays([pa.array([skel], pa.int64()), pa.array([digest.hexdigest()])], names=["skel", "ends"])

    for batch in batches:
        for node, ids in zip(batch.column(0).to_pylist(), batch.column(3).to_pylist()):
            if node != skel:
                if digest:
                    yield done()
                skel, digest = node, hashlib.sha256(ids.encode())
            else:
                digest.update(f",{ids}".encode())
    if digest:
        yield done()


def _reduced(skeleton: Skeleton, found: DataFrame) -> list[tuple]:
    """The rows of the skeleton's nodes: partial aggregates by node, then added up from the deepest node to the top.

    A row is the node's number, its root key if a segment begins there, the member to name as its children's parent, and ``RESULT``.
    """
    sums = found.where(F.col("kind") == PARTIAL).groupBy("skel").agg(
        F.min("conv_id").alias("least"), F.max("depth").alias("chars"), *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved")],
        *[F.max(c).alias(c) for c in ("base", "over", "more_children", "more_leaves", "more_saved")])
    chunks = found.where(F.col("kind") == ENDS).select("skel", "shard", "seq", "ends")
    digests = chunks.repartition("skel").sortWithinPartitions("skel", "shard", "seq").mapInArrow(_hash_ends, "skel long, ends string")
    ends = {r.skel: r.ends for r in digests.collect()}
    size = len(skeleton.parent)
    n, children, leaves, saved, chars, base = ([0] * size for _ in range(6))
    least, over, more = ([None] * size for _ in range(3))
    for r in sums.collect():
        n[r.skel], children[r.skel], leaves[r.skel], saved[r.skel], least[r.skel], chars[r.skel] = r.n_convs, r.n_children, r.n_leaves, r.saved, r.least, r.chars
        base[r.skel], over[r.skel] = r.base, r.over
        if r.more_leaves is not None:
            more[r.skel] = (r.more_children, r.more_leaves, r.more_saved)
    for i in range(size - 1, -1, -1):
        leaves[i] = leaves[i] if children[i] else 1
        saved[i] += (n[i] - 1) * chars[i]
        if more[i]:
            children[i], leaves[i], saved[i] = more[i][0], more[i][1], saved[i] + more[i][2]
        up = skeleton.parent[i]
        if up >= 0:
            n[up] += n[i]
            children[up] += 1
            leaves[up] += leaves[i]
            saved[up] += saved[i]
            least[up] = least[i] if least[up] is None else min(least[up], least[i])
    named = [least[i] if over[i] is None else over[i] for i in range(size)]
    return [(i, skeleton.key[i] if skeleton.parent[i] == 0 else None, named[i], least[i], base[i] + skeleton.depth[i] - 1,
             named[skeleton.parent[i]] if skeleton.parent[i] > 0 else None, n[i], children[i], leaves[i], saved[i], ends.get(i, EMPTY)) for i in range(size)]


def _finish(rows: DataFrame) -> DataFrame | None:
    """(root, RESULT) per node of all segments' tries; ``root`` is null but for the node at which a segment begins."""
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = rows.repartitionByRange(parts, "path", "conv_id").sortWithinPartitions("path", "conv_id")
    shards = cut_lineage(ranged.select(F.spark_partition_id().cast("long").alias("shard"), "path", "conv_id", "chars", "base", "over", "goes", *MORE))
    if shards.isEmpty():
        return None
    skeleton = skeleton_of(shards)
    path = scratch_path(spark, "trie")
    shards.mapInArrow(_finish_shards(spark.sparkContext.broadcast(skeleton)), OUT).write.parquet(path)
    found = spark.read.parquet(path)
    top = spark.createDataFrame(_reduced(skeleton, found), f"skel long, root string, named long, {RESULT}")
    above = F.broadcast(top.select("skel", "named"))  # at most the shards times the turns of a segment
    nodes = found.where(F.col("kind") == NODE).join(above, "skel", "left").select(
        "root", "conv_id", "depth", F.when(F.col("root").isNull(), F.coalesce("parent_conv_id", "named")).alias("parent_conv_id"), "n_convs", "n_children",
        "n_leaves", F.col("saved").alias("saved_tokens"), F.col("ends").alias("ends_sha256"))
    return nodes.unionByName(top.where("skel > 0").drop("skel", "named"))


def _below(segs: DataFrame, rows: DataFrame) -> DataFrame:
    """(next_root, more...): children, leaves and saved tokens below every node at which a later segment begins.

    Each segment's trie is finished by itself; sums over all tries below it come by doubling the distance to an ancestor.
    """
    own = _finish(rows.where("base > 0"))
    links = segs.where("goes and seg > 0").select(F.col("next_root").alias("root"), F.col("root").alias("up")).distinct()
    totals = cut_lineage(own.where("root is not null").select("root", "n_children", "n_leaves", "saved_tokens").join(links, "root", "left"))
    while not totals.where("up is not null").isEmpty():
        sums = totals.where("up is not null").groupBy(F.col("up").alias("root")).agg(F.sum("n_leaves").alias("l"), F.sum("saved_tokens").alias("s"))
        higher = totals.where("up is not null").select(F.col("root").alias("up"), F.col("up").alias("next_up"))
        totals = cut_lineage(totals.join(sums, "root", "left").join(higher, "up", "left").select(
            "root", F.col("next_up").alias("up"), "n_children", F.expr("n_leaves + coalesce(l, 0)").alias("n_leaves"),
            F.expr("saved_tokens + coalesce(s, 0)").alias("saved_tokens")))
    return totals.select(F.col("root").alias("next_root"), *[F.col(c).alias(m) for c, m in zip(("n_children", "n_leaves", "saved_tokens"), MORE)])


def prefix_trie(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
                segment: int = SEGMENT) -> DataFrame:
    """One row per node of the trie of the rebuilt conversations, the textless root included.

    Columns: conv_id (smallest member), depth, parent_conv_id (null for the root), n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256. Rows without a conv_id belong to no conversation and are left out; an empty table
    has no node. Turns with equal numbers go by their digest, so repeated rows are turns of their own. A turn
    takes some 40 bytes in its conversation's row, whatever its text's length; a conversation of more than
    ``segment`` turns (at least 5) has a row per so many turns, so that no task holds it whole. Other columns may
    have any names.
    """
    spark = conversations.sparkSession
    turns = conversations.select(*[F.col(f"`{given}`").alias(name) for given, name in ((conv_id, "conv_id"), (turn, "turn"), (role, "role"), (text, "text"))])
    segs, long = segments(turn_rows(turns), segment)
    none = F.lit(None).cast("long")
    rows = segs.select("conv_id", F.concat("root", "path").alias("path"), F.concat(F.array(F.lit(0)), "chars").alias("chars"),
                       (F.col("seg") * segment).alias("base"), "goes", "root", "next_root")
    if long:
        over = segs.where("next_root is not null").groupBy(F.col("next_root").alias("root")).agg(F.min("conv_id").alias("over"))
        rows = rows.join(small_side(over), "root", "left")
        if not segs.where("goes").isEmpty():
            nothing = {m: F.when(F.col("goes"), F.lit(0).cast("long")) for m in MORE}
            rows = rows.join(small_side(_below(segs, rows.withColumns(nothing))), "next_root", "left")
            rows = rows.withColumns({m: F.when(F.col("goes"), F.col(m)) for m in MORE})
        else:
            rows = rows.withColumns({m: none for m in MORE})
    else:
        rows = rows.withColumns({"over": none, **{m: none for m in MORE}})
    nodes = _finish(rows)
    if nodes is None:
        return spark.createDataFrame([], RESULT)
    return nodes.where("root is null or depth = 0").drop("root")
