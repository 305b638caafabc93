import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from helpers_llm import CLASH

from tidemark.llm.trie import EMPTY, Skeleton, prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            own[c].append(((turn is not None, turn or 0, digest), role, text))
    for c in own:
        own[c] = [(r, t) for _, r, t in sorted(own[c])]
    members, ends = defaultdict(list), defaultdict(list)
    for c in own:
        h = zlib.crc32(str(c).encode()) % 6
        path = tuple(own.get(c - c % 100, [])[:h] + own[c][h:])
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
        ends[path].append(c)
    children = defaultdict(list)
    for p in members:
        if p:
            children[p[:-1]].append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = sum(leaves[k] for k in children[p]) or 1
        saved[p] = sum(saved[k] for k in children[p]) + (len(members[p]) - 1) * (len(p[-1][1]) if p else 0)
    return sorted(((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(children[p]), leaves[p], saved[p],
                    hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest()) for p, m in members.items()), key=str)


def check(spark, rows, **options):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    for name in [*CLASH, "path", "shard", "skel", "depth", "base"]:
        df = df.selectExpr("*", f"'x' as {name}")
    assert sorted(map(tuple, prefix_trie(df, **options).collect()), key=str) == brute(rows)


@pytest.mark.parametrize("kinds", [2, 40])
def test_brute_force_on_random_conversations(spark, kinds):
    pick = random.Random(kinds)
    rows = [(c, t if pick.random() < 0.9 else None, pick.choice(["user", "assistant", None]), pick.choice([None, "", *[f"té {i}\U0001f600" * i for i in range(kinds)]]))
            for c in pick.sample(range(3_000), 400) for t in range(pick.choice([1, 2, 3, 8, 40]))]
    check(spark, rows + rows[:30] + [(None, 1, "user", "nobody's")])


def test_copies_over_all_shards_and_a_long_conversation(spark):
    copies = [(c, t, "user", f"turn {t}") for c in range(1, 15_000) for t in range(2)]
    long = [(c, t, "user", f"turn {t}" if t < 900 + c % 7 else "end") for c in (20_000, 20_001, 20_101) for t in range(1_000)]
    check(spark, copies + long)


@pytest.mark.parametrize("segment", [5, 7, 1_024])
def test_long_conversations_are_cut(spark, segment):
    pick = random.Random(segment)
    starts = [[pick.choice("ab") for _ in range(60)] for _ in range(3)]
    rows = []
    for c in pick.sample(range(1_000), 150) + [100, 200, 300]:
        turns = list(pick.choice(starts)[:pick.choice([1, 4, 5, 7, 10, 14, 15, 35, 60])])
        if pick.random() < 0.4:
            turns += pick.choices("xyz", k=pick.choice([1, 6, 20]))
        rows += [(c, None if t % 11 == 10 else t, "user", text * (1 + t % 3)) for t, text in enumerate(turns)]
    rows += [(c, 5, "user", "again") for c in (401, 402) for _ in range(33)]  # runs of equal rows over several cuts
    check(spark, list(dict.fromkeys(rows)) + rows[-66:], segment=segment)


def test_copies_of_a_long_conversation_over_all_shards(spark):
    check(spark, [(c, t, "user", f"turn {t}") for c in range(1_001, 1_400) for t in range(23)] + [(1_400, t, "user", f"turn {t}") for t in range(400)], segment=8)


def test_single_turnless_and_empty(spark):
    check(spark, [(7, 0, "user", "alone")])
    check(spark, [(c, 0, "user", "x") for c in (101, 102, 103, 104, 105, 106)])  # no conversation 100: shortened to nothing
    assert prefix_trie(spark.createDataFrame([], SCHEMA)).count() == 0
    only_root = [c for c in range(101, 200) if zlib.crc32(str(c).encode()) % 6][0]
    assert tuple(prefix_trie(spark.createDataFrame([(only_root, 0, "user", "x")], SCHEMA)).first()) == (
        only_root, 0, None, 1, 0, 1, 0, hashlib.sha256(str(only_root).encode()).hexdigest())


def test_skeleton_shares_prefixes():
    a, b, c = "a" * 32, "b" * 32, "c" * 32
    skeleton = Skeleton([a + b, a + b + c, "", a])
    assert skeleton.parent == [-1, 0, 1, 2] and skeleton.depth == [0, 1, 2, 3]
    assert EMPTY == hashlib.sha256(b"").hexdigest()
