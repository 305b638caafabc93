import random
import re

import numpy as np
import pytest
import xxhash
from helpers_llm import AWKWARD, frame

from tidemark.llm import simhash
from tidemark.llm.simhash import build, close_pairs, components, fingerprint, near_duplicates, one_per_group, visits


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(nodes, pairs):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def near(n, seed):
    """Fingerprints in clouds, so that distances of 0 to 6 are common."""
    pick = random.Random(seed)
    centres = [pick.getrandbits(64) for _ in range(max(1, n // 40))]
    made = set()
    while len(made) < n:
        x = pick.choice(centres)
        for _ in range(pick.randint(0, 3)):
            x ^= 1 << pick.randrange(64)
        made.add(x)
    return np.array(sorted(made), np.uint64).view(np.int64)


@pytest.mark.parametrize("text", [t for _, t in AWKWARD] + ["a b", "A b c", "x\x1cy z \x0b w", "A" * 10_000])
def test_fingerprint(text):
    assert fingerprint(text or "") == plain_fingerprint(text)


@pytest.mark.parametrize("leaf", [1, 16, 300])
def test_tree_loses_no_pair(leaf):
    members = near(1200, leaf)
    tree, home, held = build(members, leaf), {}, {}
    for found, rows, at_home in visits(tree, members):
        for r, h in zip(rows.tolist(), at_home.tolist()):
            held.setdefault(r, set()).add(found.number)
            if h:
                assert r not in home
                home[r] = found.number
    for i in range(len(members)):
        for j in np.flatnonzero(np.bitwise_count((members ^ members[i]).view(np.uint64)) <= 2):
            assert home[int(j)] in held[i]


def test_star_connects_what_the_pairs_connect(monkeypatch):
    monkeypatch.setattr(simhash, "LEAF", 20)
    own = near(900, 1)
    u, v = close_pairs(own, own)
    pairs = [(a, b) for i, a in enumerate(own.tolist()) for b in own[i + 1:][np.bitwise_count((own[i + 1:] ^ own[i]).view(np.uint64)) <= 2].tolist()]
    assert roots(own.tolist(), zip(u.tolist(), v.tolist())) == roots(own.tolist(), pairs)


def test_components_of_paths_stars_and_rings(spark):
    pick = random.Random(4)
    pairs = [(i + 1, i) for i in range(60)] + [(200 + i, 100) for i in range(40)] + [(300, 310), (310, 320), (320, 300), (7, 7)]
    names = {n: pick.getrandbits(40) for p in pairs for n in p}
    pairs = [(names[a], names[b]) for a, b in pairs]
    want = {n: r for n, r in roots({n for p in pairs for n in p}, pairs).items() if n != r}
    got = {r.u: r.v for r in components(spark.createDataFrame(pairs, "u long, v long")).collect()}
    assert got == want
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_rows_against_brute_force(spark, monkeypatch):
    pick = random.Random(2)
    base = [" ".join(pick.choice("abcdefgh") * pick.randint(1, 4) for _ in range(400)) for _ in range(20)]
    rows = AWKWARD + [(1000 - n, base[n % 20].replace("aaa", "b", n // 20)) for n in range(120)]
    prints = [plain_fingerprint(t) for _, t in rows]
    linked = [(i, j) for i in range(len(rows)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 2]
    groups = {}
    for i, r in roots(range(len(rows)), linked).items():
        groups.setdefault(r, []).append(i)
    names = {i: min((rows[m][0] for m in g if rows[m][0] is not None), default=None) for g in groups.values() for i in g}
    want = sorted(((rows[i][0], f"{prints[i]:016x}", names[i]) for i in range(len(rows))), key=str)
    docs = frame(spark, rows, clash=True)
    assert sorted(map(tuple, near_duplicates(docs).collect()), key=str) == want
    kept = one_per_group(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted((i for i, _, c in want if i is None or i == c), key=str)


def test_empty_table(spark):
    assert near_duplicates(frame(spark, [])).count() == 0


def test_two_texts_under_one_id_go_or_stay_alone(spark):
    a, b = "one two three four five six seven eight nine ten", "quite another text about all the birds in the wood"
    rows = [(3, b), (5, a), (5, b), (8, a), (9, a.upper()), (None, a)]
    got = one_per_group(frame(spark, rows, clash=True))
    assert got.columns == frame(spark, rows, clash=True).columns
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=str) == sorted([(3, b), (5, a), (None, a)], key=str)
