import hashlib
import zlib

import pytest
from helpers_llm import AWKWARD, CLASH, DOC

from tidemark.llm.merkle import FAN, build_manifest, dataset_manifest, digest_of, paths

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row, text):
    values = [row[0], row[3], row[2], row[4], text]
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def climb(digests):
    """The last node, and per digest the steps (left, right) to it."""
    steps, level, at = [[] for _ in digests], digests, list(range(len(digests)))
    while len(level) > 1:
        runs = [level[i:i + 16] for i in range(0, len(level), 16)]
        for i, place in enumerate(at):
            run, k = runs[place // 16], place % 16
            steps[i].append(("".join(run[:k]), "".join(run[k + 1:])))
            at[i] = place // 16
        level = [sha("".join(run)) for run in runs]
    return level[0], steps


def brute(rows):
    groups = {}
    for r in rows:
        groups.setdefault("" if r[3] is None else "=" + r[3], []).append(r)
    trees = {}
    for name, members in groups.items():
        members.sort(key=lambda r: (r[0] is not None, r[0], leaf(r, r[1])))
        trees[name] = (members, *climb([leaf(r, r[1]) for r in members]))
    names = sorted(trees, key=str.encode)
    root, above = climb([trees[n][1] for n in names])
    out = []
    for name, top in zip(names, above):
        members, subroot, steps = trees[name]
        for r, way in zip(members, steps):
            way = way + top
            hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 and r[1] is not None
            folded = leaf(r, r[1].translate(LOWER) if hit else r[1])
            for left, right in way:
                folded = sha(left + folded + right)
            out.append((r[0], leaf(r, r[1]), subroot, root, sha("".join(a + b for a, b in way)), folded, folded == root))
    return sorted(out, key=str)


def rows_of(sizes):
    rows = [(i, t, "en", None, len(t or "")) for i, t in AWKWARD]
    for g, size in enumerate(sizes):
        rows += [(1000 * g + i, f"Text {i} of é{g}", None if i % 3 else "de", f"s{g}" if g else "Ü", i) for i in range(size)]
    return rows


def check(spark, rows):
    df = spark.createDataFrame(rows, DOC).repartition(3)
    for name in [*CLASH, "tree", "leaf", "root", "kids", "altered"]:
        df = df.selectExpr("*", f"'x' as {name}")
    assert sorted(map(tuple, dataset_manifest(df).collect()), key=str) == brute(rows)


@pytest.mark.parametrize("sizes", [[1, 16, 17, 256, 300], [1] * 40, [4200]])
def test_brute_force_on_trees_of_many_shapes(spark, sizes):
    check(spark, rows_of(sizes))


@pytest.mark.parametrize("rows", [
    [(1, "only", "en", "a", 4)], [(None, None, None, None, None)], [(5, "Same", "en", "a", 4)] * 40,
    [(5, f"Text {n % 3}", "en", "a", 4) for n in range(20)], [(1, "a", "en", "", 1), (2, "b", "en", None, 1)],
])
def test_brute_force_on_single_repeated_and_null_rows(spark, rows):
    check(spark, rows)


def test_empty_table(spark):
    got = dataset_manifest(spark.createDataFrame([], DOC))
    assert got.count() == 0 and got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def test_pointers_of_all_nodes_reach_the_root(spark):
    rows = spark.range(FAN ** 3 + 1).selectExpr("id", "concat('=', id % 3) as tree")
    manifest = build_manifest(rows.select("tree", "id", digest_of([rows.id]).alias("digest")), ["id", "digest"])
    found = {(r.tree, r.level, r.idx): len(r.steps) for r in paths(manifest).collect()}
    depth = {f"={g}": 3 for g in range(3)}  # 1,366 leaves each: runs, runs of runs, subroot
    assert len(found) == 3 * (86 + 6 + 1) + 1
    assert all(n == (0 if tree == "top" else depth[tree] - level + 1) for (tree, level, _), n in found.items())
