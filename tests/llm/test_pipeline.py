import hashlib
import re

import public_tokenizers
import pytest
import sentencepiece
from helpers_llm import AWKWARD, frame
from test_simhash import plain_fingerprint, roots

import corpus_pipeline
from tidemark.llm.decontaminate import fold

FOLDER = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.fixture
def with_benchmark(spark, tmp_path):
    spark.createDataFrame([(1, "A passage from the benchmark that nobody should train on, ever.")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    return str(tmp_path)


def brute_force(docs, bench):
    """Kept documents after the first four stages. ``docs``: (doc_id, text) rows."""
    docs = [d for d in docs if d[1] and any(c.isalpha() for c in d[1])]
    best = {}
    for i, t in docs:
        key = t.translate(LOWER)
        if key not in best or (best[key][0] is None) or (i is not None and i > best[key][0]):
            best[key] = (i, t)
    docs = list(best.values())
    prints = [plain_fingerprint(t) for _, t in docs]
    linked = [(a, b) for a in range(len(docs)) for b in range(a) if (prints[a] ^ prints[b]).bit_count() <= 2]
    groups = {}
    for a, r in roots(range(len(docs)), linked).items():
        groups.setdefault(r, []).append(a)
    lowest = {a: min((docs[m][0] for m in g if docs[m][0] is not None), default=None) for g in groups.values() for a in g}
    docs = [d for a, d in enumerate(docs) if d[0] is None or d[0] == lowest[a]]
    held = ["".join(map(chr, fold([t])[0])).strip() for t in bench]
    return [d for d in docs if not any(h in "".join(map(chr, fold([d[1]])[0])) for h in held)]


def test_whole_run_against_brute_force(spark):
    import pyarrow.parquet as pq

    docs = [(r["doc_id"], r["text"]) for r in pq.read_table(f"{FOLDER}/documents.parquet").to_pylist()]
    bench = pq.read_table(f"{FOLDER}/benchmark.parquet").column("text").to_pylist()
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    want = []
    for i, text in brute_force(docs, bench):
        ids = [*library.encode(text), 2]
        want.append((i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(library.decode(ids).encode()).hexdigest(), ids))
    assert sorted(map(tuple, corpus_pipeline.run(spark, FOLDER).collect())) == sorted(want)


@pytest.mark.parametrize("number", range(5))
def test_stages_on_awkward_rows(spark, with_benchmark, number):
    rows = AWKWARD + [(30, "Clean and plain words about nothing at all."), (31, "See: a PASSAGE from the benchmark that nobody should train on, ever!")]
    name, stage = corpus_pipeline.STAGES[number]
    docs = frame(spark, rows, clash=True)
    got = stage(spark, docs, with_benchmark)
    if number < 4:
        assert got.columns == docs.columns
    ids = sorted((r.doc_id for r in got.collect()), key=str)
    everything = [i for i, _ in rows]
    if name == "language_id":
        everything = [i for i, t in rows if t and re.search(r"[^\W\d_]", t)]
    elif name == "exact_dedup":
        everything = [3, 2, 5, 6, 7, 8, None, 30, 31]
    elif name == "simhash_near_dedup":
        everything = [1, 4, 6, 7, 8, None, 30, 31]
    elif name == "benchmark_decontamination":
        everything.remove(31)
    assert ids == sorted(everything, key=str)
    assert stage(spark, docs.where("false"), with_benchmark).count() == 0
