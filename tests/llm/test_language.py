import random

import numpy as np
import pyarrow.parquet as pq
import pytest
from helpers_llm import AWKWARD, frame

from tidemark.llm.common import fold_of_id
from tidemark.llm import language
from tidemark.llm.language import automaton, identify_languages, learn, phrases, suffix_automaton, to_symbols, transitions, with_language
from tidemark.llm.language import _symbols

WORDS = {"en": "the of and with thing ration".split(), "de": "der und nicht schein keit zuüber".split(), "fr": "le éque oiau sur menté dans".split()}


def invented(lang, seed, n=60):
    pick = random.Random(f"{lang}{seed}")
    return " ".join(pick.choice(WORDS[lang]) for _ in range(n)).capitalize() + "."


def training(n=90):
    return [(i, invented(lang, i), lang) for i in range(n) for lang in [list(WORDS)[i % 3]]]


@pytest.mark.parametrize("window", [3, 50, 256])
def test_phrases_are_longest_matches(window):
    pick = random.Random(window)
    sample = "".join(pick.choice("abc ") for _ in range(300))
    texts = ["".join(pick.choice("abcd  9") for _ in range(pick.randint(0, 120))) for _ in range(40)]
    table = _symbols(list("abc"))
    symbols, _ = to_symbols([sample], table)
    automaton = suffix_automaton(symbols.tolist(), 5)
    own = "".join(map(chr, symbols))
    got = phrases(*to_symbols(texts, table), [automaton], window)[:, 0].tolist()
    for text, n in zip(texts, got):
        coded, count = "".join(map(chr, to_symbols([text], table)[0])), 0
        for at in range(0, len(coded), window):
            part = coded[at:at + window]
            while part:
                size = next((k for k in range(len(part), 0, -1) if part[:k] in own), 0)
                # A letter that is not in the sample is a phrase of its own where a phrase starts.
                count, part = count + 1, part[max(1, size):]
        assert n == count or not coded


def test_symbols_join_what_is_no_letter():
    symbols, ends = to_symbols(["", " 1a--B c", "é!"], _symbols(list("abc")))
    assert symbols.tolist() == [2, 0, 3, 0, 4, 1, 0]
    assert ends.tolist() == [0, 5, 7]
    assert to_symbols([], _symbols([]))[0].tolist() == []


def test_predictions_and_awkward_rows(spark):
    rows = training() + [(i, t) for i, t in AWKWARD]
    rows = [r if len(r) == 3 else (*r, None) for r in rows]
    got = {}
    for r in identify_languages(frame(spark, rows, clash=True)).collect():
        got.setdefault(r.doc_id, []).append(r)
    for i, _, lang in training():
        assert lang in {r.lang_pred for r in got[i]}
        assert all(r.held_out == (fold_of_id(i, 5) == 0) for r in got[i])
    alone = {r.doc_id: r for r in identify_languages(frame(spark, [(1000 + i, t, None) for i, t in AWKWARD if i] + training())).collect()}
    assert [alone[1000 + i].lang_pred for i in (1, 2, 3, 6)] == ["und"] * 4
    assert all(0 <= r.score <= 1 for r in alone.values())
    assert got[None][0].held_out is False


def test_labels_of_the_held_out_fold_are_not_used(spark):
    rows = training()
    spoiled = [(i, t, "xx" if fold_of_id(i, 5) == 0 else lang) for i, t, lang in rows]
    assert learn(frame(spark, rows)).languages == learn(frame(spark, spoiled)).languages == ["de", "en", "fr"]
    a, b = learn(frame(spark, rows)), learn(frame(spark, spoiled))
    assert all(np.array_equal(x, y) for x, y in zip(a.tables, b.tables))


def test_nothing_learned_and_empty(spark):
    got = identify_languages(frame(spark, [(1, "word", None), (2, None, None)])).collect()
    assert [(r.lang_pred, r.score) for r in got] == [("und", 0.0)] * 2
    assert identify_languages(frame(spark, [])).count() == 0
    kept = with_language(frame(spark, [(*r, None) for r in AWKWARD], clash=True))
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(i) for i, t in AWKWARD if t and any(c.isalpha() for c in t))


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    truth = dict(zip(*pq.read_table("/root/testdata/sf0.01/documents.parquet", columns=["doc_id", "lang"]).to_pydict().values()))
    held = [r for r in identify_languages(docs).collect() if r.held_out]
    assert len(held) > 100
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) / len(held) > 0.98


def scripts(lang, seed, n=200):
    """Languages of one script each, of 300 letters and few words; two of them share their letters."""
    pick = random.Random(f"{lang}{seed}")
    first = {"ja": 0x4E00, "ko": 0xAC00, "zh": 0x4E00}[lang]
    own = random.Random(lang)
    words = ["".join(chr(first + own.randrange(300)) for _ in range(3)) for _ in range(150)]
    return "".join(pick.choice(words) for _ in range(n))


@pytest.mark.parametrize("cells", [40_000_000, 1])
def test_large_scripts_are_told_apart(spark, monkeypatch, cells):
    monkeypatch.setattr(language, "CELLS", cells)
    latin = [(1000 + i, t + " " + "".join(map(chr, range(0x3B1, 0x3C9))) + "".join(map(chr, range(0x430, 0x450))) * 9, lang) for i, t, lang in training()]
    rows = latin + [(i, scripts(lang, i), lang) for i in range(60) for lang in [["ja", "ko", "zh"][i % 3]]]
    model = learn(frame(spark, rows))
    assert model.width > 500
    predict = language.predictor(model)
    tests = [(lang, scripts(lang, 5000 + i, 20)) for i in range(5) for lang in ("ja", "ko", "zh")] + [(lang, invented(lang, 9000)) for lang in WORDS]
    assert [p for p, _ in predict([t for _, t in tests])] == [lang for lang, _ in tests]


def test_searched_letters_count_as_in_a_table():
    pick = random.Random(5)
    letters = [chr(0x4E00 + i) for i in range(400)]
    sample, table = "".join(pick.choice(letters) for _ in range(3000)), _symbols(letters)
    texts = ["".join(pick.choice(letters + ["x", " "]) for _ in range(9)) + sample[at:at + 40] for at in range(0, 2900, 50)]
    symbols = to_symbols([sample], table)[0].tolist()
    own = automaton(transitions(symbols), 402)
    assert own.rare is not None and len(own.rare)
    parsed = to_symbols(texts, table)
    assert phrases(*parsed, [own]).tolist() == phrases(*parsed, [suffix_automaton(symbols, 402)]).tolist()


def test_every_language_is_learned(spark):
    def text(k, seed):
        own = random.Random(k)
        words = ["".join(own.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(5)) for _ in range(20)]
        pick = random.Random(seed)
        return " ".join(pick.choice(words) for _ in range(40))

    rows = [(10 * k + n, text(k, n), f"l{k:03}") for k in range(70) for n in range(4)]
    model = learn(frame(spark, rows))
    assert model.languages == [f"l{k:03}" for k in range(70)]
    assert [p for p, _ in language.predictor(model)([text(k, 99) for k in range(70)])] == model.languages


def test_languages_that_are_not_asked_for_go_and_unknown_ones_are_filled(spark):
    import pyarrow.parquet as pq

    rows = [(r["doc_id"], r["text"], r["lang"] if r["doc_id"] % 3 else None) for r in pq.read_table("/root/testdata/sf0.01/documents.parquet").to_pylist()]
    docs = frame(spark, rows)
    true = {r["doc_id"]: r["lang"] for r in pq.read_table("/root/testdata/sf0.01/documents.parquet").to_pylist()}
    asked = sorted({v for v in true.values() if v})[:2]
    kept = {name: with_language(docs, languages=(name,)).collect() for name in asked}
    for name, found in kept.items():
        right = [r for r in found if true[r.doc_id] == name]
        assert len(right) >= 0.95 * len(found) and len(right) >= 0.9 * sum(v == name for v in true.values())
        assert all(r.lang is not None for r in found)
    assert not {r.doc_id for r in kept[asked[0]]} & {r.doc_id for r in kept[asked[1]]}
    assert {r.lang for r in with_language(docs).collect() if true[r.doc_id] == asked[0] and r.doc_id % 3 == 0} >= {asked[0]}
