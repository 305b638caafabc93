import random
import tracemalloc

import numpy as np
import pytest
from helpers_llm import AWKWARD, frame

from tidemark.llm.decontaminate import LEAST_CHARS, find_leaks, find_passages, fold, prepare_items, without_leaks


def words(pick, n):
    return " ".join("".join(pick.choice("aeinrst") for _ in range(pick.randint(2, 8))) for _ in range(n))


def edits(item, text):
    """Fewest edits between the item and any part of the text."""
    before = np.zeros(len(text) + 1, int)
    for i, symbol in enumerate(item, 1):
        now = [i]
        for j, other in enumerate(text, 1):
            now.append(min(before[j - 1] + (symbol != other), before[j] + 1, now[-1] + 1))
        before = np.array(now)
    return int(before.min())


def spoil(pick, text, n):
    chars = list(text)
    for _ in range(n):
        k, how = pick.randrange(len(chars)), pick.random()
        if how < 0.4:
            chars[k] = pick.choice("aeinrstz")
        elif how < 0.7:
            del chars[k]
        else:
            chars.insert(k, pick.choice("aeinrstz"))
    return "".join(chars)


@pytest.mark.parametrize("seed", range(4))
def test_brute_force(seed):
    pick = random.Random(seed)
    bench = [(n, words(pick, pick.choice([6, 12, 40]))) for n in range(6)]
    items = prepare_items(bench)
    texts = [words(pick, 20) + " " + spoil(pick, pick.choice(bench)[1], pick.randint(0, 14)) + " " + words(pick, 30) for _ in range(25)]
    texts += ["", "x", bench[0][1].upper(), bench[1][1].replace(" ", " !! ") * 3]
    found = 0
    for text, passages in zip(texts, find_passages(texts, items)):
        symbols = fold([text])[0].tolist()
        for k, item in enumerate(items.symbols):
            least = edits(item.tolist(), symbols)
            assert (k in passages) == (least <= items.edits[k])
            if k in passages:
                found += 1
                assert passages[k][0] == least
                start, end = passages[k][1:]
                assert edits(item.tolist(), fold([text[start:end]])[0].tolist()) == least
    assert found > 10


def test_rows(spark):
    pick = random.Random(9)
    bench = [(n, words(pick, 15)) for n in range(30)] + [(40, None), (41, "q z"), (42, "")]
    rows = AWKWARD + [(100 + n, words(pick, 40) + "\n" + bench[n][1].title() + ". " + words(pick, 30)) for n in range(30)] + [(300, words(pick, 300))]
    rows += [(400, bench[3][1] + " " + bench[4][1])] * 2
    table = spark.createDataFrame(bench, "item_id long, text string").selectExpr("*", "1 as found", "'x' as doc_id")
    docs = frame(spark, rows, clash=True)
    got = sorted((r.doc_id, r.item_id, r.edits) for r in find_leaks(docs, table).collect())
    assert got == sorted([(100 + n, n, 0) for n in range(30)] + [(400, 3, 0), (400, 4, 0)] * 2)
    kept = without_leaks(docs, table)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted([*(i for i, _ in AWKWARD), 300], key=str)


def test_blocks_give_the_same(spark, monkeypatch):
    from tidemark.llm import decontaminate

    pick = random.Random(5)
    bench = spark.createDataFrame([(n, words(pick, 12)) for n in range(20)], "item_id long, text string")
    docs = frame(spark, [(n, r.text + " tail " + words(pick, 9)) for n, r in enumerate(bench.collect())])
    whole = sorted(map(tuple, find_leaks(docs, bench).collect()))
    monkeypatch.setattr(decontaminate, "BLOCK_CHARS", 200)
    assert sorted(map(tuple, find_leaks(docs, bench).collect())) == whole and len(whole) == 20


def test_short_items_and_empty_tables(spark):
    assert prepare_items([(1, " .!"), (2, "")]) is None
    assert prepare_items([(1, "a" * (LEAST_CHARS - 1))]).short == {"a" * (LEAST_CHARS - 1): [0]}
    assert prepare_items([(1, "a" * LEAST_CHARS)]).edits.tolist() == [1]
    bench = spark.createDataFrame([(1, "the quick brown fox jumps over it all")], "item_id long, text string")
    assert find_leaks(frame(spark, []), bench).count() == 0
    assert find_leaks(frame(spark, AWKWARD), bench.where("false")).columns == ["doc_id", "item_id", "edits", "start_char", "end_char"]
    assert without_leaks(frame(spark, AWKWARD), bench.where("false")).count() == len(AWKWARD)


@pytest.mark.parametrize("step", [1 << 19, 100])
def test_items_of_any_length_against_brute_force(monkeypatch, step):
    from tidemark.llm import decontaminate

    monkeypatch.setattr(decontaminate, "STEP", step)
    pick = random.Random(21)
    bench = [(n, words(pick, 12)[:n].strip()) for n in range(1, 31)] + [(99, "aei"), (100, "aei")]
    items = prepare_items(bench)
    texts = [f"{words(pick, 12)}; {pick.choice(bench)[1].upper()}. {words(pick, 8)}" for _ in range(150)] + [b for _, b in bench]
    for text, passages in zip(texts, find_passages(texts, items)):
        folded = "".join(map(chr, fold([text])[0])).strip()
        for place, item_id in enumerate(items.ids):
            item = "".join(map(chr, fold([dict(bench)[item_id]])[0])).strip()
            if len(item) < LEAST_CHARS:
                assert (place in passages) == (f" {item} " in f" {folded} ")
                if place in passages:
                    start, end = passages[place][1:]
                    assert "".join(map(chr, fold([text[start:end]])[0])).strip() == item and passages[place][0] == 0
            else:
                assert (place in passages) == (edits(list(map(ord, item)), list(map(ord, folded))) <= items.edits[place])


def test_repeating_texts_and_items_stay_small():
    items = prepare_items([(1, "ha " * 200), (2, "x" * 600)])
    tracemalloc.start()
    found = find_passages(["ha " * 100_000], items)
    assert tracemalloc.get_traced_memory()[1] < 200e6
    tracemalloc.stop()
    assert list(found[0]) == [0] and found[0][0][0] == 0


def test_very_long_text_and_many_items():
    pick = random.Random(2)
    bench = [(n, words(pick, 9)) for n in range(10_000)]
    items = prepare_items(bench)
    text = "zq " * 1_700_000 + bench[77][1] + " zq" * 1_700_000
    assert list(find_passages([text], items)[0]) == [77]
