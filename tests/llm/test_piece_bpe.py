import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece
from helpers_llm import AWKWARD, frame

from tidemark.llm.piece_bpe import PieceBpe, encode_pieces

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def test_same_ids_as_the_library(library):
    pick, bpe = random.Random(7), PieceBpe(MODEL, 2)
    signs = ["ab c", "  \n\tthe of", "▁ aé漢\U0001f600x\x00", "0123456789abcdef -", "thneringo ", " ", "ABCdef.,!? "]
    for _ in range(500):
        for s in signs:
            text = "".join(pick.choice(s) for _ in range(pick.randint(0, 60)))
            ids, decimals = bpe.encode(text)
            assert ids == [*library.encode(text), 2], text
            assert decimals == " ".join(map(str, ids))


def test_compatible_pairs_are_those_that_merge_to_themselves():
    bpe, pick = PieceBpe(MODEL, 2), random.Random(3)
    pieces = list(bpe.ids)
    for _ in range(4000):
        left, right = pick.choice(pieces), pick.choice(pieces)
        if bpe.halves(left) and bpe.halves(right):
            assert bpe.compatible(left, right) == (bpe.merge(left + right) == [left, right])


def test_rows_of_a_table(spark, library):
    def sha(text):
        return hashlib.sha256(text.encode()).hexdigest()

    want = []
    for doc_id, text in AWKWARD:
        ids = [*library.encode(text or ""), 2]
        want.append((doc_id, len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids))))
    got = encode_pieces(frame(spark, AWKWARD, clash=True), MODEL).collect()
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    whole = encode_pieces(frame(spark, AWKWARD[3:5]), MODEL, with_ids=True).collect()
    assert [r.decoded for r in whole] == [t for _, t in AWKWARD[3:5]]
    assert encode_pieces(frame(spark, []), MODEL).count() == 0
