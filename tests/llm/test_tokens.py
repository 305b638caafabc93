import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from helpers_llm import AWKWARD, frame
from tokenizers import Tokenizer

from tidemark.llm.tokens import UnitEncoder, part_bases, token_files, unit_starts

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def plain():
    return Tokenizer.from_file(PATH)


@pytest.mark.parametrize("ordinary", [False, True])
def test_units_give_the_ids_of_the_whole_text(ordinary):
    plain = Tokenizer.from_file(PATH)
    if ordinary:
        plain.encode_special_tokens = True
    pick, encode = random.Random(5), UnitEncoder(PATH, 2, ordinary)
    signs = ["ab c", "  \n\tthe of's \x1c\x85\xa0", "▁ aé漢\U0001f600x", "0123 456-", "thneringo ", "Wört.\nÄb, ", "<|endoftext|> a"]
    texts = ["".join(pick.choice(s) for _ in range(pick.randint(0, 50))) for _ in range(400) for s in signs]
    assert encode([]) == [] and encode([""]) == [b""]
    assert [np.frombuffer(b, "<u2").tolist() for b in encode(texts)] == [plain.encode(t, add_special_tokens=False).ids for t in texts]


def test_wide_white_space_and_other_alphabets(plain):
    pick, encode = random.Random(7), UnitEncoder(PATH, 2, False)
    spaces = " \t\n\v\f\r\x1c\x1f\x85\xa0\u1680\u2003\u200b\u2028\u202f\u205f\u3000"
    signs = [spaces, "  a", "'s", "×÷éÀÿ", "Łőſƀɏ", "Жщё҂", "Ωλ", "漢字。", "“—…", "\U0001f600\u0301", "aZ09.,-"]
    texts = ["".join(pick.choice(pick.choice(use)) for _ in range(pick.randint(0, 12))) for use in (pick.sample(signs, 3) for _ in range(6000))]
    assert [np.frombuffer(b, "<u2").tolist() for b in encode(texts)] == [plain.encode(t, add_special_tokens=False).ids for t in texts]


def test_units_are_pieces_of_the_pattern():
    def units(*texts):
        data = "".join(texts).encode()
        at, opened = unit_starts(np.frombuffer(data, np.uint8), np.cumsum([0, *(len(t.encode()) for t in texts[:-1])]))
        return [(data[a:b].decode(), bool(o)) for a, b, o in zip(at, [*at[1:], len(data)], opened)]

    assert units("One tëst, 12.\n\nEnd ", " x") == [(u, False) for u in ["One", " tëst", ",", " 12", ".", "\n", "\n", "End", " ", " x"]]
    assert units("a it's, so  漢 b.") == [("a", False), (" it's,", True), (" so", False), (" ", False), (" 漢", True), (" b", False), (".", False)]


def test_new_words_go_to_the_library_at_once():
    class Counted:
        calls = 0

        def __init__(self, inner):
            self.inner = inner

        def __getattr__(self, name):
            Counted.calls += 1
            return getattr(self.inner, name)

    encode = UnitEncoder(PATH, 2, False)
    for name in {"tokenizer", "merger", "model"} & vars(encode).keys():
        setattr(encode, name, Counted(getattr(encode, name)))
    words = [chr(97 + n % 26) + chr(97 + n // 26 % 26) + "qzk" + chr(97 + n // 676) for n in range(2000)]
    encode([" ".join(words), ", ".join(words) + "."])
    assert Counted.calls <= 5


def test_special_strings_become_their_ids(spark, plain):
    got = token_files(frame(spark, [(1, "a<|endoftext|>b"), (2, "<|endoftext|>"), (3, "x <|endoftext|> y  z")]), PATH, 2).collect()
    assert plain.encode("a<|endoftext|>b", add_special_tokens=False).ids == [64, 50256, 65]
    assert [r.n_tokens for r in sorted(got)] == [4, 2, len(plain.encode("x <|endoftext|> y  z", add_special_tokens=False).ids) + 1]


def test_files_hold_ids_in_order(spark, plain, tmp_path):
    rows = AWKWARD + [(50 - n, f"Text number {n}, with {n * n} in it.") for n in range(40)]
    folder = str(tmp_path / "set")
    got = token_files(frame(spark, rows, clash=True).repartition(4), PATH, 2, folder, parts=3).collect()
    start, want = 0, []
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0], r[1] or "")):
        ids = plain.encode(text or "", add_special_tokens=False).ids + [2]
        want.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(map(tuple, got), key=lambda r: r[1]) == want
    flat = np.concatenate([np.fromfile(f"{folder}/{name}.bin", "<u2") for _, name, *_ in part_bases(spark, folder)])
    assert len(flat) == start


def test_bytes_that_are_no_text_are_refused():
    odd = pa.StringArray.from_buffers(1, pa.py_buffer(np.array([0, 3], "<i4")), pa.py_buffer(b"a\xc3b"))
    with pytest.raises(pa.ArrowInvalid):
        UnitEncoder(PATH, 2, False)(odd)


def test_empty_table_and_narrow_ids(spark):
    assert token_files(frame(spark, []), PATH, 2).count() == 0
    with pytest.raises(ValueError):
        UnitEncoder(PATH, 1, True)
