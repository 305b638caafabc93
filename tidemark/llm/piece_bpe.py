"""SentencePiece encoding of the merge type by backtracking, and decoding.

The merge rule joins the adjacent pair whose piece scores highest, the leftmost of equals, until nothing
joins. Its result is the one sequence of pieces in which every adjacent pair is *compatible*: re-merging the
two pieces' characters gives these two pieces again. So an encoder may walk over the text, take the longest
piece at each place (Aho-Corasick), go to shorter ones while the pair with the piece before is not compatible,
step back when none is left, and mark in a bit field the places from which nothing leads to the end.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from itertools import chain, compress, pairwise
from operator import itemgetter, not_

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.common import row_wise

#: Half of the distinct words a Python worker remembers, the longest it keeps, and pairs it remembers.
CACHED, CACHED_CHARS, PAIRS = 200_000, 48, 500_000
BLANK = "▁"
_RUNS = re.compile(r"[^\W\d_]+|\d+|_+|[^\w\s]+|\s+")
_WORDS = re.compile(f"{BLANK}+[^{BLANK}]*")
_FIRST, _SECOND = itemgetter(0), itemgetter(1)
_encoders: dict[tuple, PieceBpe] = {}


class PieceBpe:
    def __init__(self, path: str, end_id: int):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        of = self.library
        if of.unk_id() != 0:
            raise ValueError("the unknown piece must have id 0, which stands for no piece here")
        self.end_id = end_id
        plain = [i for i in range(of.get_piece_size()) if not (of.is_control(i) or of.is_unknown(i) or of.is_byte(i) or of.is_unused(i))]
        self.ids = {of.id_to_piece(i): i for i in plain}
        self.scores = {of.id_to_piece(i): of.get_score(i) for i in plain}
        self.bytes = [of.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        #: Whether texts can be cut before each run of blanks: no piece has a blank after another character.
        self.by_words = not any(BLANK in p.lstrip(BLANK) for p in self.ids)
        self.finder = ahocorasick.Automaton()
        for piece, i in self.ids.items():
            self.finder.add_word(piece, i)
        self.finder.make_automaton()
        self.single = {p for p in self.ids if len(p) == 1}
        #: Neighbouring characters of some piece. No merge can cross any other border.
        self.joined = {p[i:i + 2] for p in self.ids for i in range(len(p) - 1)}
        self.words: dict[str, tuple[tuple[int, ...], str]] = {}
        self.older: dict[str, tuple[tuple[int, ...], str]] = {}
        self.tails: dict[str, tuple[tuple[int, ...], str]] = {}
        self.pairs: dict[int, bool] = {}
        self.split: dict[str, tuple[str, str] | None] = {p: ("", "") for p in self.single}
        #: By id: the piece, its length, and the longest piece it starts with (0: none, the unknown piece's place).
        self.pieces = [""] * of.get_piece_size()
        for piece, i in self.ids.items():
            self.pieces[i] = piece
        self.sizes = [len(p) for p in self.pieces]
        self.shorter = [self.ids.get(next((p[:n] for n in range(len(p) - 1, 0, -1) if p[:n] in self.ids), ""), 0) for p in self.pieces]
        self.ranks = {p: i for i, p in enumerate(sorted((p for p in self.ids if len(p) > 1), key=lambda p: -self.scores[p]))}
        often = Counter(self.scores[p] for p in self.ranks)
        #: Pieces with the score of another, whose order of joining depends on where they stand: runs of blanks.
        self.tied = {p for p in self.ranks if often[self.scores[p]] > 1}

    def merge(self, text: str) -> list[str]:
        """The merge rule itself, down to one piece or to where nothing joins; for single pieces and short runs of blanks."""
        parts, scores = list(text), self.scores
        self.last = ("", "")
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = scores.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if best is None:
                break
            self.last = (parts[at], parts[at + 1])
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def halves(self, piece: str) -> tuple[str, str] | None:
        """The two pieces whose join makes this one last; None if the merge rule never makes it."""
        if piece not in self.split:
            self.split[piece] = self.last if self.merge(piece) == [piece] else None
        return self.split[piece]

    def compatible(self, left: str, right: str) -> bool:
        """Whether re-merging the two pieces' characters gives these pieces again; ``left`` empty: the second alone.

        Undoes the later of the two last merges again and again. Before each of them, the pieces that then
        met at the border must not have had a join that comes earlier.
        """
        return self.halves(right) is not None and (not left or self._meet(left, right))

    def _meet(self, left: str, right: str) -> bool:
        ranks, before, both = self.ranks, len(self.ranks) + 1, [left, right]
        while True:
            joined = left + right
            if joined in self.tied or left in self.tied or right in self.tied:
                return self.merge("".join(both)) == both
            if ranks.get(joined, before) < before:
                return False
            a = ranks[left] if len(left) > 1 else -1
            b = ranks[right] if len(right) > 1 else -1
            if a < 0 and b < 0:
                return True
            if a > b:
                before, left = a, self.halves(left)[1]
            else:  # of equal merges the left one comes first, so a join at the border would come before this one
                before, right = b + 1, self.halves(right)[0]

    def known(self, text: str) -> list[int]:
        """Ids of a text all of whose characters are pieces."""
        sizes, shorter, fits = self.sizes, self.shorter, self.pairs.get
        longest = [0] * len(text)
        for end, piece in self.finder.iter(text):  # of pieces that start together the longest ends last
            longest[end + 1 - sizes[piece]] = piece
        failed = 0  # bit field of the places from which nothing leads to the end
        taken: list[int] = []
        at, last, piece = 0, 0, longest[0]
        while True:
            end = at + sizes[piece]
            if not failed >> end & 1:
                fit = fits(last << 20 | piece)
                if fit is None:
                    if len(self.pairs) > PAIRS:
                        self.pairs.clear()
                    fit = self.pairs[last << 20 | piece] = self.compatible(self.pieces[last], self.pieces[piece])
                if fit:
                    taken.append(piece)
                    if end == len(text):
                        return taken
                    at, last, piece = end, piece, longest[end]
                    continue
            piece = shorter[piece]
            if not piece:
                failed |= 1 << at
                piece = taken.pop()
                at -= sizes[piece]
                last = taken[-1] if taken else 0

    def word(self, text: str) -> list[int]:
        """Ids of a word; characters that are no piece become their bytes and part what is beside them."""
        single = self.single
        if single.issuperset(text):
            return self.known(text)
        made: list[int] = []
        start = 0
        for at, char in enumerate(text):
            if char not in single:
                if at > start:
                    made += self.known(text[start:at])
                start = at + 1
                made += [self.bytes[b] for b in char.encode()]
        return made + self.known(text[start:]) if start < len(text) else made

    def _ids(self, text: str) -> tuple[tuple[int, ...], str]:
        ids = self.word(text)
        return tuple(ids), " ".join(map(str, ids))

    def _learn(self, words: set[str]) -> None:
        """Remember the ids of words without their blank, and the same in decimals.

        Where no piece holds the characters on both sides of a border between letters, digits, marks and white
        space, no merge crosses it, so a word's parts are learned one by one.
        """
        known, older, tails, joined = self.words, self.older, self.tails, self.joined
        for word in words:
            found = older.get(word)
            if found is None:
                head, *rest = _RUNS.findall(word) or [word]
                if rest and not any(a[-1] + b[0] in joined for a, b in pairwise([head, *rest])):
                    found = known.get(head) or older.get(head)
                    if found is None:
                        found = self._ids(BLANK + head)
                        if len(head) <= CACHED_CHARS:
                            known[head] = found
                    made = [found]
                    for part in rest:
                        tail = tails.get(part)
                        if tail is None:
                            tail = self._ids(part)
                            if len(part) <= CACHED_CHARS:
                                tails[part] = tail
                        made.append(tail)
                    found = tuple(chain.from_iterable(map(_FIRST, made))), " ".join(map(_SECOND, made))
                else:
                    found = self._ids(BLANK + word)
            known[word] = found

    def encode(self, text: str) -> tuple[list[int], str]:
        """Ids of a whole text with the end id, and the same in decimals."""
        if not text:
            return [self.end_id], str(self.end_id)
        if self.by_words and not (BLANK in text or "  " in text or text[0] == " " or text[-1] == " "):
            words = text.split(" ")
        else:
            whole = BLANK + text.replace(" ", BLANK)
            words = [w[1:] for w in (_WORDS.findall(whole) if self.by_words else [whole])]
        if len(self.words) > CACHED:  # what is used again comes back from the older half
            self.older, self.words, self.tails = self.words, {}, {}
        found = list(map(self.words.get, words))
        new = set()
        if None in found:
            new = set(compress(words, map(not_, found)))
            self._learn(new)
            found = list(map(self.words.__getitem__, words))
        ids = list(chain.from_iterable(map(_FIRST, found)))
        ids.append(self.end_id)
        decimals = f"{' '.join(map(_SECOND, found))} {self.end_id}"
        for word in new:
            if len(word) > CACHED_CHARS:
                del self.words[word]
        return ids, decimals

    def decode(self, ids: list[int]) -> str:
        return self.library.decode(ids)


def piece_bpe(path: str, end_id: int) -> PieceBpe:
    if (path, end_id) not in _encoders:
        _encoders[path, end_id] = PieceBpe(path, end_id)
    return _encoders[path, end_id]


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def encode_pieces(docs: DataFrame, model: str, end_id: int = 2, doc_id: str = "doc_id", text: str = "text", with_ids: bool = False) -> DataFrame:
    """Per document: doc_id, n_tokens, ids_sha256, decoded_sha256, and with ``with_ids`` the ids and the decoded text.

    Null texts count as empty and have the end id only. Repeated rows give repeated rows, an empty table none.
    The model must keep blanks as they are (no white-space or character normalisation).
    """
    schema = "n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids array<int>, decoded string" if with_ids else "")

    def make():
        bpe = piece_bpe(model, end_id)

        def run(texts):
            counts, shas, decoded_shas, all_ids, decoded = [], [], [], [], []
            for one in texts:
                ids, decimals = bpe.encode(one)
                counts.append(len(ids))
                shas.append(_sha(decimals))
                back = bpe.decode(ids)
                decoded_shas.append(_sha(back))
                if with_ids:
                    all_ids.append(ids)
                    decoded.append(back)
            made = [pa.array(counts, pa.int64()), pa.array(shas, pa.string()), pa.array(decoded_shas, pa.string())]
            return [*made, pa.array(all_ids, pa.list_(pa.int32())), pa.array(decoded, pa.string())] if with_ids else made

        return run

    return row_wise(docs, [doc_id], text, schema, make)
