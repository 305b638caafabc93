"""Secret scan: fixed patterns, and random strings that a BPE vocabulary cannot shorten."""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.common import row_wise

# Fixed values of the contract.
KINDS = ("assign", "access", "hex", "random")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
ASSIGN_CHARS, ACCESS_CHARS, HEX_CHARS = 6, 20, 24
KEYWORDS = ("passw", "secret", "token", "api_key", "apikey")

RUN = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
#: Hex lengths of MD5, SHA-1, SHA-224, SHA-256, SHA-384 and SHA-512 digests.
DIGEST_CHARS = {32, 40, 56, 64, 96, 128}
_UUID = re.compile(r"[0-9a-fA-F]{8}-([0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12}")
_DIGEST = re.compile(r"([0-9a-f]+|[0-9A-F]+)")
#: Words joined by marks, each all letters (at most one capital run) or all digits: names, versions, dates, paths.
_NAME = re.compile(r"[+/_=-]*(([A-Z]*[a-z]+|[A-Z]+|[0-9]+|[a-z]+[0-9]{1,4}|[A-Z]+[0-9]{1,4})[+/_=-]+)*([A-Z]*[a-z]+|[A-Z]+|[0-9]+|[a-z]+[0-9]{1,4}|[A-Z]+[0-9]{1,4})?")

_LETTERS = re.compile(r"[A-Za-z]+")
#: What a run is made of between its marks; a UUID among them is one piece.
_PIECE = re.compile(rf"(?<![A-Za-z0-9])(?P<uuid>{_UUID.pattern})(?![A-Za-z0-9])|[A-Za-z0-9]+")

_IN_RUN = np.zeros(128, bool)
_IN_RUN[[ord(c) for c in RUN]] = True
_encodings: dict[str, object] = {}


def encoding(path: str):
    """A tiktoken vocabulary, loaded once per Python worker."""
    if path not in _encodings:
        import base64

        import public_tokenizers
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        _encodings[path] = tiktoken.Encoding("secrets", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _encodings[path]


def _digest(run: str) -> bool:
    return (len(run) in DIGEST_CHARS and _DIGEST.fullmatch(run) is not None) or _UUID.fullmatch(run) is not None


def _tokens(word: str, encode) -> int:
    """Tokens of a word; capitals are as good as small letters, which vocabularies know better."""
    return min(len(encode(word)), len(encode(word.lower()))) if word.isupper() else len(encode(word))


def known_identifier(run: str, encode=None, most_ratio: float = 2.0) -> bool:
    """Digests, UUIDs, numbers, and names: what is shaped as words and numbers, and with ``encode`` has the ratio of words too."""
    if _digest(run) or not any(c.isalpha() for c in run):
        return True
    if any(c.isdigit() for c in run) and _NAME.fullmatch(run) is None:
        return False
    words = _LETTERS.findall(run)
    return encode is None or sum(map(len, words)) >= most_ratio * sum(_tokens(w, encode) for w in words)


def runs(texts: list[str], least: int) -> list[list[tuple[int, int]]]:
    """Per text, the maximal runs of at least ``least`` characters of RUN, as code points."""
    joined = "\n".join(texts)
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4")
    inside = np.zeros(len(codes) + 2, np.int8)
    inside[1:-1] = _IN_RUN[np.minimum(codes, 127)] & (codes < 127)
    turns = np.flatnonzero(np.diff(inside))
    starts, ends = turns[::2], turns[1::2]
    long = ends - starts >= least
    found: list[list[tuple[int, int]]] = [[] for _ in texts]
    bases = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])])
    owners = np.searchsorted(bases, starts[long], "right") - 1
    for owner, start, end in zip(owners.tolist(), starts[long].tolist(), ends[long].tolist()):
        base = int(bases[owner])
        found[owner].append((start - base, end - base))
    return found


def base_spans(text: str, long_runs: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
    """(start, place of the kind, end) of the three fixed patterns, sorted.

    Access keys and hex strings lie within runs of RUN, so only runs that are long enough are searched.
    """
    spans = []
    lowered = text.lower()
    if any(word in lowered for word in KEYWORDS):
        spans += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_CHARS]
    for start, end in long_runs:
        if end - start >= ACCESS_CHARS:
            spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text, start, end) if m.end() - m.start() >= ACCESS_CHARS]
        if end - start >= HEX_CHARS:
            spans += [(m.start(), 2, m.end()) for m in HEX.finditer(text, start, end) if m.end() - m.start() >= HEX_CHARS]
    return sorted(spans)


def random_parts(run: str, barred, encode, least_chars: int, most_ratio: float) -> list[tuple[int, int]]:
    """The stretches of a run, from mark to mark, that have fewer than ``most_ratio`` characters per token.

    Every piece scores by how far it is below the ratio; numbers score nothing. The stretches are the maximal sums
    (Ruzzo and Tompa), so words before, between and after them stay outside. ``barred`` places are in none.
    """
    total, found = 0.0, []  # (sum before, sum after, start, end)
    for m in _PIECE.finditer(run):
        piece = m[0]
        if m["uuid"] or _digest(piece) or any(a < m.end() and m.start() < b for a, b in barred):
            total -= 1e9
            continue
        score = 0.0 if piece.isdigit() else most_ratio * _tokens(piece, encode) - len(piece)
        if score <= 0:
            total += score
            continue
        before, total, start = total, total + score, m.start()
        while True:
            at = next((i for i in range(len(found) - 1, -1, -1) if found[i][0] < before), -1)
            if at < 0 or found[at][1] >= total:
                break
            before, start = found[at][0], found[at][2]
            del found[at:]
        found.append((before, total, start, m.end()))
    return [(a, b) for _, _, a, b in found if sum(c.isalnum() for c in run[a:b]) >= least_chars and not known_identifier(run[a:b], encode, most_ratio)]


def random_spans(text: str, long_runs, taken, encode, most_ratio: float, least_chars: int = 20) -> list[tuple[int, int, int]]:
    """Runs of few characters per token that are no known identifier, or their parts that are.

    What a fixed pattern has touched, a digest or a UUID is in no span, but what stands beside it in the run may be.
    """
    spans = []
    for start, end in long_runs:
        run = text[start:end]
        if _digest(run):
            continue
        barred = [(a - start, b - start) for a, _, b in taken if a < end and start < b]
        whole = not barred and not any(m["uuid"] or _digest(m[0]) for m in _PIECE.finditer(run))
        if whole and len(run) < most_ratio * len(encode(run)) and not known_identifier(run, encode, most_ratio):
            spans.append((start, 3, end))
            continue
        spans += [(start + a, 3, start + b) for a, b in random_parts(run, barred, encode, least_chars, most_ratio)]
    return spans


def _written(spans) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def find_secrets(
    docs: DataFrame, vocabulary: str, doc_id: str = "doc_id", text: str = "text", least_chars: int = 20, most_ratio: float = 2.0,
) -> DataFrame:
    """Per document: doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_random.

    Spans are kind:start:end in code points, end exclusive, of whole matches. ``random`` spans are runs of at
    least ``least_chars``, or their parts between marks, with fewer than ``most_ratio`` characters per token of the
    tiktoken ``vocabulary`` file. Digests, UUIDs, what has no letter, and words with numbers are none, where the
    words have the ratio of words. Null texts count as empty and have no spans; repeated rows give repeated rows.
    """
    least = min(least_chars, ACCESS_CHARS, HEX_CHARS)

    def make():
        encode = encoding(vocabulary).encode_ordinary

        def run(texts):
            counts, shas, written = ([], [], [], []), [], []
            for one, found in zip(texts, runs(texts, least)):
                base = base_spans(one, found)
                more = random_spans(one, [r for r in found if r[1] - r[0] >= least_chars], base, encode, most_ratio, least_chars)
                for kind in range(3):
                    counts[kind].append(sum(s[1] == kind for s in base))
                counts[3].append(len(more))
                shas.append(hashlib.sha256(_written(base).encode()).hexdigest())
                written.append(_written(sorted(base + more)))
            n = [pa.array(c, pa.int64()) for c in counts]
            return [n[0], n[1], n[2], pa.array(shas, pa.string()), pa.array(written, pa.string()), n[3]]

        return run

    return row_wise(docs, [doc_id], text, "n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_random long", make)
