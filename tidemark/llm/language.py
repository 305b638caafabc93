"""Language identification by cross-parsing entropy.

For each language a suffix automaton of labelled text is built. A text is parsed from left to right into the
longest phrases that occur in a language's sample; a language that needs few phrases, each weighed by the
logarithm of its sample's length and divided by the text's length, is close to the text.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import fold_of, pieces, row_wise, text_of

#: Bounds of the labelled sample per language: documents, characters of one document, characters in all; and
#: languages that are sampled in one pass over the table. All languages are learned.
SAMPLE_DOCS, SAMPLE_DOC_CHARS, SAMPLE_CHARS, LANGUAGES = 400, 2_000, 30_000, 64
#: Letters of a language whose transitions are a table; those of its other letters are searched for.
LETTERS = 120
#: Cells of such tables that a Python worker holds at a time; more languages than that are gone through in blocks.
CELLS = 40_000_000
#: Texts are parsed in windows of so many symbols, all windows of a batch in step.
WINDOW = 256
_RESTART = np.uint32(1 << 31)
_STATE = np.uint32((1 << 31) - 1)
UNDETERMINED = "und"


class Model(NamedTuple):
    languages: list[str]
    symbols: np.ndarray  #: symbol of every code point: 0 none, 1 a letter of no sample, from 2 on the letters of all samples
    tables: list[np.ndarray]  #: per language: rows (state, symbol, next state) of its automaton
    bits: list[float]  #: log2 of the sample's length
    width: int  #: number of symbols


class Automaton(NamedTuple):
    table: np.ndarray  #: (state * width + column) to next state * width, with a mark where a phrase ended
    width: int
    columns: np.ndarray | None = None  #: column of every symbol, the last one for searched letters; none where they are the symbols
    rare: np.ndarray | None = None  #: sorted: state * number of symbols + symbol, of searched letters
    rare_to: np.ndarray | None = None  #: next state * width

    def step(self, state: np.ndarray, now: np.ndarray) -> np.ndarray:
        if self.columns is None:
            return self.table[state + now]
        column = self.columns[now]
        to = self.table[state + column]
        at = np.flatnonzero(column == self.width - 1)
        if len(at):
            sought = (state[at] // self.width).astype(np.int64) * len(self.columns) + now[at]
            place = np.minimum(np.searchsorted(self.rare, sought), len(self.rare) - 1)
            # A searched letter is in the sample, so the root, state 0, always has it.
            root = self.rare_to[np.searchsorted(self.rare, now[at].astype(np.int64))] | _RESTART
            to[at] = np.where(self.rare[place] == sought, self.rare_to[place], root)
        return to


def transitions(symbols: list[int]) -> np.ndarray:
    """Rows (state, symbol, next state) of the suffix automaton; state 0 is the root."""
    links, lengths, moves = [-1], [0], [{}]
    last = 0
    for s in symbols:
        at = len(moves)
        links.append(0)
        lengths.append(lengths[last] + 1)
        moves.append({})
        p = last
        while p >= 0 and s not in moves[p]:
            moves[p][s] = at
            p = links[p]
        if p >= 0:
            q = moves[p][s]
            if lengths[p] + 1 == lengths[q]:
                links[at] = q
            else:
                copy = len(moves)
                links.append(links[q])
                lengths.append(lengths[p] + 1)
                moves.append(dict(moves[q]))
                while p >= 0 and moves[p].get(s) == q:
                    moves[p][s] = copy
                    p = links[p]
                links[q] = links[at] = copy
        last = at
    sizes = [len(m) for m in moves]
    made = np.empty((sum(sizes), 3), np.int32)
    made[:, 0] = np.repeat(np.arange(len(moves)), sizes)
    made[:, 1] = [s for m in moves for s in m]
    made[:, 2] = [to for m in moves for to in m.values()]
    return made


def _table(moves: np.ndarray, columns: np.ndarray, width: int) -> np.ndarray:
    """Transitions as a table, in which a missing one starts anew at the root, marked.

    The last state stands after a symbol that the sample does not have: a phrase of its own.
    """
    states = int(moves[:, 2].max(initial=0)) + 1
    root = np.full(width, states * width, np.uint32)
    at_root = moves[:, 0] == 0
    root[columns[at_root]] = moves[at_root, 2] * width
    table = np.tile(root | _RESTART, (states + 1, 1))
    table[0] = root
    table[moves[:, 0], columns] = moves[:, 2] * width
    return table.ravel()


def suffix_automaton(symbols: list[int], width: int) -> np.ndarray:
    moves = transitions(symbols)
    return _table(moves, moves[:, 1], width)


def automaton(moves: np.ndarray, n_symbols: int) -> Automaton:
    """An automaton over its language's own alphabet, unless a table has room for all symbols."""
    if n_symbols <= LETTERS + 2:
        return Automaton(_table(moves, moves[:, 1], n_symbols), n_symbols)
    times = np.bincount(moves[:, 1], minlength=n_symbols)
    own = 2 + np.flatnonzero(times[2:])
    own = own[np.argsort(-times[own], kind="stable")]
    often, rest = own[:LETTERS], own[LETTERS:]
    width = len(often) + 3
    columns = np.ones(n_symbols, np.uint8)
    columns[0] = 0
    columns[often] = np.arange(len(often)) + 2
    columns[rest] = width - 1
    searched = columns[moves[:, 1]] == width - 1
    keys = moves[searched, 0].astype(np.int64) * n_symbols + moves[searched, 1]
    order = np.argsort(keys)
    # The searched letters' own column is never used, but their states count.
    table = _table(np.concatenate([moves[~searched], moves[searched]]), np.concatenate([columns[moves[~searched, 1]], columns[moves[searched, 1]]]), width)
    return Automaton(table, width, columns, keys[order], (moves[searched, 2][order] * width).astype(np.uint32))


def _symbols(known: list[str]) -> np.ndarray:
    at = {c: i + 2 for i, c in enumerate(known)}
    table = np.zeros(0x110000, np.uint8 if len(known) <= 250 else np.uint16 if len(known) <= 65_000 else np.uint32)
    for code in range(0x110000):
        char = chr(code)
        if char.isalpha():
            lowered = char.lower()
            table[code] = at.get(lowered, 1) if len(lowered) == 1 else 1
    return table


def to_symbols(texts: list[str], table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of all texts, runs of non-letters as one and none at a text's start; and where each text ends."""
    sizes = np.array([len(t) for t in texts], np.int64)
    raw = table[np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4")]
    before = np.concatenate([np.zeros(1, raw.dtype), raw[:-1]]) if len(raw) else raw
    before[(np.cumsum(sizes) - sizes)[sizes > 0]] = 0
    kept = (raw > 0) | (before > 0)
    ends = np.concatenate([[0], np.cumsum(kept)])[np.cumsum(sizes)]
    return raw[kept], ends


def phrases(symbols: np.ndarray, ends: np.ndarray, tables: list[np.ndarray | Automaton], window: int = WINDOW) -> np.ndarray:
    """Phrases per text and table. Windows of a text are parsed one by one, so each adds at most one phrase."""
    sizes = np.diff(ends, prepend=0)
    per_text = -(-sizes // window)
    owners = np.repeat(np.arange(len(sizes)), per_text)
    nth = np.arange(len(owners)) - np.repeat(np.cumsum(per_text) - per_text, per_text)
    starts = (ends - sizes)[owners] + nth * window
    lengths = np.minimum(sizes[owners] - nth * window, window)
    order = np.argsort(-lengths, kind="stable")
    starts, lengths, owners = starts[order], lengths[order], owners[order]
    active = np.searchsorted(-lengths, -np.arange(window), "left")
    found = np.zeros((len(sizes), len(tables)), np.int64)
    states = [np.zeros(len(starts), np.uint32) for _ in tables]
    counts = [np.ones(len(starts), np.uint32) for _ in tables]
    for i in range(window):
        n = active[i]
        if not n:
            break
        now = symbols[starts[:n] + i]
        for table, state, count in zip(tables, states, counts):
            to = table.step(state[:n], now) if isinstance(table, Automaton) else table[state[:n] + now]
            count[:n] += to >> np.uint32(31)
            state[:n] = to & _STATE
    for k, count in enumerate(counts):
        found[:, k] = np.bincount(owners, count, len(sizes)).astype(np.int64)
    return found


def learn(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", folds: int = 5, held: int = 0) -> Model:
    """A model of rows with a language that are not in the held-out fold.

    The sample is bounded: per language at most SAMPLE_DOCS documents in the order of a hash of their id and
    SAMPLE_CHARS characters in all. Only the sample comes to the driver.
    """
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), text_of(text).alias("text"), F.col(f"`{lang}`").cast("string").alias("lang"))
    rows = rows.where(F.col("lang").isNotNull() & (fold_of("doc_id", folds) != held))
    counts = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").collect()
    samples: dict[str, str] = {}
    for at in range(0, len(counts), LANGUAGES):
        samples |= _samples(rows, {c["lang"]: c["count"] for c in counts[at:at + LANGUAGES]})
    samples = {k: v for k, v in sorted(samples.items()) if any(c.isalpha() for c in v)}
    known = sorted({c for v in samples.values() for c in v if c.isalpha()})
    table, tables, bits = _symbols(known), [], []
    for sample in samples.values():
        symbols, _ = to_symbols([sample], table)
        tables.append(transitions(symbols.tolist()))
        bits.append(float(np.log2(max(2, len(symbols)))))
    return Model(list(samples), table, tables, bits, len(known) + 2)


def _samples(rows: DataFrame, counts: dict[str, int]) -> dict[str, str]:
    share = F.lit(0.0)
    for lang, count in counts.items():
        share = F.when(F.col("lang") == lang, min(1.0, 2 * SAMPLE_DOCS / count)).otherwise(share)
    spread = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)).alias("spread")
    chosen = rows.select("lang", "doc_id", spread, F.substring("text", 1, SAMPLE_DOC_CHARS).alias("text")).where(F.col("spread") < share * (1 << 30))
    by_lang: dict[str, list] = {}
    for row in chosen.collect():
        by_lang.setdefault(row.lang, []).append((row.spread, row.doc_id, row.text))
    return {k: " ".join(t for _, _, t in sorted(v)[:SAMPLE_DOCS])[:SAMPLE_CHARS].lower() for k, v in by_lang.items()}


def predictor(model: Model):
    """A function from texts to (language, score 0 to 1) pairs. Ties fall to the first language by name."""

    blocks, cells = [[]], 0
    for k, moves in enumerate(model.tables):
        size = (int(moves[:, 2].max(initial=0)) + 2) * min(model.width, LETTERS + 3)
        if blocks[-1] and cells + size > CELLS:
            blocks.append([])
            cells = 0
        blocks[-1].append(k)
        cells += size

    def automata(block: list[int]) -> list[Automaton]:
        return [automaton(model.tables[k], model.width) for k in block]

    kept = automata(blocks[0]) if len(blocks) == 1 else None

    def predict(texts: list[str]) -> list[tuple[str, float]]:
        symbols, ends = to_symbols(texts, model.symbols)
        sizes = np.diff(ends, prepend=0)
        letters = np.diff(np.concatenate([[0], np.cumsum(symbols > 0)])[ends], prepend=0)
        if not model.languages:
            return [(UNDETERMINED, 0.0)] * len(texts)
        found = np.concatenate([phrases(symbols, ends, kept or automata(block)) for block in blocks], 1)
        cost = found * np.array(model.bits) / np.maximum(sizes, 1)[:, None]
        best = np.argmin(cost, 1)
        weight = np.exp2(-4 * (cost - cost.min(1, keepdims=True)))
        score = weight[np.arange(len(texts)), best] / weight.sum(1)
        return [(model.languages[b], float(s)) if n else (UNDETERMINED, 0.0) for b, s, n in zip(best, score, letters)]

    return predict


def identify_languages(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", folds: int = 5, held: int = 0) -> DataFrame:
    """Per document: doc_id, held_out, lang_pred, score. Text alone decides.

    ``und`` with score 0 for null texts and texts without a letter, and for all where nothing could be learned.
    A null id is in no fold, so it is neither learned from nor held out. Repeated rows give repeated rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(learn(docs, doc_id, text, lang, folds, held))

    def make():
        predict = predictor(shared.value)

        def run(texts):
            made = predict(texts)
            return [pa.array([m[0] for m in made], pa.string()), pa.array([m[1] for m in made], pa.float64())]

        return run

    found = row_wise(docs, [doc_id], text, "lang_pred string, score double", make)
    held_out = F.coalesce(fold_of(doc_id, folds) == held, F.lit(False))
    return found.select(F.col(f"`{doc_id}`").alias("doc_id"), held_out.alias("held_out"), "lang_pred", "score")


def with_language(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", languages: tuple[str, ...] | None = None,
) -> DataFrame:
    """The documents whose text is predicted to be in one of ``languages`` (any learned one by default), with all their columns.

    A null ``lang`` is filled with the prediction; a stated one stays. Texts without any letter go. Where nothing
    could be learned, texts with a letter stay, unless languages are asked for.
    """
    shared = docs.sparkSession.sparkContext.broadcast(learn(docs, doc_id, text, lang))

    @F.arrow_udf("string")
    def predicted(texts: pa.Array) -> pa.Array:
        predict = predictor(shared.value)
        if not shared.value.languages:
            return pa.array(["" if any(c.isalpha() for c in t) else None for t in texts.to_pylist()], pa.string())
        return pa.array([None if found == UNDETERMINED else found for part in pieces(texts.to_pylist()) for found, _ in predict(part)], pa.string())

    mark = "_" * (1 + max(map(len, docs.columns)))  # a name no column has
    # Not deterministic to the planner, or it would predict once for the filter and again for the column.
    found = docs.withColumn(mark, predicted.asNondeterministic()(text_of(text))).where(F.col(mark).isNotNull())
    if languages is not None:
        found = found.where(F.col(mark).isin(list(languages)))
    kind = docs.schema[lang].dataType
    filled = F.coalesce(F.col(f"`{lang}`"), F.nullif(F.col(mark), F.lit("")).cast(kind)).alias(lang)
    return found.select(*[filled if c == lang else F.col(f"`{c}`") for c in docs.columns])
