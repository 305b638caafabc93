"""Benchmark decontamination by the q-gram lemma.

A passage within k edits of a benchmark item of m characters shares at least m + 1 - q - k*q character q-grams
with it, all on diagonals at most k beside the passage's own. So shared q-grams are counted in overlapping bands
of diagonals, bands that meet the bound are regions, and a banded alignment decides on each region. Counts are kept
for bands that occur only and are added up in steps of bounded size, so a text and an item that repeat one q-gram
over and over cost time, not memory. An item too short for a q-gram to tell it is looked for as it stands, as whole
words, by an automaton of all such items.

Texts and items are compared as their letters and digits in lower case, with one blank for anything between.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tidemark.llm.common import pieces, row_wise, text_of

#: Length of a q-gram (a power of two, as the hash doubles), edits allowed per character of an item, and the
#: shortest item that is looked for with edits; shorter ones are looked for exactly.
Q, EDITS, LEAST_CHARS = 8, 0.08, 24
#: Characters of one block of the benchmark, about 20 bytes each in a task; every block is held against all texts.
BLOCK_CHARS = 8_000_000
#: Pairs of equal q-grams, one in a text and one in an item, that are counted at a time.
STEP = 1 << 19
#: Bits of a q-gram's place in the first filter, and of the coarse diagonal blocks.
FILTER_BITS, COARSE_BITS = 22, 9
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)  # 2**64 / golden ratio, odd
BLANK = np.uint32(32)

_folded: list[np.ndarray] = []


class Items(NamedTuple):
    ids: list
    symbols: list[np.ndarray]
    edits: np.ndarray
    bounds: np.ndarray  #: q-grams that a passage shares at least
    grams: np.ndarray  #: sorted hashes
    owners: np.ndarray  #: item of each, by place in ids
    offsets: np.ndarray  #: where it starts in the item
    present: np.ndarray  #: first filter
    short: dict[str, list[int]]  #: places in ids of the items that are looked for exactly, by their words


def _fold_table() -> np.ndarray:
    """Lower-case code of letters and digits, 0 for all else."""
    if not _folded:
        table = np.zeros(0x110000, np.uint32)
        for code in range(0x110000):
            char = chr(code)
            if char.isalnum():
                lowered = char.lower()
                table[code] = ord(lowered) if len(lowered) == 1 else code
        _folded.append(table)
    return _folded[0]


def fold(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols of all texts, where each text ends among them, and the place of each symbol in its text."""
    sizes = np.array([len(t) for t in texts], np.int64)
    raw = _fold_table()[np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4")]
    starts = np.cumsum(sizes) - sizes
    before = np.concatenate([np.zeros(1, np.uint32), raw[:-1]]) if len(raw) else raw
    before[starts[sizes > 0]] = 0
    kept = np.flatnonzero((raw > 0) | (before > 0))
    ends = np.searchsorted(kept, starts + sizes)
    symbols = raw[kept]
    symbols[symbols == 0] = BLANK
    return symbols, ends, kept - np.repeat(starts, np.diff(ends, prepend=0))


def gram_hashes(symbols: np.ndarray) -> np.ndarray:
    """A hash of the Q symbols from each place on; exact enough, since alignments decide."""
    hashes, size = symbols.astype(np.uint64) + np.uint64(1), 1
    factor = _MULTIPLIER
    while size < Q:
        hashes = hashes[:-size] * factor + hashes[size:] if len(hashes) > size else hashes[:0]
        factor, size = np.uint64(int(factor) ** 2 % 2**64), 2 * size
    return hashes * _MULTIPLIER


def prepare_items(rows: list[tuple]) -> Items | None:
    """``rows``: (id, text). Texts that fold to the same symbols under one id count once; texts without any are not looked for."""
    ids, symbols, short = [], [], {}
    for item_id, text in sorted(rows, key=lambda r: (r[0] is None, r[0], r[1])):
        folded = fold([text])[0]
        while len(folded) and folded[-1] == BLANK:
            folded = folded[:-1]
        if len(folded) >= LEAST_CHARS:
            ids.append(item_id)
            symbols.append(folded)
        elif len(folded):
            short.setdefault(_words(folded), []).append(item_id)
    if not ids and not short:
        return None
    lengths = np.array([len(s) for s in symbols], np.int64)
    edits = np.minimum((lengths * EDITS).astype(np.int64), (lengths - Q) // Q)
    grams = [gram_hashes(s) for s in symbols]
    hashes = np.concatenate([np.empty(0, np.uint64), *grams])
    order = np.argsort(hashes, kind="stable")
    present = np.zeros(1 << FILTER_BITS, bool)
    present[hashes >> np.uint64(64 - FILTER_BITS)] = True
    owners = np.repeat(np.arange(len(ids), dtype=np.int32), [len(g) for g in grams])
    offsets = np.concatenate([np.empty(0, np.int32), *[np.arange(len(g), dtype=np.int32) for g in grams]])
    exact = {}
    for words, owners_of in short.items():
        exact[words] = list(range(len(ids), len(ids) + len(owners_of)))
        ids += owners_of
    return Items(ids, symbols, edits, lengths + 1 - Q - edits * Q, hashes[order], owners[order], offsets[order], present, exact)


def _words(symbols: np.ndarray) -> str:
    return symbols.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")


_automata: dict[int, tuple] = {}


def _automaton(items: Items):
    """Of the short items with a blank on both sides; one per Python worker and set of items."""
    key = id(items)
    if key not in _automata:
        import ahocorasick

        found = ahocorasick.Automaton()
        for words, places in items.short.items():
            found.add_word(f" {words} ", (len(words), places))
        found.make_automaton()
        _automata.clear()
        _automata[key] = (items, found)
    return _automata[key][1]


def short_passages(symbols: np.ndarray, ends: np.ndarray, items: Items):
    """(item, text, first, last) of every short item that stands as whole words in a text; places among all symbols."""
    start = 0
    for text, end in enumerate(ends.tolist()):
        for last, (size, places) in _automaton(items).iter(f" {_words(symbols[start:end])} "):
            first = start + last - 1 - size
            for item in places:
                yield item, text, first, first + size - 1
        start = end


def whole(item: np.ndarray, region: np.ndarray) -> tuple[int, int, int] | None:
    """The first place of the item itself."""
    data, sought, at = region.tobytes(), item.tobytes(), -1
    while (at := data.find(sought, at + 1)) >= 0:
        if at % 4 == 0:
            return 0, at // 4, at // 4 + len(item)
    return None


def align(item: np.ndarray, region: np.ndarray, most: int) -> tuple[int, int, int] | None:
    """(edits, start, end) of the best passage of ``region``, if within ``most`` edits; of equals the first to end.

    Semi-global alignment, one item symbol per step over the whole width of the region, which the caller has
    cut to the band.
    """
    n = len(region)
    steps = np.arange(n + 1)
    cost = np.zeros(n + 1, np.int64)
    began = steps.copy()
    for i, symbol in enumerate(item, 1):
        swap = cost[:-1] + (region != symbol)
        drop = cost[1:] + 1
        cell = np.where(swap <= drop, swap, drop)
        start = np.where(swap <= drop, began[:-1], began[1:])
        cell, start = np.concatenate([[i], cell]), np.concatenate([[0], start])
        # An extra symbol of the region costs one per step to the right of where it starts.
        slack = cell - steps
        best = np.minimum.accumulate(slack)
        source = np.maximum.accumulate(np.where(slack == best, steps, 0))
        cost, began = best + steps, start[source]
        if cost.min() > most:
            return None
    end = int(np.argmin(cost))
    return (int(cost[end]), int(began[end]), end) if cost[end] <= most else None


def _tally(parts) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys of all parts and how often each occurs; a part is reduced before the next is made."""
    keys, counts = np.empty(0, np.int64), np.empty(0, np.int64)
    for part in parts:
        found, times = np.unique(part, return_counts=True)
        both = np.concatenate([keys, found])
        order = np.argsort(both, kind="stable")
        both, times = both[order], np.concatenate([counts, times])[order]
        first = np.flatnonzero(np.diff(both, prepend=both[0] - 1)) if len(both) else np.empty(0, np.int64)
        keys, counts = both[first], np.add.reduceat(times, first) if len(first) else counts
    return keys, counts


def _times(keys: np.ndarray, counts: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, counts[at], 0)


def regions(symbols: np.ndarray, ends: np.ndarray, items: Items):
    """(item, text, lowest diagonal, highest diagonal) of every band with enough shared q-grams."""
    hashes = gram_hashes(symbols)
    places = np.flatnonzero(items.present[hashes >> np.uint64(64 - FILTER_BITS)])
    texts = np.searchsorted(ends, places, "right")
    inside = places + Q <= ends[np.minimum(texts, len(ends) - 1)]
    places, texts = places[inside], texts[inside]
    low = np.searchsorted(items.grams, hashes[places], "left")
    high = np.searchsorted(items.grams, hashes[places], "right")
    del hashes
    known = high > low
    places, texts, low, times = places[known], texts[known], low[known], (high - low)[known]
    if not len(places):
        return
    reach = np.cumsum(times)
    cuts = np.unique(np.concatenate([[0], np.searchsorted(reach, np.arange(STEP, reach[-1], STEP), "right"), [len(places)]]))
    shift = int(max(len(s) for s in items.symbols))

    def pairs():
        """(item, diagonal, text) of equal q-grams, some STEP at a time."""
        for a, b in zip(cuts[:-1], cuts[1:]):
            n = times[a:b]
            entries = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n - low[a:b], n)
            yield items.owners[entries].astype(np.int64), np.repeat(places[a:b], n) - items.offsets[entries] + shift, np.repeat(texts[a:b], n)

    # A first, coarse count: bands that cannot reach the bound even with all of their two coarse blocks go.
    width = (int(len(symbols)) + shift >> COARSE_BITS) + 3
    coarse = max(COARSE_BITS, int(4 * items.edits.max() + 2).bit_length())
    keys, counts = _tally(owner * width + (diagonal >> coarse) for owner, diagonal, _ in pairs())
    around = counts + _times(keys, counts, keys - 1) + _times(keys, counts, keys + 1)
    rich = keys[around >= items.bounds[keys // width]]
    if not len(rich):
        return
    # Bands of two steps that start at every step: wherever a ring of 2k + 1 diagonals lies, one band holds it.
    span = len(symbols) + shift + 4

    def banded():
        for owner, diagonal, text in pairs():
            key = owner * width + (diagonal >> coarse)
            kept = rich[np.minimum(np.searchsorted(rich, key), len(rich) - 1)] == key
            owner, diagonal, text = owner[kept], diagonal[kept], text[kept]
            key = (owner * len(ends) + text) * span + diagonal // (2 * items.edits[owner] + 1) + 1
            yield np.concatenate([key, key - 1])

    keys, shared = _tally(banded())
    keys = keys[shared >= items.bounds[keys // span // len(ends)]]
    if not len(keys):
        return
    firsts = np.flatnonzero(np.diff(keys, prepend=keys[0] - 2) > 1)
    lasts = np.append(firsts[1:], len(keys)) - 1
    for first, last in zip(keys[firsts].tolist(), keys[lasts].tolist()):
        pair, low_band = divmod(first, span)
        item, text_of_it = divmod(pair, len(ends))
        size = int(2 * items.edits[item] + 1)
        yield item, text_of_it, (low_band - 1) * size - shift, (last % span + 1) * size - 1 - shift


def find_passages(texts: list[str], items: Items) -> list[dict]:
    """Per text, its items: place of the item to (edits, start, end), the fewest edits, then the first place."""
    symbols, ends, at = fold(texts)
    found: list[dict] = [{} for _ in texts]
    if items.short:
        for item, text, first, last in short_passages(symbols, ends, items):
            found[text].setdefault(item, (0, int(at[first]), int(at[last]) + 1))
    if len(symbols) < Q or not items.symbols:
        return found
    starts = np.concatenate([[0], ends[:-1]])
    for item, text, low, high in regions(symbols, ends, items):
        own, most = items.symbols[item], int(items.edits[item])
        a = max(int(starts[text]), low - most)
        b = min(int(ends[text]), high + most + len(own))
        best = whole(own, symbols[a:b]) or align(own, symbols[a:b], most)
        if best is not None:
            edits, start, end = best
            span = (edits, int(at[a + start]), int(at[a + end - 1]) + 1)
            if item not in found[text] or span < found[text][item]:
                found[text][item] = span
    return found


def benchmark_blocks(benchmark: DataFrame, item_id: str = "item_id", text: str = "text") -> list[Items]:
    """The benchmark in blocks of bounded size, by a hash of the id; one block for any usual benchmark."""
    rows = benchmark.select(F.col(f"`{item_id}`").alias("id"), text_of(text).alias("text"))
    size = rows.agg(F.sum(F.length("text") + 16).alias("chars")).first()
    blocks = max(1, -(-(size["chars"] or 0) // BLOCK_CHARS))
    made = []
    for block in range(blocks):
        part = rows.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == block).distinct().collect()
        made.append(prepare_items([(r["id"], r["text"]) for r in part]))
    return [m for m in made if m is not None]


def find_leaks(
    docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """One row per document and benchmark item that occurs in it: doc_id, item_id, edits, start_char, end_char.

    Positions are code points of the whole text, end exclusive, of the passage with the fewest edits, of equals
    the first. Null texts and items count as empty; an item without a letter or digit is not looked for, one of
    fewer than LEAST_CHARS folded characters is found as whole words, without edits. Texts of any length are read
    whole. Repeated documents give repeated rows; an empty benchmark or table gives none.
    """
    spark = docs.sparkSession
    id_type = benchmark.schema[item_id].dataType.simpleString()
    found_type = pa.list_(pa.struct([("item", to_arrow_type(benchmark.schema[item_id].dataType)), ("edits", pa.int64()), ("start", pa.int64()), ("end", pa.int64())]))
    out = None
    for items in benchmark_blocks(benchmark, item_id, item_text):
        shared = spark.sparkContext.broadcast(items)

        def make(shared=shared):
            known = shared.value

            def run(texts):
                found = [[{"item": known.ids[i], "edits": e, "start": a, "end": b} for i, (e, a, b) in sorted(f.items())] for f in find_passages(texts, known)]
                return [pa.array(found, found_type)]

            return run

        part = row_wise(docs, [doc_id], text, f"found array<struct<item:{id_type},edits:bigint,start:bigint,end:bigint>>", make)
        part = part.select(F.col(f"`{doc_id}`").alias("doc_id"), F.explode("found").alias("f")).select(
            "doc_id", F.col("f.item").alias("item_id"), F.col("f.edits").alias("edits"), F.col("f.start").alias("start_char"), F.col("f.end").alias("end_char"))
        out = part if out is None else out.unionByName(part)
    if out is None:
        kind = docs.schema[doc_id].dataType.simpleString()
        out = spark.createDataFrame([], f"doc_id {kind}, item_id {id_type}, edits long, start_char long, end_char long")
    return out


def without_leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """The documents that no benchmark item occurs in, with all their columns."""
    for items in benchmark_blocks(benchmark, item_id, item_text):
        shared = docs.sparkSession.sparkContext.broadcast(items)

        @F.arrow_udf("boolean")
        def leaks(texts: pa.Array) -> pa.Array:
            return pa.array([bool(f) for part in pieces(texts.to_pylist()) for f in find_passages(part, shared.value)], pa.bool_())

        docs = docs.where(~leaks(text_of(text)))
    return docs
