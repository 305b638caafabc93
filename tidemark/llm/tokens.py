"""Token-id files: flat unsigned integers, 64-bit document offsets, memory-mapped.

A token set in a folder is a number of parts in ascending doc_id order. Part p consists of

* ``<name>.bin``: the ids of all its documents, one after another, little-endian unsigned integers;
* ``<name>.off``: one more unsigned 64-bit number than documents: where each document starts in .bin, in ids;
* ``<name>.doc``: the documents' ids, signed 64-bit.

``manifest`` (Parquet) names the parts that belong to the set, with their numbers of documents and ids. The
first id of a part within the whole set is the prefix sum of the parts before it.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import filesystem, fresh, text_of
from tidemark.session import scratch_path

#: Half of the distinct units whose ids a Python worker remembers, and the bytes of the longest unit it remembers.
CACHED, CACHED_BYTES = 300_000, 48
#: Bytes of text whose units are looked up together.
STEP_BYTES = 4_000_000
_LINE = re.compile(r" ?\S+")
#: Classes of bytes, as the vocabulary's splitting pattern sees them. A two-byte letter goes by its first byte.
BLANK, SPACE, LETTER, DIGIT, MARK, FOLLOWS, OPEN = range(7)
#: First bytes of U+00C0 to U+027F (without the signs of multiplication and division) and of U+0400 to U+047F, letters all.
_LEADS = bytes([*range(0xC3, 0xCA), 0xD0, 0xD1])
_encoders: dict[tuple, UnitEncoder] = {}


def _class_of(byte: int) -> int:
    char = chr(byte)
    if byte == 0x20 or char in "\t\n\v\f\r":
        return BLANK if byte == 0x20 else SPACE
    if byte < 0x20 or char in "'\x7f":  # an apostrophe may start a contraction; control characters are left to the library
        return OPEN
    if byte < 0x80:
        return LETTER if char.isalpha() else DIGIT if char.isdigit() else MARK
    return FOLLOWS if byte < 0xC0 else LETTER if byte in _LEADS else OPEN


def _rule_of(before: int, here: int) -> int:
    """1: a unit starts at a byte of class ``here``. 2: it does if the white space ends there, before the text does."""
    if before <= SPACE:
        return 2 if here <= SPACE else int(before != BLANK)
    return int(before != here)


_CLASSES = bytes(map(_class_of, range(256)))
_RULES = bytes(_rule_of(pair >> 3, pair & 7) for pair in range(64)) + bytes(192)
_BLANKS = np.frombuffer(_CLASSES, np.uint8) <= SPACE
#: White space beyond ASCII, in UTF-8 as numbers of three bytes; those of two bytes with a last byte of zero.
_WIDE = [int.from_bytes(chr(c).encode().ljust(3, b"\0")) for c in (0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)]


def _before_visible(data: np.ndarray, kinds: np.ndarray) -> np.ndarray:
    """Which bytes are blanks that something visible follows; the splitting pattern starts a piece at each."""
    found = np.zeros(len(kinds), bool)
    np.logical_and(kinds[:-1] == BLANK, kinds[1:] > SPACE, out=found[:-1])
    at = np.flatnonzero(found[:-1] & (kinds[1:] == OPEN)) + 1
    at = at[data[at] >= 0x80]
    if len(at):
        first, second, third = (data[np.minimum(at + k, len(data) - 1)].astype(np.int64) for k in range(3))
        code = first << 16 | second << 8 | np.where(first < 0xE0, 0, third)
        found[at[np.isin(code, _WIDE)] - 1] = False
    return found


def unit_starts(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where units start in texts laid end to end in UTF-8, which start at ``starts`` (none is empty), and which units are open.

    Most units are pieces of the splitting pattern: a run of letters, of digits or of marks, maybe with a blank
    before it, or white space. Where a character has another class (an apostrophe, most other alphabets), the
    text from one blank to the next, by ``_before_visible``, is one open unit, which may hold many pieces. The
    pattern never joins characters of two units, so the ids of a text are those of its units.
    """
    kinds = np.frombuffer(bytearray(data.tobytes().translate(_CLASSES)), np.uint8)
    follows = np.flatnonzero(kinds == FOLLOWS)
    lead = data[follows - 1]
    letter = (kinds[follows - 1] == LETTER) & (lead >= 0x80) & ((lead != 0xC3) | ((data[follows] != 0x97) & (data[follows] != 0xB7)))
    kinds[follows] = np.where(letter, LETTER, OPEN)
    rules = np.zeros(len(kinds), np.uint8)
    rules[1:] = np.frombuffer(((kinds[:-1] << 3) | kinds[1:]).tobytes().translate(_RULES), np.uint8)
    inner = np.flatnonzero(rules == 2)
    ends = np.zeros(len(kinds) + 1, bool)
    ends[starts] = ends[-1] = True
    after = inner + 1
    rules[inner] = ~ends[after] & (kinds[np.minimum(after, len(kinds) - 1)] > SPACE)
    rules[starts] = 1
    at = np.flatnonzero(rules)
    if not (kinds == OPEN).any():
        return at, np.zeros(len(at), bool)
    whole = _before_visible(data, kinds)
    whole[starts - 1] = False  # a text's last byte has nothing after it
    whole[starts] = True
    at = np.flatnonzero(whole | (rules == 1))
    own = np.flatnonzero(whole[at])
    is_open = np.logical_or.reduceat(np.maximum.reduceat(kinds, at) == OPEN, own)
    keep = whole[at] | ~np.repeat(is_open, np.diff(np.append(own, len(at))))
    opened = np.zeros(len(at), bool)
    opened[own] = is_open
    return at[keep], opened[keep]


class UnitEncoder:
    """Byte-level BPE of the tokenizers library, with the ids of recurring units remembered.

    Texts are cut into units as ``unit_starts`` has it, and their distinct units found by Arrow. The library
    encodes those that are not remembered, many at once, and the ids of all units are gathered at once.
    """

    def __init__(self, path: str, width: int, ordinary: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import CharDelimiterSplit

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = ordinary
        self.special = [] if ordinary else [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.kind = np.dtype(f"<u{width}")
        if self.tokenizer.get_vocab_size() > np.iinfo(self.kind).max + 1:
            raise ValueError(f"ids of {path} need more than {width} bytes")
        shown = {*range(33, 127), *range(161, 173), *range(174, 256)}  # byte-level vocabularies write the other bytes as 256 and on
        hidden = [b for b in range(256) if b not in shown]
        self.letters = {b: chr(256 + i) for i, b in enumerate(hidden)}
        self.merger = Tokenizer(self.tokenizer.model)  #: takes pieces as they are, in the vocabulary's letters, one a line
        self.merger.pre_tokenizer = CharDelimiterSplit("\n")
        vocab = self.tokenizer.get_vocab()
        self.covers = np.zeros(max(vocab.values()) + 1, np.int64)  #: bytes of text that an id stands for
        self.covers[list(vocab.values())] = list(map(len, vocab))
        self.line_end = self.tokenizer.encode("\n", add_special_tokens=False).ids[0]
        self.cache: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    def _encode(self, units: list[str]) -> list[bytes]:
        """Ids of each unit. Units without white space inside go as the lines of one text, whose line ends are then cut out."""
        lines = [u for u in units if _LINE.fullmatch(u)]
        ids = np.array(self.tokenizer.encode_batch_fast(["\n".join(lines)], add_special_tokens=False)[0].ids, self.kind) if lines else np.empty(0, self.kind)
        ends = np.flatnonzero(ids == self.line_end)
        if len(ends) != max(0, len(lines) - 1):
            return self._each(units)
        cut = {u: ids[a:b].tobytes() for u, a, b in zip(lines, [0, *(ends + 1)], [*ends, len(ids)])}
        others = [u for u in units if u not in cut]
        cut.update(zip(others, self._each(others)))
        return [cut[u] for u in units]

    def _each(self, units: list[str]) -> list[bytes]:
        return [np.array(e.ids, self.kind).tobytes() for e in self.tokenizer.encode_batch_fast(units, add_special_tokens=False)]

    def _merge(self, units: list[bytes]) -> list[bytes]:
        """Ids of units that are one piece each and no white space, so that merges alone decide."""
        if not units:
            return []
        lines = b"\n".join(units)
        text = lines.decode("latin-1")
        for byte in set(lines) & self.letters.keys() - {10}:
            text = text.replace(chr(byte), self.letters[byte])
        ids = np.array(self.merger.encode_batch_fast([text], add_special_tokens=False)[0].ids, self.kind)
        ends = np.searchsorted(np.cumsum(self.covers[ids]), np.cumsum(np.fromiter(map(len, units), np.int64, len(units)))) + 1
        flat, ends = ids.tobytes(), (ends * self.kind.itemsize).tolist()
        return [flat[a:b] for a, b in zip([0, *ends], ends)]

    def _ids_of(self, units: list[bytes], odd: np.ndarray) -> list[bytes]:
        """Ids of distinct units; ``odd`` are those that may hold many pieces, or white space alone."""
        known, older = self.cache, self.older
        found = list(map(known.get, units))
        new = [i for i, ids in enumerate(found) if ids is None]
        made = list(map(older.get, map(units.__getitem__, new)))
        for i, ids in zip(new, made):
            found[i] = ids
        lacking = [i for i, ids in zip(new, made) if ids is None]
        hard = odd[lacking].tolist()
        for group, encode in (
            ([i for i, is_odd in zip(lacking, hard) if not is_odd], self._merge),
            ([i for i, is_odd in zip(lacking, hard) if is_odd], lambda units: self._encode([u.decode() for u in units])),
        ):
            for i, ids in zip(group, encode([units[i] for i in group])):
                found[i] = ids
        known.update((units[i], found[i]) for i in new if len(units[i]) <= CACHED_BYTES)
        return found

    def __call__(self, texts: list[str] | pa.Array) -> list[bytes]:
        """Ids of each text, as bytes."""
        if len(self.cache) > CACHED:  # what is used again comes back from the older half
            self.older, self.cache = self.cache, {}
        texts = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.large_string())
        texts.validate(full=True)  # units are found in bytes, which must be UTF-8
        texts = texts.cast(pa.large_binary())
        bounds = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8) if len(texts) else np.zeros(1, np.int64)
        size = int(bounds[-1] - bounds[0])
        if not size:
            return [b""] * len(texts)
        data = np.frombuffer(texts.buffers()[2], np.uint8, size, int(bounds[0]))
        bounds = bounds - bounds[0]
        at, opened = unit_starts(data, bounds[:-1][np.diff(bounds) > 0])
        stops = np.append(at, size)
        coded = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(at), [None, pa.py_buffer(stops), pa.py_buffer(data)]).dictionary_encode()
        place = coded.indices.to_numpy()
        odd = np.zeros(len(coded.dictionary), bool)
        odd[place[opened | _BLANKS[data[stops[1:] - 1]]]] = True
        made = pa.array(self._ids_of(coded.dictionary.to_numpy(zero_copy_only=False).tolist(), odd), pa.large_binary()).take(coded.indices)
        ends = np.frombuffer(made.buffers()[1], np.int64, len(made) + 1)[np.searchsorted(stops, bounds)].tolist()
        flat = memoryview(made.buffers()[2])
        found = [flat[a:b].tobytes() for a, b in zip(ends, ends[1:])]
        for special in self.special:
            for i in np.flatnonzero(pc.match_substring(texts, special).to_numpy(zero_copy_only=False)).tolist():
                found[i] = self._each([texts[i].as_py().decode()])[0]
        return found


def unit_encoder(path: str, width: int, ordinary: bool) -> UnitEncoder:
    """One encoder per Python worker, since it takes a second to load and remembers units between tasks."""
    key = (path, width, ordinary)
    if key not in _encoders:
        _encoders[key] = UnitEncoder(*key)
    return _encoders[key]


def _steps(texts: pa.Array):
    """Consecutive runs of whole texts, each of about ``STEP_BYTES`` or of a single longer text."""
    stops = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(texts):
        to = int(np.searchsorted(stops, (stops[at - 1] if at else 0) + STEP_BYTES)) + 1
        yield texts.slice(at, to - at)
        at = to


def _write_part(folder: str, end_id: int, make: Callable, kind: str):
    def run(batches):
        encode, number = make(), TaskContext.get().partitionId()
        files, place = filesystem(folder)
        name = fresh(f"part-{number:06d}")
        end = np.array([end_id], kind).tobytes()
        size, ids, offsets, docs, nulls = np.dtype(kind).itemsize, 0, [0], [], 0
        with files.open_output_stream(f"{place}/{name}.bin") as out:
            for batch in batches:
                for part in _steps(batch.column(1)):
                    for made in encode(part):
                        out.write(made)
                        out.write(end)
                        ids += len(made) // size + 1
                        offsets.append(ids)
                nulls += batch.column(0).null_count
                docs.append(batch.column(0).fill_null(0).to_numpy(zero_copy_only=False).astype("<i8"))
        for end_of, data in (("off", np.array(offsets, "<u8")), ("doc", np.concatenate([np.empty(0, "<i8"), *docs]))):
            with files.open_output_stream(f"{place}/{name}.{end_of}") as out:
                out.write(data.tobytes())
        yield pa.RecordBatch.from_pydict({"part": [number], "name": [name], "docs": [len(offsets) - 1], "null_ids": [nulls], "ids": [ids]})

    return run


def write_token_files(
    docs: DataFrame, folder: str, tokenizer: str, end_id: int, doc_id: str = "doc_id", text: str = "text",
    width: int = 2, ordinary: bool = False, parts: int | None = None,
) -> None:
    """Encode whole texts (null: empty), append ``end_id`` to each, and write the set to ``folder``.

    The vocabulary's special strings inside a text become their ids, as the library has it; ``ordinary`` reads
    them as ordinary text. Rows of one doc_id follow each other in the order of their texts; null ids come first. A task that is repeated writes files of other
    names, and only those of the attempt that counts get into the manifest.
    """
    spark = docs.sparkSession
    files, place = filesystem(folder)
    files.create_dir(place, recursive=True)
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), text_of(text).alias("text"))
    ordered = rows.repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", "text")
    kind = f"<u{width}"
    write = _write_part(folder, end_id, lambda: unit_encoder(tokenizer, width, ordinary), kind)
    ordered.mapInArrow(write, "part long, name string, docs long, null_ids long, ids long").write.parquet(f"{folder}/manifest")


def _read_part(folder: str, width: int):
    def numbers(files, path, kind):
        import pyarrow.fs as pafs

        if isinstance(files, pafs.LocalFileSystem):
            data = pa.memory_map(path).read_buffer()
        else:
            data = files.open_input_file(path).read_buffer()
        return np.frombuffer(data, kind)

    def run(batches):
        files, place = filesystem(folder)
        for batch in batches:
            for row in batch.to_pylist():
                if not row["docs"]:
                    continue
                path = f"{place}/{row['name']}"
                ids, offsets = numbers(files, f"{path}.bin", f"<u{width}"), numbers(files, f"{path}.off", "<u8").astype(np.int64)
                docs = numbers(files, f"{path}.doc", "<i8")
                for at in range(0, row["docs"], 10_000):
                    to = min(at + 10_000, row["docs"])
                    sums = [zlib.crc32(ids[offsets[i]:offsets[i + 1]].astype("<u4").tobytes()) for i in range(at, to)]
                    yield pa.RecordBatch.from_arrays([
                        pa.array(docs[at:to], pa.int64(), mask=np.arange(at, to) < row["null_ids"]),
                        pa.array(offsets[at:to] + row["base"], pa.int64()), pa.array(np.diff(offsets[at:to + 1]), pa.int64()),
                        pa.array(sums, pa.int64()),
                    ], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return run


def part_bases(spark: SparkSession, folder: str) -> list[tuple]:
    """(part, name, docs, null_ids, base) of every part that holds documents; one row per part, not per document."""
    bases, base = [], 0
    for row in sorted(spark.read.parquet(f"{folder}/manifest").collect(), key=lambda r: r.part):
        if row.docs:
            bases.append((row.part, row.name, row.docs, row.null_ids, base))
        base += row.ids
    return bases


def read_token_files(spark: SparkSession, folder: str, width: int = 2) -> DataFrame:
    """Per document of a token set: doc_id, start (in the whole set), n_tokens, ids_crc32 (as 32-bit numbers)."""
    bases = part_bases(spark, folder)
    rows = spark.createDataFrame(bases, "part long, name string, docs long, null_ids long, base long")
    spread = rows.repartitionByRange(max(1, len(bases)), "part")
    return spread.mapInArrow(_read_part(folder, width), "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_files(docs: DataFrame, tokenizer: str, end_id: int, folder: str | None = None, **options) -> DataFrame:
    """Write a token set and read it back."""
    folder = folder or scratch_path(docs.sparkSession, "tokens")
    write_token_files(docs, folder, tokenizer, end_id, **options)
    return read_token_files(docs.sparkSession, folder, options.get("width", 2))
