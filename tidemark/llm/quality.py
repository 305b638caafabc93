"""Quality by compression: dictionaries of good and of bad text, and how much better one of them serves."""

from __future__ import annotations

import math
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import fold_of, row_wise, text_of

#: Bounds of the labelled sample: documents per class, and bytes of one document that are used for learning.
SAMPLE_DOCS, SAMPLE_DOC_BYTES = 1_500, 16_384
#: Parts of the sample that are measured in turn.
PARTS = 4
DICTIONARY_BYTES = 48 * 1024
#: Texts are compressed in pieces of so many bytes, so that a dictionary counts in all of a long text.
PIECE = 2_048
LEVEL = 3
#: A text of so many bytes still counts as short by a third.
SHORT_BYTES = 64


class Model(NamedTuple):
    good: bytes
    bad: bytes
    weights: tuple[float, ...]  #: of the gain, of shortness, and the offset


def _cut(text: bytes) -> list[bytes]:
    return [text[i:i + PIECE] for i in range(0, len(text), PIECE)]


def _dictionary(texts: list[bytes]) -> bytes:
    """A zstandard dictionary; raw content where there is too little text to train one."""
    import zstandard

    parts = [p for t in texts for p in _cut(t) if len(p) >= 8]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, parts).as_bytes()
    except zstandard.ZstdError:
        return b"".join(parts)[:DICTIONARY_BYTES]


def _dictionaries(classes: dict[int, list[bytes]]) -> tuple[bytes, bytes]:
    """Of good and of bad text; of equally much of both, so that neither serves better for knowing more."""
    most = min(sum(map(len, classes[v])) for v in (0, 1))
    ends = {v: np.cumsum([len(t) for t in classes[v]]) for v in (0, 1)}
    good, bad = (_dictionary(classes[v][:max(1, int(np.searchsorted(ends[v], most, "right")))]) for v in (1, 0))
    return good, bad


def measure(good: bytes, bad: bytes):
    """A function from a text's bytes to (size by the bad dictionary - size by the good one) / bytes; 0 if empty."""
    import zstandard

    def compressor(content: bytes):
        d = zstandard.ZstdCompressionDict(content) if content else None
        if d is not None:
            d.precompute_compress(level=LEVEL)
        return zstandard.ZstdCompressor(level=LEVEL, dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False)

    by_good, by_bad = compressor(good), compressor(bad)

    def of(text: bytes) -> float:
        return sum(len(by_bad.compress(p)) - len(by_good.compress(p)) for p in _cut(text)) / len(text) if text else 0.0

    return of


def features(gain: float, size: int) -> list[float]:
    """The gain, how short the text is (few bytes cannot show a difference), and 1 for the offset."""
    return [gain, math.exp(-size / SHORT_BYTES), 1.0]


def fit_logistic(x: np.ndarray, y: np.ndarray, steps: int = 50) -> np.ndarray:
    """Weights of a logistic regression by Newton's method, with a slight pull to zero."""
    scale = np.maximum(np.sqrt((x ** 2).mean(0)), 1e-9)
    design, w = x / scale, np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        gradient = design.T @ (p - y) + 0.1 * w
        hessian = (design * (p * (1 - p))[:, None]).T @ design + 0.1 * np.eye(len(w))
        w = w - np.linalg.solve(hessian, gradient)
    return w / scale


def learn(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality", folds: int = 4, held: int = 2) -> Model:
    """Dictionaries and calibration from a bounded sample of the labelled rows outside the held-out fold.

    Per class about SAMPLE_DOCS documents by a hash of the id. Each part of them is measured by dictionaries of
    the other parts, which calibrates what dictionaries say about texts they have not seen; all make the final ones.
    """
    known = labels.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{label}`").cast("int").alias("label"))
    known = known.where(F.col("label").isin(0, 1) & (fold_of("doc_id", folds) != held)).distinct()
    counts = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    spread = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
    share = F.lit(0.0)
    for value, count in counts.items():
        share = F.when(F.col("label") == value, min(1.0, SAMPLE_DOCS / count)).otherwise(share)
    chosen = known.withColumn("spread", spread).where(F.col("spread") < share * (1 << 30))  # about 2 * SAMPLE_DOCS rows
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.substring(text_of(text), 1, SAMPLE_DOC_BYTES).alias("text"))
    sample = sorted((r.label, r.spread, r.doc_id, r.text.encode()) for r in rows.join(F.broadcast(chosen), "doc_id").collect())
    classes = {v: [t for k, _, _, t in sample if k == v] for v in (0, 1)}
    if not classes[0] or not classes[1]:
        only = 0.5 if not sample else float(sample[0][0])
        return Model(b"", b"", (0.0, 0.0, float(np.log((only + 0.01) / (1.01 - only)))))
    x, y = [], []
    for part in range(PARTS):
        rest = {v: [t for i, t in enumerate(classes[v]) if i % PARTS != part] or classes[v] for v in (0, 1)}
        of = measure(*_dictionaries(rest))
        for v in (0, 1):
            own = classes[v][part::PARTS]
            x += [features(of(t), len(t)) for t in own]
            y += [v] * len(own)
    weights = fit_logistic(np.array(x), np.array(y, float))
    # The sample has the classes in other proportions than the labels; the offset takes the true odds back.
    weights[-1] += np.log((counts[1] / counts[0]) / (y.count(1) / y.count(0)))
    return Model(*_dictionaries(classes), tuple(map(float, weights)))


def score_quality(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality",
    folds: int = 4, held: int = 2, threshold: float = 0.7,
) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted. Text alone decides.

    Null and empty texts get the score of a shortest text that both dictionaries serve alike. With labels of one class
    only, or none, every text has the same score. Repeated rows give repeated rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(learn(docs, labels, doc_id, text, label, folds, held))

    def make():
        model = shared.value
        of = measure(model.good, model.bad)

        def run(texts):
            x = np.array([features(of(raw), len(raw)) for raw in map(str.encode, texts)])
            return [pa.array(1 / (1 + np.exp(-np.clip(x @ np.array(model.weights), -30, 30))), pa.float64())]

        return run

    found = row_wise(docs, [doc_id], text, "score double", make)
    return found.select(
        F.col(f"`{doc_id}`").alias("doc_id"), F.coalesce(fold_of(doc_id, folds) == held, F.lit(False)).alias("held_out"),
        "score", (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
