"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features are the presence of words, word pairs and pairs with one word between them. Per-coordinate
rates learn rare words fast; the L1 term leaves most weights at exactly 0, so what goes to the
executors is a short list of cells and weights.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, held_out, read_table, workers_see_package
from .labelled import SAMPLE_BYTES, class_counts, collected, platt, sampled, sigmoid, training_labels
from .textvec import U, Words, lower_latin, mix, text_slices

CELL_BITS = 20
#: Bound of the fit: about this many labelled rows of either class.
SAMPLE_PER_CLASS = 6_000
#: Bytes between words besides white space: ASCII punctuation.
_PUNCTUATION = np.array([33 <= b < 127 and not chr(b).isalnum() for b in range(256)])


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text row, cell) of every word, pair and skip pair, repeats included."""
    words = Words(lower_latin(data), offsets, drop=_PUNCTUATION)
    rows, cells = [words.doc], [words.hash]
    for gap, salt in ((1, 0x51ED270B0B0B0B0B), (2, 0x2545F4914F6CDD1D)):
        if len(words.hash) > gap:
            same = words.doc[:-gap] == words.doc[gap:]
            cells.append(mix(words.hash[:-gap][same] * U(salt) + words.hash[gap:][same]))
            rows.append(words.doc[:-gap][same])
    return np.concatenate(rows), (np.concatenate(cells) >> U(64 - CELL_BITS)).astype(np.int64)


@dataclass
class ToxicModel:
    cells: np.ndarray
    weights: np.ndarray
    bias: float
    slope: float
    offset: float

    def margins(self, data: np.ndarray, offsets: np.ndarray, dense: np.ndarray) -> np.ndarray:
        row, cell = features(data, offsets)
        live = dense[cell] != 0
        # Only cells with a weight are made distinct: few, thanks to the L1 term.
        key = np.unique(row[live] << CELL_BITS | cell[live])
        return self.bias + np.bincount(key >> CELL_BITS, dense[key & (1 << CELL_BITS) - 1], len(offsets) - 1)

    def dense(self) -> np.ndarray:
        out = np.zeros(1 << CELL_BITS)
        out[self.cells] = self.weights
        return out


def ftrl(x: list[np.ndarray], y: np.ndarray, epochs: int = 8, alpha: float = 1.0, beta: float = 1.0, l1: float = 6.0, l2: float = 0.01) -> tuple[np.ndarray, float]:
    """Weights and bias from one example at a time, in the given order; the bias is a coordinate without L1."""
    z, n = np.zeros((1 << CELL_BITS) + 1), np.zeros((1 << CELL_BITS) + 1)
    last = 1 << CELL_BITS

    def weight(at: np.ndarray) -> np.ndarray:
        za = z[at]
        w = -(za - np.sign(za) * l1) / ((beta + np.sqrt(n[at])) / alpha + l2)
        w[np.abs(za) <= l1] = 0
        w[at == last] = -z[last] / ((beta + np.sqrt(n[last])) / alpha)
        return w

    for _ in range(epochs):
        for own, label in zip(x, y, strict=True):
            at = np.append(own, last)
            w = weight(at)
            g = 1 / (1 + np.exp(-np.clip(w.sum(), -30, 30))) - label
            root = np.sqrt(n[at])
            n[at] += g * g
            z[at] += g - (np.sqrt(n[at]) - root) / alpha * w
    w = weight(np.arange(last + 1))
    return w[:last], float(w[last])


def fit(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> ToxicModel:
    """Fit on docs (doc_id, text) with labels (doc_id, label 0 or 1), on about per_class rows of either label,
    SAMPLE_BYTES of features at most.

    The sample balances the classes; calibration weighs them back to the counts of all labels. Without
    rows of both labels every score is the share of label 1 (0 without labels).
    """
    counts = class_counts(labels)
    if not min(counts):
        share = counts[1] / max(1, sum(counts))
        return ToxicModel(np.zeros(0, np.int64), np.zeros(0), 0.0, 1.0, float(np.log((share + 1e-6) / (1 - share + 1e-6))))

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, offsets in text_slices(batches):
            row, cell = features(data, offsets)
            key = np.unique(row << CELL_BITS | cell)
            bounds = np.searchsorted(key, np.arange(part.num_rows + 1) << CELL_BITS)
            own = (key & (1 << CELL_BITS) - 1).astype(np.int32)
            packed = [own[a:b].tobytes() for a, b in zip(bounds, bounds[1:], strict=False)]
            yield pa.RecordBatch.from_arrays([part.column("place"), part.column("label"), pa.array(packed, pa.binary())], ["place", "label", "x"])

    some = sampled(docs, labels, counts, per_class, "toxic").select("place", "label", "text").mapInArrow(cells, "place long, label int, x binary")
    taken = collected(Scratch(docs.sparkSession, "toxic").table(some, "sample"), 4 * per_class, SAMPLE_BYTES)
    y = taken["label"].to_numpy().astype(float)
    x = [np.frombuffer(b.as_buffer(), np.int32) for b in taken["x"]]
    order = np.random.default_rng(5).permutation(len(x))
    fit_on, test_on = order[len(order) // 5 :], order[: len(order) // 5]
    prior = np.where(y == 1, counts[1] / max(1, (y == 1).sum()), counts[0] / max(1, (y == 0).sum()))
    w, bias = ftrl([x[k] for k in fit_on], y[fit_on])
    margin = np.array([w[x[k]].sum() + bias for k in test_on])
    slope, offset = platt(margin, y[test_on], prior[test_on]) if len(test_on) > 20 else (1.0, 0.0)
    at = np.flatnonzero(w)
    return ToxicModel(at, w[at], bias, slope, offset)


def score(docs: DataFrame, model: ToxicModel) -> DataFrame:
    """Toxicity of every text: doc_id, score (0 to 1).

    docs: doc_id, text; other columns are ignored. Null and empty texts have no feature and get the score of
    the bias alone. Equal texts get equal scores. No rows: no rows out. Memory follows the longest text.
    """
    workers_see_package(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dense = model.dense()
        for part, data, offsets in text_slices(batches):
            p = sigmoid(model.slope * model.margins(data, offsets, dense) + model.offset)
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(np.round(p, 9))], ["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, score double")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    workers_see_package(spark)
    docs = read_table(spark, sf_dir, "documents")
    model = fit(docs, training_labels(read_table(spark, sf_dir, "labels"), "toxic"))
    return score(docs, model).select("doc_id", held_out(F.col("doc_id"), 5, 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
