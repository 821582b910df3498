"""Text quality by Naive Bayes support vectors.

N-gram indicators (words, word pairs, and one to three token shapes in a row, a shape being what a
token looks like and whether it repeats the one before) are scaled by the log ratio of their smoothed
class frequencies; a linear hinge-loss model on the scaled indicators is fitted by dual coordinate
descent, and a logistic curve on held-back margins makes its margin a probability.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, held_out, read_table, workers_see_package
from .labelled import SAMPLE_BYTES, class_counts, collected, platt, sampled, sigmoid, training_labels, with_label
from .textvec import LOWER, U, Words, mix, text_slices

CELL_BITS = 17
#: Bound of the hinge-loss fit: about this many labelled rows of either class.
SAMPLE_PER_CLASS = 4_000

_KIND = np.zeros(256, np.uint8)
for _b in range(256):
    _c = chr(_b)
    _KIND[_b] = 1 if "a" <= _c <= "z" else 2 if "A" <= _c <= "Z" else 3 if "0" <= _c <= "9" else 4 if _b >= 128 else 5 + _b % 26


def shapes(words: Words, data: np.ndarray) -> np.ndarray:
    """A number for what each token looks like: kinds of its first, second and last byte, its length, repetition."""
    end = words.start + words.length - 1
    second = np.minimum(words.start + 1, end)
    size = np.searchsorted([2, 4, 8, 16, 32], words.length, "right")
    again = np.zeros(len(words.hash), bool)
    again[1:] = (words.hash[1:] == words.hash[:-1]) & (words.doc[1:] == words.doc[:-1])
    k = lambda at: _KIND[data[at]].astype(np.int64)
    return (((k(words.start) * 32 + k(second)) * 32 + k(end)) * 8 + size) * 2 + again


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sorted distinct keys: text row << CELL_BITS | cell."""
    words = Words(data, offsets, LOWER)
    shape = mix(shapes(words, data).astype(U) + U(77))
    n, rows, cells = len(words.hash), [words.doc, words.doc], [words.hash, shape]
    for gap in (1, 2):
        if n > gap:
            same = words.doc[:-gap] == words.doc[gap:]
            run = shape[:-gap] * U(0x9E3779B97F4A7C15) + shape[gap:]
            if gap == 2:
                run = run * U(0xC2B2AE3D27D4EB4F) + shape[1:-1]
            else:
                cells.append(mix(words.hash[:-1][same] * U(0x51ED270B0B0B0B0B) + words.hash[1:][same]))
                rows.append(words.doc[:-1][same])
            cells.append(mix(run[same]))
            rows.append(words.doc[:-gap][same])
    cell = (np.concatenate(cells) >> U(64 - CELL_BITS)).astype(np.int64)
    return np.unique(np.concatenate(rows) << CELL_BITS | cell)


@dataclass
class QualityModel:
    weights: np.ndarray  # by cell, ratios multiplied in
    ratio: np.ndarray
    bias: float
    slope: float
    offset: float

    def probability(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        key = features(data, offsets)
        row, cell, n = key >> CELL_BITS, key & (1 << CELL_BITS) - 1, len(offsets) - 1
        length = np.sqrt(np.bincount(row, self.ratio[cell] ** 2, n))
        margin = np.bincount(row, self.weights[cell], n) / np.maximum(length, 1e-9) + self.bias
        return sigmoid(self.slope * margin + self.offset)


def dual_coordinate_descent(x: list[np.ndarray], y: np.ndarray, ratio: np.ndarray, cost: np.ndarray, epochs: int = 8, seed: int = 3) -> tuple[np.ndarray, float]:
    """L2-regularised hinge loss, one dual variable at a time; y is -1 or 1, cost bounds a row's dual variable.

    Rows are scaled to unit length, the bias is a constant feature of 1. Returns weights before the ratio.
    """
    w, bias, dual = np.zeros(len(ratio)), 0.0, np.zeros(len(x))
    value = [ratio[c] / max(1e-9, float(np.linalg.norm(ratio[c]))) for c in x]
    square = np.array([float(v @ v) + 1.0 for v in value])
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        moved = 0.0
        for k in rng.permutation(len(x)):
            slack = y[k] * (w[x[k]] @ value[k] + bias) - 1
            new = min(max(dual[k] - slack / square[k], 0.0), cost[k])
            if (step := new - dual[k]) != 0.0:
                w[x[k]] += step * y[k] * value[k]
                bias += step * y[k]
                dual[k] = new
                moved = max(moved, abs(step))
        if moved < 1e-4:
            break
    return w, bias


def log_ratio(n: np.ndarray, counts: tuple[int, int]) -> np.ndarray:
    """Log ratio of the smoothed shares of label-1 and label-0 rows that have a cell; n (2 x cells) has 1 added."""
    return np.log(n[1] / (counts[1] + 2)) - np.log(n[0] / (counts[0] + 2))


def left_out_margin(w: np.ndarray, bias: float, n: np.ndarray, counts: tuple[int, int], cells: np.ndarray, label: int) -> float:
    """Margin of a row by the ratios that counts without this row give."""
    less = n[:, cells].copy()
    less[label] = np.maximum(less[label] - 1, 1)
    ratio = log_ratio(less, tuple(c - (k == label) for k, c in enumerate(counts)))
    return float((w[cells] * ratio).sum() / max(1e-9, np.linalg.norm(ratio)) + bias)


def fit(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> QualityModel:
    """Fit on docs (doc_id, text) with labels (doc_id, label 0 or 1).

    Log-count ratios cover all labelled rows; the hinge-loss fit takes about per_class rows of either label,
    picked by a hash of the id, SAMPLE_BYTES of indicators at most, and the calibration weighs them back to the
    counts of all labels. Without rows of both labels every score is the share of label 1 (0 without labels).
    """
    counts = class_counts(labels)
    if not min(counts):
        share = counts[1] / max(1, sum(counts))
        return QualityModel(np.zeros(1 << CELL_BITS), np.zeros(1 << CELL_BITS), 0.0, 1.0, float(np.log((share + 1e-6) / (1 - share + 1e-6))))

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros((2, 1 << CELL_BITS), np.int64)
        for part, data, offsets in text_slices(batches):
            key = features(data, offsets)
            label = part.column("label").to_numpy()[key >> CELL_BITS]
            for k in (0, 1):
                seen[k] += np.bincount(key[label == k] & (1 << CELL_BITS) - 1, minlength=1 << CELL_BITS)
        at = np.flatnonzero(seen.any(0))
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(seen[0][at]), pa.array(seen[1][at])], ["cell", "n0", "n1"])

    rows = with_label(docs, labels.where("label in (0, 1)")).select("label", "text")
    found = rows.mapInArrow(frequencies, "cell int, n0 long, n1 long").groupBy("cell").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).toArrow()
    n = np.ones((2, 1 << CELL_BITS))
    for k in (0, 1):
        n[k][found["cell"].to_numpy()] += found[f"n{k}"].to_numpy()
    ratio = log_ratio(n, counts)

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, offsets in text_slices(batches):
            key = features(data, offsets)
            bounds = np.searchsorted(key, np.arange(part.num_rows + 1) << CELL_BITS)
            own = (key & (1 << CELL_BITS) - 1).astype(np.int32)
            packed = [own[a:b].tobytes() for a, b in zip(bounds, bounds[1:], strict=False)]
            yield pa.RecordBatch.from_arrays([part.column("place"), part.column("label"), pa.array(packed, pa.binary())], ["place", "label", "x"])

    some = sampled(docs, labels, counts, per_class, "quality").select("place", "label", "text").mapInArrow(cells, "place long, label int, x binary")
    taken = collected(Scratch(docs.sparkSession, "quality").table(some, "sample"), 4 * per_class, SAMPLE_BYTES)
    label = taken["label"].to_numpy()
    x = [np.frombuffer(b.as_buffer(), np.int32) for b in taken["x"]]
    order = np.random.default_rng(5).permutation(len(x))
    test_on, fit_on = order[: len(x) // 5], order[len(x) // 5 :]
    prior = np.where(label == 1, counts[1] / max(1, (label == 1).sum()), counts[0] / max(1, (label == 0).sum()))
    w, bias = dual_coordinate_descent([x[k] for k in fit_on], np.where(label[fit_on] == 1, 1.0, -1.0), ratio, np.ones(len(fit_on)))
    weights = w * ratio
    # The ratios have seen the rows held back for the calibration, too: each is judged by ratios without its own counts.
    margin = np.array([left_out_margin(w, bias, n, counts, x[k], int(label[k])) for k in test_on])
    slope, offset = platt(margin, label[test_on].astype(float), prior[test_on]) if len(test_on) > 20 else (1.0, 0.0)
    return QualityModel(weights, ratio, bias, slope, offset)


def score(docs: DataFrame, model: QualityModel) -> DataFrame:
    """Probability of label 1 for every text: doc_id, score (0 to 1).

    docs: doc_id, text; other columns are ignored. Null and empty texts have no indicator and get the score of
    the bias alone. Equal texts get equal scores. No rows: no rows out. Memory follows the longest text.
    """
    workers_see_package(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, offsets in text_slices(batches):
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(np.round(model.probability(data, offsets), 9))], ["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, score double")


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    workers_see_package(spark)
    docs = read_table(spark, sf_dir, "documents")
    model = fit(docs, training_labels(read_table(spark, sf_dir, "labels"), "quality"))
    return score(docs, model).select("doc_id", held_out(F.col("doc_id"), 5, 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))
