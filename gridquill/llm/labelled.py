"""Labelled rows for the two text classifiers: one label by document, bounded samples, calibration."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import hash60, held_out, small

#: Labels of more bytes than this are joined by a shuffle, not broadcast.
BROADCAST_LABELS = 32 << 20
#: Bytes of features that a fit takes to the driver at most.
SAMPLE_BYTES = 256 << 20


def training_labels(labels: DataFrame, column: str, buckets: int = 5, bucket: int = 0) -> DataFrame:
    """(doc_id, label) of the rows to learn from; a document with several labels has its largest, null labels go."""
    rows = labels.select("doc_id", F.col(column).cast("int").alias("label")).where("doc_id is not null and label is not null")
    return rows.where(~held_out(F.col("doc_id"), buckets, bucket)).groupBy("doc_id").agg(F.max("label").alias("label"))


def class_counts(labels: DataFrame) -> tuple[int, int]:
    found = {r.label: r.n for r in labels.where("label in (0, 1)").groupBy("label").agg(F.count("*").alias("n")).collect()}
    return found.get(0, 0), found.get(1, 0)


def order_key(seed: str) -> Column:
    """A row's place in the seeded order of its id and text: the same wherever the row is."""
    return hash60(F.lit(seed), F.col("doc_id"), F.xxhash64("text"))


def sampled(docs: DataFrame, labels: DataFrame, counts: tuple[int, int], per_class: int, seed: str) -> DataFrame:
    """Labelled documents (doc_id, label, text, place): about per_class rows of either label, picked by a hash of the id.

    A document that stands there several times with one text counts once.
    """
    rate = F.when(F.col("label") == 1, per_class / max(1, counts[1])).otherwise(per_class / max(1, counts[0]))
    picked = labels.where("label in (0, 1)").where(hash60(F.lit(seed), F.col("doc_id")) < rate * float(1 << 60))
    rows = with_label(docs, picked).withColumn("place", order_key(seed))
    return rows.groupBy("doc_id", "label", "place").agg(F.first("text").alias("text"))


def collected(rows: DataFrame, most_rows: int, most_bytes: int) -> pa.Table:
    """The first rows (place, x binary, others) in order of place, at most most_rows and most_bytes of x, on the driver.

    Places are a hash, so the first rows are a sample, the same in every run. Only they reach the driver: where the
    bounds end is found from places and sizes.
    """
    first = rows.select("place", F.octet_length("x").alias("size")).orderBy("place", "size").limit(most_rows)
    upto = first.withColumn("upto", F.sum("size").over(W.orderBy("place", "size").rowsBetween(W.unboundedPreceding, 0)))
    last = upto.where(F.col("upto") <= most_bytes).agg(F.max(F.struct("place", "size"))).first()[0]
    if last is None:
        return rows.limit(0).toArrow()
    kept = rows.where(F.struct("place", F.octet_length("x").alias("size")) <= F.struct(F.lit(last["place"]), F.lit(last["size"])))
    return kept.orderBy("place").limit(most_rows).toArrow()


def with_label(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """docs (doc_id, text) with their label; labels are broadcast only where they are small."""
    return docs.select("doc_id", "text").join(small(labels, BROADCAST_LABELS), "doc_id")


def platt(margin: np.ndarray, label: np.ndarray, weight: np.ndarray, rounds: int = 50) -> tuple[float, float]:
    """(slope, offset) of a weighted logistic fit of label on margin, by damped Newton steps; slope stays positive."""
    a, b = 1.0, 0.0
    weight = weight / weight.sum()
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a * margin + b, -30, 30)))
        g = weight * (p - label)
        h = weight * np.maximum(p * (1 - p), 1e-9)
        grad = np.array([(g * margin).sum() + 1e-4 * (a - 1), g.sum()])
        hess = np.array([[(h * margin * margin).sum() + 1e-4, (h * margin).sum()], [(h * margin).sum(), h.sum() + 1e-6]])
        step = np.linalg.solve(hess, grad)
        step *= min(1.0, 2.0 / max(1e-9, np.abs(step).max()))
        a, b = max(1e-3, a - step[0]), b - step[1]
    return float(a), float(b)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))

