"""Language identification by nearest centroid over TF-IDF n-gram vectors.

A text is a unit vector of hashed byte trigrams, weighted sqrt(tf) * idf. Every language has several
centroids (spherical k-means); the language of the nearest one by cosine is the prediction. A text
too far from all of them for its length is rejected.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import hash60, held_out, read_table, workers_see_package
from .textvec import U, lower_latin, mix, text_slices

DIM = 4096
#: Bounds of the fit: sampled rows for each language, and centroids for each language.
SAMPLE_PER_LANGUAGE, CENTROIDS = 1_000, 3
#: Languages that one pass over the texts compares with; more take more passes.
LANGUAGES_AT_ONCE = 400
#: A text is rejected if its cosine is below this share of the lowest hundredth of sampled texts of like length.
#: Languages left out of the fit lie mostly between a third and half of it, learned ones above two thirds.
REJECT_SHARE = 0.5
LENGTH_STEPS = (64, 256, 1024)
UNKNOWN = "und"

#: Upper case goes to lower case, every other ASCII byte that is no letter to a space.
_FOLD = np.array([b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256)], np.uint8)


def trigram_counts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Texts x DIM matrix of trigram counts; runs of spaces count as one, texts start and end with one."""
    n = len(offsets) - 1
    folded = _FOLD[lower_latin(data)]
    # One space before every text keeps trigrams from crossing texts.
    spaced = np.insert(folded, offsets[:-1], 32)
    row = np.repeat(np.arange(n), np.diff(offsets) + 1)
    keep = np.ones(len(spaced), bool)
    keep[1:] = (spaced[1:] != 32) | (spaced[:-1] != 32) | (row[1:] != row[:-1])
    spaced, row = spaced[keep], row[keep]
    if len(spaced) < 3:
        return np.zeros((n, DIM), np.float32)
    value = spaced[:-2].astype(U) | spaced[1:-1].astype(U) << U(8) | spaced[2:].astype(U) << U(16)
    inside = row[:-2] == row[2:]
    cell = row[:-2][inside] * DIM + (mix(value[inside]) % U(DIM)).astype(np.int64)
    return np.bincount(cell, minlength=n * DIM).reshape(n, DIM).astype(np.float32)


def unit_vectors(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = np.sqrt(counts) * idf
    return x / np.maximum(np.sqrt((x * x).sum(1, keepdims=True)), 1e-9)


def has_letter(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    letter = (_FOLD[data] != 32) & (data < 128)
    total = np.concatenate([[0], np.cumsum(letter)])
    found = total[offsets[1:]] > total[offsets[:-1]]
    for row in np.flatnonzero(~found):
        found[row] = any(map(str.isalpha, data[offsets[row] : offsets[row + 1]].tobytes().decode("utf-8", "replace")))
    return found


@dataclass
class LanguageModel:
    languages: list[str]
    idf: np.ndarray
    centroids: np.ndarray  # rows
    owner: np.ndarray  # language of each row
    floors: np.ndarray  # lowest accepted cosine by length step

    def blocks(self) -> list["LanguageModel"]:
        """The model cut into parts of LANGUAGES_AT_ONCE languages, in order."""
        cuts = range(0, max(1, len(self.languages)), LANGUAGES_AT_ONCE)
        parts = [np.flatnonzero((self.owner >= a) & (self.owner < a + LANGUAGES_AT_ONCE)) for a in cuts]
        return [LanguageModel(self.languages[a : a + LANGUAGES_AT_ONCE], self.idf, self.centroids[p], self.owner[p] - a, self.floors) for a, p in zip(cuts, parts, strict=True)]

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(language index, its cosine, the best cosine of the other languages) of every vector."""
        near = vectors @ self.centroids.T
        by = np.stack([near[:, self.owner == k].max(1) for k in range(len(self.languages))], 1)
        best = by.argmax(1)
        top = by[np.arange(len(by)), best]
        rest = by.copy()
        rest[np.arange(len(by)), best] = 0
        return best, top, rest.max(1)


def spherical_kmeans(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Deterministic: starts at the mean's nearest row, then at rows farthest from those chosen."""
    chosen = [int((x @ x.mean(0)).argmax())]
    while len(chosen) < min(k, len(x)):
        chosen.append(int((x @ x[chosen].T).max(1).argmin()))
    c = x[chosen]
    for _ in range(rounds):
        own = (x @ c.T).argmax(1)
        sums = np.stack([x[own == j].sum(0) if (own == j).any() else c[j] for j in range(len(c))])
        c = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-9)
    return c


def fit(rows: DataFrame, sample_per_language: int = SAMPLE_PER_LANGUAGE, centroids: int = CENTROIDS) -> LanguageModel:
    """Fit on rows (doc_id, text, lang) with a lang and a letter; others don't count anywhere.

    Document frequencies and language counts cover all rows. Centroids are fitted on a sample of about
    sample_per_language rows of each language, in a task of its own; a row that stands there several times counts
    once in the sample. The driver gets document frequencies, and of each language its count, its centroids and the
    cosines of its sample.
    """
    rows = rows.select("doc_id", "text", "lang").where(F.col("lang").isNotNull())

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, langs = np.zeros(DIM, np.int64), {}
        for part, data, offsets in text_slices(batches, rows=512):
            letters = has_letter(data, offsets)
            df += (trigram_counts(data, offsets)[letters] > 0).sum(0)
            for lang in part.column("lang").filter(pa.array(letters)).to_pylist():
                langs[lang] = langs.get(lang, 0) + 1
        at = np.flatnonzero(df)
        keys = [""] * len(at) + ["l" + k for k in langs]
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array([*at, *[-1] * len(langs)], pa.int32()), pa.array([*df[at], *langs.values()], pa.int64())], ["key", "cell", "n"])

    counts = rows.mapInArrow(frequencies, "key string, cell int, n long").groupBy("key", "cell").agg(F.sum("n").alias("n")).collect()
    by_language = {r.key[1:]: r.n for r in counts if r.cell < 0}
    df = np.zeros(DIM)
    for r in counts:
        if r.cell >= 0:
            df[r.cell] = r.n
    idf = np.log((1 + sum(by_language.values())) / (1 + df)).astype(np.float32) + 1
    languages = sorted(by_language)
    if not languages:
        return LanguageModel([], idf, np.zeros((0, DIM), np.float32), np.zeros(0, int), np.zeros(len(LENGTH_STEPS) + 1))
    spark = rows.sparkSession
    rates = F.broadcast(spark.createDataFrame([(n, sample_per_language / by_language[n]) for n in languages], "lang string, rate double"))
    placed = rows.withColumn("place", hash60(F.lit("lang"), F.col("doc_id"), F.xxhash64("text"))).join(rates, "lang").where(F.col("place") < F.col("rate") * float(1 << 60))
    chosen = placed.groupBy("lang", "place").agg(F.first("text").alias("text"))

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, offsets in text_slices(batches, rows=256):
            x, letters = trigram_counts(data, offsets), has_letter(data, offsets)
            packed = [v.tobytes() for v in unit_vectors(x, idf).astype(np.float16)[letters]]
            own = part.filter(pa.array(letters))
            yield pa.RecordBatch.from_arrays([own.column("lang"), own.column("place"), pa.array(x.sum(1)[letters], pa.float32()), pa.array(packed, pa.binary())], ["lang", "place", "n", "x"])

    sample = chosen.mapInArrow(vectors, "lang string, place long, n float, x binary")
    # A rank bounds what one task gets, even if a sample turns out large.
    bounded = sample.withColumn("k", F.row_number().over(W.partitionBy("lang").orderBy("place"))).where(F.col("k") <= 2 * sample_per_language).drop("k")

    def centre(table: pa.Table) -> pa.Table:
        table = table.sort_by("place")
        x = np.frombuffer(b"".join(table["x"].to_pylist()), np.float16).reshape(-1, DIM).astype(np.float32)
        c = spherical_kmeans(x, centroids)
        cosine = (x @ c.T).max(1).astype(np.float32)
        return pa.table([table["lang"][:1], pa.array([c.astype(np.float32).tobytes()], pa.binary()), pa.array([table["n"].to_numpy().astype(np.float32).tobytes()], pa.binary()), pa.array([cosine.tobytes()], pa.binary())], ["lang", "centroids", "n", "cosine"])

    found = {r.lang: r for r in bounded.groupBy("lang").applyInArrow(centre, "lang string, centroids binary, n binary, cosine binary").collect()}
    rows_of = [np.frombuffer(found[n].centroids, np.float32).reshape(-1, DIM) if n in found else np.zeros((1, DIM), np.float32) for n in languages]
    owner = np.repeat(np.arange(len(languages)), [len(c) for c in rows_of])
    length, cosine = (np.concatenate([np.frombuffer(found[n][f], np.float32) for n in languages if n in found] or [np.zeros(0, np.float32)]) for f in ("n", "cosine"))
    step = np.searchsorted(LENGTH_STEPS, length, "right")
    low = float(cosine.min()) if len(cosine) else 0.0
    floors = np.array([np.quantile(cosine[step == s], 0.01) if (step == s).sum() >= 20 else low for s in range(len(LENGTH_STEPS) + 1)])
    return LanguageModel(languages, idf, np.concatenate(rows_of).astype(np.float32), owner, REJECT_SHARE * np.minimum.accumulate(floors[::-1])[::-1])


def identify(docs: DataFrame, model: LanguageModel, columns: tuple[str, ...] = ("doc_id",), keep_text: bool = False) -> DataFrame:
    """Predicted language of every text.

    docs: text and the named columns; others are ignored. A null text, an empty one and one without a letter
    is ``und`` with score 0 and counts as rejected, as does every text if the model knows no language.
    Ties go to the first language by name; equal texts get equal results. No rows: no rows out.

    Returns the named columns, the text if asked for, lang_pred, score (0 to 1), cosine, rejected.
    """
    workers_see_package(docs.sparkSession)
    kept = docs.select(*columns, "text")
    passed = (*columns, "text") if keep_text else columns
    shape = lambda names: ", ".join(f"`{c}` {kept.schema[c].dataType.simpleString()}" for c in names)
    state = "_lang string, _top float, _rest float"
    parts = model.blocks()
    for k, part in enumerate(parts):
        last = k == len(parts) - 1
        done = "lang_pred string, score double, cosine double, rejected boolean"
        kept = kept.mapInArrow(_compared(part, columns, passed, k == 0, last), f"{shape(passed)}, {done}" if last else f"{shape((*columns, 'text'))}, {state}")
    return kept


def _compared(part: LanguageModel, columns: tuple[str, ...], passed: tuple[str, ...], first: bool, last: bool):
    """Compare texts with the languages of a part: the best one so far, its cosine and the next best cosine travel along."""
    names = np.array([*part.languages, UNKNOWN], object)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in text_slices(batches, rows=512):
            n = rows.num_rows
            counts = trigram_counts(data, offsets)
            best, top, rest = part.nearest(unit_vectors(counts, part.idf)) if part.languages else (np.full(n, -1), np.zeros(n), np.zeros(n))
            named = names[best]
            if not first:
                old, old_top, old_rest = (rows.column(c).to_numpy(zero_copy_only=False) for c in ("_lang", "_top", "_rest"))
                better = top > old_top
                named, top, rest = np.where(better, named, old), np.maximum(top, old_top), np.where(better, np.maximum(rest, old_top), np.maximum(old_rest, top))
            if not last:
                yield pa.RecordBatch.from_arrays([*rows.columns[: len(columns) + 1], pa.array(named, pa.string()), pa.array(top, pa.float32()), pa.array(rest, pa.float32())], [*columns, "text", "_lang", "_top", "_rest"])
                continue
            letters = has_letter(data, offsets) & bool(part.languages)
            score = np.where(letters, np.clip(top / np.maximum(top + rest, 1e-9), 0, 1), 0.0)
            rejected = ~letters | (top < part.floors[np.searchsorted(LENGTH_STEPS, counts.sum(1), "right")])
            found = [pa.array(np.where(letters, named, UNKNOWN), pa.string()), pa.array(score.astype(float)), pa.array(top.astype(float)), pa.array(rejected)]
            yield pa.RecordBatch.from_arrays([*rows.columns[: len(passed)], *found], [*passed, "lang_pred", "score", "cosine", "rejected"])

    return run


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    workers_see_package(spark)
    docs = read_table(spark, sf_dir, "documents")
    test = held_out(F.col("doc_id"), 4, 2)
    model = fit(docs.where(~test))
    return identify(docs, model).select("doc_id", held_out(F.col("doc_id"), 4, 2).alias("held_out"), "lang_pred", F.round("score", 9).alias("score"), "rejected")
