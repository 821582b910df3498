"""Extraction cache: the tables of every document, kept by run, so that a run reads changed documents only.

A run writes the tables of the documents that are new or changed to ``tables/run=N`` and then, as the last step,
which documents those were to ``documents/run=N``. A run that breaks off before that has no effect, and the
next one takes its number and overwrites what it left. Of a document's runs the latest counts; nothing that an
earlier run holds for other documents is touched.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import documents, hadoop

MANIFEST = "uri string, doc_name string, size long, modified timestamp, ticker string, year int, scope string"


class TableCache:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def runs(self) -> list[int]:
        return hadoop.numbered(self.spark, f"{self.root}/documents")

    def _read(self, kind: str, runs: list[int]) -> DataFrame:
        return self.spark.read.option("basePath", f"{self.root}/{kind}").parquet(*[f"{self.root}/{kind}/run={n}" for n in runs])

    def known(self) -> DataFrame:
        """Documents with the run that holds them: doc_name, size, modified, run."""
        runs = self.runs()
        if not runs:
            return self.spark.createDataFrame([], "doc_name string, size long, modified timestamp, run int")
        newest = self._read("documents", runs).groupBy("doc_name").agg(F.max_by(F.struct("size", "modified", "run"), "run").alias("d"))
        return newest.select("doc_name", "d.size", "d.modified", "d.run")

    def update(self, listed: DataFrame, extract: Callable[[DataFrame], DataFrame], root: str, rebuild: bool = False) -> int | None:
        """Extract the listed documents that aren't known as they are; the number of the run, None if nothing was to do."""
        runs = self.runs()
        fresh = listed if rebuild else documents.changed_documents(listed, self.known())
        number = max(runs, default=0) + 1
        # What is read is fixed first: a file that changes meanwhile is new to the next run.
        pending = f"{self.root}/pending"
        fresh.select("uri", "doc_name", "size", "modified", "ticker", "year", "scope").write.mode("overwrite").parquet(pending)
        chosen = self.spark.read.schema(MANIFEST).parquet(pending)
        if runs and not chosen.limit(1).count():
            return None
        texts = documents.read_texts(self.spark, root, chosen)
        extract(texts).drop("uri", "size", "modified").write.mode("overwrite").parquet(f"{self.root}/tables/run={number}")
        chosen.write.mode("overwrite").parquet(f"{self.root}/documents/run={number}")
        return number

    def tables(self, listed: DataFrame | None = None) -> DataFrame:
        """Tables of every document's latest run; with listed only of documents that are still there."""
        current = self.known().select("doc_name", "run")
        if listed is not None:
            current = current.join(listed.select("doc_name"), "doc_name", "left_semi")
        return self._read("tables", self.runs()).join(current, ["doc_name", "run"], "left_semi").drop("run")
