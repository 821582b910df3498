"""The corpus pipeline: stages over documents, each of which calls one operator of gridquill.llm."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridquill.llm import decontam, langid, mixing, neardup, sharding
from gridquill.llm.common import Scratch, read_table

SHARDS = 40
#: Similarity in hundredths from which documents are near-duplicates here.
SIMILARITY = 80


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised, with the predicted language in lang; rejected ones go."""
    # Other columns travel as one, so that none clashes with what the operator returns.
    row = docs.select(F.struct(*[c for c in docs.columns if c != "text"]).alias("_row"), "text")
    found = langid.identify(row, langid.fit(docs), ("_row",), keep_text=True).where(~F.col("rejected"))
    new = {"text": F.col("text"), "lang": F.col("lang_pred").alias("lang")}
    return found.select(*[new.get(c, F.col(f"_row.{c}")) for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near-duplicates."""
    return neardup.deduplicate(docs, Scratch(spark, "near"), SIMILARITY).select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark items."""
    return decontam.decontaminate(docs, read_table(spark, sf_dir, "benchmark"), Scratch(spark, "decontam")).select(*docs.columns)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it: some not at all, some up to three times."""
    return mixing.repeat(docs, Scratch(spark, "mix")).select(*docs.columns)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and slot of every row of the mix."""
    return sharding.interleave(docs, SHARDS, Scratch(spark, "shards")).select("doc_id", "size", "text_crc32", "shard", "slot")


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixture", mixture),
    ("shards", shards),
]

#: Language vectors and sketches have no counterpart in SQL; a plain Python version is in the tests.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in turn; what one keeps is written as Parquet and read again by the next."""
    docs, scratch = read_table(spark, sf_dir, "documents"), Scratch(spark, "pipeline")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = scratch.table(docs, name)
    return docs
