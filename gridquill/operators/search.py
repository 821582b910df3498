"""BM25 over an inverted index kept as a table of postings."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import let, tokenize
from ..sources import hadoop

K1, B = 1.5, 0.75
INDEX_FORMAT, TOKENIZER_FORMAT = 2, 1
#: Query tables of up to this many rows are sent to the postings; larger ones meet them in a shuffle.
BROADCAST_QUERY_TERMS = 500_000


@dataclass(frozen=True)
class Index:
    """postings (term, id, tf, dl), terms (term, df), documents (id), and the two scalars of the formula."""

    postings: DataFrame
    terms: DataFrame
    documents: DataFrame
    n: int
    avgdl: float
    tokenizer: str = "words"
    fingerprint: str = ""

    def manifest(self) -> dict:
        """What a stored index must agree in to be used again."""
        return {"index_format": INDEX_FORMAT, "tokenizer_format": TOKENIZER_FORMAT, "tokenizer": self.tokenizer, "fingerprint": self.fingerprint, "documents": self.n, "avgdl": self.avgdl}


def counted_terms(tokens: Column) -> Column:
    """ARRAY<STRUCT<term, tf>> of a row's tokens: sorted, equal ones are neighbours, and their runs are counted in place."""

    def runs(s: Column) -> Column:
        starts = F.array_compact(F.transform(s, lambda w, i: F.when((i == 0) | (w != F.get(s, i - 1)), i)))
        return let(starts, lambda p: F.transform(p, lambda i, k: F.struct(F.get(s, i).alias("term"), (F.coalesce(F.get(p, k + 1), F.size(s)) - i).alias("tf"))))

    return let(F.sort_array(tokens), runs)


def term_counts(docs: DataFrame, id_col: str, text_col: str, tokenizer: str = "words", mark: bool = False) -> DataFrame:
    """(id, dl, term, tf). All tokens of a row are in that row, so nothing is shuffled.

    With mark every document has one more row, of the empty term, so that documents can be counted by the same rows.
    """
    tokens = docs.select(F.col(id_col).alias("id"), tokenize(F.col(text_col), tokenizer).alias("t"))
    counted = counted_terms(F.col("t"))
    if mark:
        counted = F.concat(F.array(F.struct(F.lit("").alias("term"), F.lit(0).alias("tf"))), counted)
    return tokens.select("id", F.size("t").alias("dl"), F.inline(counted))


def term_frequencies(docs: DataFrame, text_col: str, tokenizer: str = "words") -> DataFrame:
    """(term, df, cf) over all documents; sums are made in each task before the one shuffle, by term."""
    counted = docs.select(F.inline(counted_terms(tokenize(F.col(text_col), tokenizer))))
    return counted.groupBy("term").agg(F.count("*").alias("df"), F.sum("tf").alias("cf"))


def build_index(docs: DataFrame, id_col: str = "table_ref", text_col: str = "index_text", tokenizer: str = "words", asked: DataFrame | None = None) -> Index:
    """Documents without tokens count in n and in the average length, as documents of length 0.

    asked (one text column) limits postings to the terms of those texts, for an index that answers only them:
    documents are read once then, and what is kept of them is cached. Without it postings are a plan;
    save_index makes them a table.
    """
    postings = term_counts(docs, id_col, text_col, tokenizer, mark=True)
    if asked is not None:
        terms = asked.select(F.explode(tokenize(F.col(asked.columns[0]), tokenizer)).alias("term")).distinct()
        terms = terms.unionByName(terms.sparkSession.range(1).select(F.lit("").alias("term")))
        small = terms.limit(BROADCAST_QUERY_TERMS + 1).count() <= BROADCAST_QUERY_TERMS
        postings = postings.join(F.broadcast(terms) if small else terms, "term", "left_semi").persist()
    every = postings.where("term = ''")
    sizes = every.agg(F.count("*").alias("n"), F.coalesce(F.avg("dl"), F.lit(0.0)).alias("avgdl")).first()
    postings = postings.where("term <> ''")
    return Index(postings, postings.groupBy("term").agg(F.count("*").alias("df")), every.select("id"), sizes["n"], sizes["avgdl"], tokenizer)


_MANIFEST = "index_format int, tokenizer_format int, tokenizer string, fingerprint string, documents long, avgdl double"


def fingerprint_of(docs: DataFrame, id_col: str = "table_ref", text_col: str = "index_text") -> str:
    """The same for the same documents in any order: their number, and sums of two hashes of id and text."""
    halves = [F.sum(F.pmod(F.xxhash64(F.lit(k), id_col, text_col), F.lit(1 << 31))) for k in (1, 2)]
    return "-".join(str(x or 0) for x in docs.agg(F.count("*"), *halves).first())


def save_index(index: Index, path: str) -> None:
    """Postings and terms as Parquet; postings are in ranges of terms, so a query term reads few files.

    The manifest is written last: an index without one isn't loaded.
    """
    spark = index.postings.sparkSession
    hadoop.delete(spark, f"{path}/manifest")
    index.postings.repartitionByRange("term").sortWithinPartitions("term").write.mode("overwrite").parquet(f"{path}/postings")
    spark.read.parquet(f"{path}/postings").groupBy("term").agg(F.count("*").alias("df")).write.mode("overwrite").parquet(f"{path}/terms")
    index.documents.write.mode("overwrite").parquet(f"{path}/documents")
    spark.createDataFrame([tuple(index.manifest().values())], _MANIFEST).write.mode("overwrite").json(f"{path}/manifest")


def load_index(spark, path: str, tokenizer: str = "words", fingerprint: str | None = None) -> Index | None:
    """A stored index, or None if there is none, or its manifest doesn't fit this code, tokenizer and fingerprint."""
    if not hadoop.exists(spark, f"{path}/manifest/_SUCCESS"):
        return None
    found = spark.read.schema(_MANIFEST).json(f"{path}/manifest").first()
    if found is None or (found["index_format"], found["tokenizer_format"], found["tokenizer"]) != (INDEX_FORMAT, TOKENIZER_FORMAT, tokenizer):
        return None
    if fingerprint is not None and found["fingerprint"] != fingerprint:
        return None
    read = spark.read.parquet
    return Index(read(f"{path}/postings"), read(f"{path}/terms"), read(f"{path}/documents"), found["documents"], found["avgdl"], tokenizer, found["fingerprint"])


def stored_index(docs: DataFrame, path: str, id_col: str = "table_ref", text_col: str = "index_text", tokenizer: str = "words", rebuild: bool = False) -> Index:
    """The index of these documents: the one at path if it was made of them, else a new one, put there."""
    spark, own = docs.sparkSession, fingerprint_of(docs, id_col, text_col)
    found = None if rebuild else load_index(spark, path, tokenizer, own)
    if found is None:
        save_index(replace(build_index(docs, id_col, text_col, tokenizer), fingerprint=own), path)
        found = load_index(spark, path, tokenizer, own)
    return found


def search(index: Index, queries: DataFrame, k: int, query_id: str = "id", query_text: str = "question", pad: bool = False) -> DataFrame:
    """(qid, id, score, rank from 0), the k best documents of each query; ties go to the smaller id.

    A token that a query has twice counts twice. Queries without tokens have no hits. With pad, a query with
    fewer than k matches is filled up with documents of score 0, by id.
    """
    asked = queries.select(F.col(query_id).alias("qid"), tokenize(F.col(query_text), index.tokenizer).alias("t"))
    terms = asked.select("qid", F.explode("t").alias("term")).groupBy("qid", "term").agg(F.count("*").alias("weight"))
    if k <= 0 or not index.n:
        return terms.select("qid", F.lit(None).cast(index.postings.schema["id"].dataType).alias("id"), F.lit(0.0).alias("score"), F.lit(0).alias("rank")).where("false")
    idf = F.log(1 + (F.lit(float(index.n)) - F.col("df") + 0.5) / (F.col("df") + 0.5))
    weighted = terms.join(index.terms, "term").select("qid", "term", (F.col("weight") * idf).alias("w"))
    # Only postings of asked terms go on; sending the terms out is cheaper than moving postings.
    small = terms.limit(BROADCAST_QUERY_TERMS + 1).count() <= BROADCAST_QUERY_TERMS
    hits = index.postings.join(F.broadcast(weighted) if small else weighted, "term")
    part = F.col("w") * F.col("tf") / (F.col("tf") + K1 * (1 - B + B * F.col("dl") / F.lit(index.avgdl)))
    scored = hits.groupBy("qid", "id").agg(F.sum(part).alias("score"))
    best = _top(scored, k)
    if not pad:
        return best
    # The k smallest ids hold enough fillers for any query: at most k of them can be hits already.
    fill = asked.where(F.size("t") > 0).select("qid").distinct().withColumn("ids", F.array(*[F.lit(r["id"]) for r in index.documents.orderBy("id").limit(k + k).collect()]))
    zero = fill.select("qid", F.explode("ids").alias("id")).join(scored.select("qid", "id"), ["qid", "id"], "left_anti").withColumn("score", F.lit(0.0))
    return _top(best.select("qid", "id", "score").unionByName(zero), k)


def _top(scored: DataFrame, k: int) -> DataFrame:
    # Sums of doubles depend on their order in the last digits: scores that agree in nine decimals are a tie.
    rank = F.row_number().over(W.partitionBy("qid").orderBy(F.round("score", 9).desc(), "id"))
    return scored.withColumn("rank", rank).where(F.col("rank") <= k).withColumn("rank", (F.col("rank") - 1).cast("int")).select("qid", "id", "score", "rank")
