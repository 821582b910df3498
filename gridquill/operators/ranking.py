"""Metadata-aware ranking of search hits, and the payload that goes with the chosen ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def year_ok(hit_year: Column, years: Column, expand: bool = True) -> Column:
    """No year asked, none known, one of those asked, or (expand) the year after one of them."""
    near = F.array_contains(years, hit_year)
    if expand:
        near = near | F.array_contains(years, hit_year - 1)
    return (F.size(years) == 0) | hit_year.isNull() | F.coalesce(near, F.lit(False))


def scope_ok(hit_scope: Column, scope: Column) -> Column:
    return scope.isNull() | hit_scope.isNull() | (hit_scope == scope)


def annotate(hits: DataFrame, year_expand: bool = True) -> DataFrame:
    """hits (qid, rank, ticker, year, scope, asked_tickers, asked_years, asked_scope) with ticker_ok, year_ok, scope_ok, reasons."""
    ticker = (F.size("asked_tickers") == 0) | F.coalesce(F.array_contains("asked_tickers", F.col("ticker")), F.lit(False))
    flags = hits.withColumns({"ticker_ok": ticker, "year_ok": year_ok(F.col("year"), F.col("asked_years"), year_expand), "scope_ok": scope_ok(F.col("scope"), F.col("asked_scope"))})
    reason = lambda ok, what: F.when(~F.col(ok), F.lit(what))
    return flags.withColumn("reasons", F.array_compact(F.array(reason("ticker_ok", "ticker_mismatch"), reason("year_ok", "year_mismatch"), reason("scope_ok", "scope_mismatch"))))


def select_candidates(annotated: DataFrame, top_k: int, fallback_quota: int = 0) -> DataFrame:
    """The top_k hits of each question with pos (from 0): first what fits, then partly, and a few of the rest.

    Hits that fit in all points come by (year named exactly, rank), those that fit partly by rank. If the question
    has any constraint, fallback_quota places go to the best of the rest. Places left over are filled from the first
    group, then the rest; a table_ref that is in already isn't taken again then.
    """
    if top_k <= 0:
        return annotated.withColumn("pos", F.lit(0)).where("false")
    whole = F.col("ticker_ok") & F.col("year_ok") & F.col("scope_ok")
    partly = F.col("ticker_ok") & (F.col("year_ok") | F.col("scope_ok"))
    exact_year = (F.size("asked_years") == 0) | F.coalesce(F.array_contains("asked_years", F.col("year")), F.lit(False))
    tier = F.when(whole, 0).when(partly, 1).otherwise(2)
    late = F.when((tier == 0) & ~exact_year, 1).otherwise(0)
    bound = (F.size("asked_tickers") > 0) | (F.size("asked_years") > 0) | (F.coalesce(F.col("asked_scope"), F.lit("")) != "")
    quota = F.when(bound, F.lit(min(fallback_quota, max(0, top_k - 1)))).otherwise(0)
    staged = annotated.withColumns({"_tier": tier, "_late": late, "_rest": tier == 2, "_quota": quota})
    place = F.row_number().over(W.partitionBy("qid", "_rest").orderBy("_tier", "_late", "rank"))
    placed = staged.withColumn("_place", place)
    early = F.when(F.col("_rest"), F.col("_place") <= F.col("_quota")).otherwise(F.col("_place") <= F.lit(top_k) - F.col("_quota"))
    block = F.when(early, F.when(F.col("_rest"), 1).otherwise(0)).otherwise(F.when(F.col("_rest"), 3).otherwise(2))
    blocked = placed.withColumn("_block", block)
    by_ref = W.partitionBy("qid", "table_ref").orderBy("_block", "_place")
    known = blocked.withColumn("_again", F.row_number().over(by_ref)).where((F.col("_block") <= 1) | (F.col("_again") == 1))
    pos = F.row_number().over(W.partitionBy("qid").orderBy("_block", "_place"))
    return known.withColumn("pos", pos).where(F.col("pos") <= top_k).withColumn("pos", (F.col("pos") - 1).cast("int")).drop("_tier", "_late", "_rest", "_quota", "_place", "_block", "_again")


def attach_payload(selected: DataFrame, tables: DataFrame) -> DataFrame:
    """selected with context_before and csv_text of its table; of tables with one key the first by order counts.

    Hits without a table go, and leave a gap in pos.
    """
    first = tables.withColumn("_n", F.row_number().over(W.partitionBy("doc_name", "line").orderBy("order"))).where("_n = 1")
    return selected.join(first.select("doc_name", "line", "context_before", "csv_text"), ["doc_name", "line"])


def retrieval_results(selected: DataFrame, intents: DataFrame) -> DataFrame:
    """One row for each question with its candidates as an array in order of pos; without hits the array is empty."""
    fields = ["table_ref", "doc_name", "ticker", "year", "scope", "line", "page", F.col("pos").alias("rank"), "score", "context_before", "csv_text"]
    nested = selected.groupBy("qid").agg(F.array_sort(F.collect_list(F.struct("pos", F.struct(*fields).alias("c")))).alias("x")).select("qid", F.transform("x", lambda v: v["c"]).alias("candidates"))
    kind = nested.schema["candidates"].dataType.simpleString()
    return intents.join(nested, F.col("id") == F.col("qid"), "left").select("id", "question", "tickers", "years", "scope", F.coalesce("candidates", F.array().cast(kind)).alias("candidates"))


def retrieve(questions: DataFrame, companies: DataFrame, entries: DataFrame, tables: DataFrame, config: dict, index=None) -> DataFrame:
    """Questions to retrieval results: over-fetch by BM25 (over index, or one that is made here for these questions), intent, tiers, payload."""
    from .intent import question_intent
    from .search import build_index, search

    r = config["retrieval"]
    intents = question_intent(questions, companies)
    hits = search(index or build_index(entries, asked=questions.select("question")), questions, r["top_k"] * r["fetch_multiplier"])
    meta = intents.select(F.col("id").alias("qid"), F.col("tickers").alias("asked_tickers"), F.col("years").alias("asked_years"), F.col("scope").alias("asked_scope"))
    known = hits.join(entries.withColumnRenamed("table_ref", "id"), "id").withColumnRenamed("id", "table_ref").join(meta, "qid")
    chosen = select_candidates(annotate(known, r["year_expand"]), r["top_k"], r["fallback_quota"])
    return retrieval_results(attach_payload(chosen, tables), intents)


def retrieval_stats(results: DataFrame) -> DataFrame:
    """One row of counts over retrieval results."""
    return results.agg(
        F.count("*").alias("questions"), F.count_if(F.size("candidates") == 0).alias("empty"), F.sum(F.size("candidates")).alias("candidates"), F.count_if(F.size("tickers") > 0).alias("with_ticker"),
        F.count_if(F.size("years") > 0).alias("with_year"), F.count_if(F.col("scope").isNotNull()).alias("with_scope"), F.count_if(F.coalesce(F.get("candidates", F.lit(0))["score"], F.lit(1.0)) <= 0).alias("top1_zero"),
    )


def last_by(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The last row of each key by an order column."""
    return rows.withColumn("_n", F.row_number().over(W.partitionBy(*keys).orderBy(F.desc(order)))).where("_n = 1").drop("_n")
