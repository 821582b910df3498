"""Quality of retrieval without labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import strip_parens
from .intent import question_intent

FRACTIONS = {"p10": 0.10, "p25": 0.25, "p75": 0.75, "p90": 0.90}
#: Pieces that a group's values are cut into: one window holds about so small a share of them.
PIECES = 64
#: Different values of a group that the cuts come from, at most on average.
MARKED = 64 * PIECES


def percentiles(rows: DataFrame, keys: list[str], value: str) -> DataFrame:
    """keys, min, p10, p25, median, p75, p90, max of each group. A percentile is the value at index min(n - 1, int(f * n)) of
    the sorted ones; the median of an even number is the mean of the middle two. Nulls don't count; a null key is a group.

    Values are counted first, then cut into pieces; counts by piece tell which pieces hold the wanted places, and only there
    values are put in order. So no task holds a group, and the result is exact. The plan cuts twice, for the counts and for
    the values, and a lost task cuts again: the cuts are values whose hash says so, which are the same ones each time,
    while approximate percentiles depend on the order in which rows come in.
    """
    valued = rows.where(F.col(value).isNotNull()).select(F.struct(*(keys or [F.lit(0)])).alias("_key"), F.col(value).alias("_v"))
    counted = valued.groupBy("_key", "_v").agg(F.count("*").alias("_n"))
    sized = counted.join(counted.groupBy("_key").agg(F.sum("_n").alias("_total"), F.ceil(F.count("*") / MARKED).alias("_of")), "_key")
    chosen = sized.where(F.pmod(F.xxhash64("_v"), F.col("_of")) == 0).groupBy("_key").agg(F.array_sort(F.collect_list("_v")).alias("_s"))
    marks = chosen.select("_key", F.array_distinct(F.transform(F.sequence(F.lit(1), F.lit(PIECES - 1)), lambda k: F.get("_s", F.floor(k * F.size("_s") / PIECES).cast("int")))).alias("_marks"))
    piece = F.coalesce(F.size(F.filter("_marks", lambda m: m < F.col("_v"))), F.lit(0))
    cut = sized.join(marks, "_key", "left").select("_key", "_v", "_n", "_total", piece.alias("_piece"))
    pieces = cut.groupBy("_key", "_piece").agg(F.sum("_n").alias("_in"))
    before = pieces.withColumn("_before", F.sum("_in").over(W.partitionBy("_key").orderBy("_piece")) - F.col("_in"))
    at = lambda f: F.least(F.col("_total") - 1, F.floor(F.lit(f) * F.col("_total")))
    places = {"min": F.lit(0), "max": F.col("_total") - 1, "_low": F.floor((F.col("_total") - 1) / 2), "_high": F.floor(F.col("_total") / 2), **{n: at(f) for n, f in FRACTIONS.items()}}
    wanted = F.array(*[p.cast("long") for p in places.values()])
    held = cut.join(before, ["_key", "_piece"]).where(F.exists(wanted, lambda p: (p >= F.col("_before")) & (p < F.col("_before") + F.col("_in"))))
    upto = held.withColumn("_upto", F.col("_before") + F.sum("_n").over(W.partitionBy("_key", "_piece").orderBy("_v")))
    here = lambda p: F.max(F.when((p >= F.col("_upto") - F.col("_n")) & (p < F.col("_upto")), F.col("_v")))
    found = upto.groupBy("_key").agg(*[here(p).alias(n) for n, p in places.items()])
    return found.select(*[F.col("_key")[k].alias(k) for k in keys], "min", "p10", "p25", ((F.col("_low") + F.col("_high")) / 2).alias("median"), "p75", "p90", "max")


def hit_rates(results: DataFrame, known: str = "ticker_in_parens", ks: tuple[int, ...] = (1, 3, 5, 10)) -> DataFrame:
    """Share of questions with a known code for which one of the first k candidates has it: one column for each k."""
    rows = results.where(F.size(known) > 0)
    hit = lambda k: F.arrays_overlap(F.transform(F.slice("candidates", 1, k), lambda c: c["ticker"]), F.col(known))
    return rows.agg(F.count("*").alias("questions"), *[F.avg(F.coalesce(hit(k), F.lit(False)).cast("double")).alias(f"top{k}") for k in ks])


def parser_agreement(questions: DataFrame, companies: DataFrame) -> DataFrame:
    """(outcome, n): does the parser find the codes in parentheses without reading them? agree, superset, missing or conflict."""
    full = question_intent(questions, companies).where(F.size("ticker_in_parens") > 0).select("id", "ticker_in_parens")
    blind = question_intent(questions.withColumn("question", strip_parens(F.col("question"))), companies).select("id", F.col("tickers").alias("blind"))
    told = F.col("ticker_in_parens")
    outcome = (
        F.when(F.col("blind") == told, "agree").when(F.size(F.array_except(told, F.col("blind"))) == 0, "superset").when(F.size("blind") == 0, "missing").otherwise("conflict")
    )
    return full.join(blind, "id").groupBy(outcome.alias("outcome")).agg(F.count("*").alias("n"))


def extra_tickers(results: DataFrame) -> DataFrame:
    """(ticker, n, in_top5) of codes that the parser added to those in parentheses, and for how many questions a table of it is in the first five."""
    extra = results.where((F.size("candidates") > 0) & (F.size("ticker_in_parens") > 0)).select("candidates", F.explode(F.array_except("tickers", "ticker_in_parens")).alias("ticker"))
    inside = F.exists(F.slice("candidates", 1, 5), lambda c: c["ticker"] == F.col("ticker"))
    return extra.groupBy("ticker").agg(F.count("*").alias("n"), F.count_if(inside).alias("in_top5"))


def wrong_tickers(results: DataFrame, first: int = 5) -> DataFrame:
    """(ticker, n): codes of the first candidates that the question doesn't ask for, by the number of candidates.

    Only questions with a code in parentheses count, as those say for sure what is right.
    """
    shown = results.where(F.size("ticker_in_parens") > 0).select("ticker_in_parens", F.explode(F.slice("candidates", 1, first)).alias("c"))
    return shown.where(~F.array_contains("ticker_in_parens", F.col("c.ticker"))).groupBy(F.col("c.ticker").alias("ticker")).agg(F.count("*").alias("n"))


def report(results: DataFrame) -> DataFrame:
    """One row: questions, empty ones, first scores that are zero, and how often the first hit has the asked year and scope."""
    first = F.get("candidates", F.lit(0))
    some = F.size("candidates") > 0
    return results.agg(
        F.count("*").alias("questions"), F.count_if(~some).alias("empty"), F.count_if(some & (first["score"] <= 0)).alias("top1_zero"), F.count_if(some & (F.size("ticker_in_parens") > 0)).alias("with_paren_ticker"),
        F.count_if(some & (F.size("years") > 0)).alias("with_year"), F.count_if(some & F.coalesce(F.array_contains("years", first["year"]), F.lit(False))).alias("top1_year_match"),
        F.count_if(some & F.col("scope").isNotNull()).alias("with_scope"), F.count_if(some & F.coalesce(first["scope"] == F.col("scope"), F.lit(False))).alias("top1_scope_match"),
    )


def examples(results: DataFrame, count: int) -> DataFrame:
    """Evenly strided questions, in order of id: those at places 0, step, 2 * step, ... of the sorted ids.

    Places come from counts by range of ids, so one window holds a range.
    """
    total = results.count()
    step = max(1, total // max(1, count))
    size = max(1024, step)
    low = results.agg(F.min("id")).first()[0]
    if low is None:
        return results
    ranged = results.select("id", F.floor((F.col("id") - low) / size).alias("_range"))
    counts = ranged.groupBy("_range").agg(F.count("*").alias("_in"))
    before = counts.withColumn("_before", F.sum("_in").over(W.orderBy("_range")) - F.col("_in"))
    place = F.col("_before") + F.row_number().over(W.partitionBy("_range").orderBy("id")) - 1
    chosen = ranged.join(before, "_range").withColumn("_place", place).where((F.col("_place") % step == 0) & (F.col("_place") < step * count))
    return results.join(chosen.select("id"), "id", "left_semi").orderBy("id")
