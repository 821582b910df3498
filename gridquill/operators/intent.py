"""What a question asks for: companies, years and kind of report, by lexical rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import ascii_compact, ascii_tokens, company_aliases, contains_any

MIN_YEAR, MAX_YEAR = 2015, 2025
#: Kind of report by compact text.
SEPARATE_WORDS = ("congtyme", "baocaorieng", "bctcrieng", "rienngle", "baocaotaichinhrieng")
CONSOLIDATED_WORDS = ("hopnhat", "baocaohopnhat", "bctchn", "toantapdoan")
#: The company dimension goes to every task only up to this many rows.
BROADCAST_COMPANIES = 200_000
#: Characters of an alias that it is looked up by; a shorter alias by all it has.
ALIAS_KEY = 6


def years_of(text: Column) -> Column:
    """Sorted distinct years 20xx in range that aren't part of a longer number."""
    found = F.transform(F.regexp_extract_all(text, F.lit("(?<!\\d)(20\\d{2})(?!\\d)"), 1), lambda y: y.cast("int"))
    return F.array_sort(F.array_distinct(F.filter(found, lambda y: y.between(MIN_YEAR, MAX_YEAR))))


def scope_of_question(text: Column) -> Column:
    """separate, consolidated, or null if neither or both are named."""
    compact = ascii_compact(text)
    separate, consolidated = contains_any(compact, SEPARATE_WORDS), contains_any(compact, CONSOLIDATED_WORDS)
    return F.when(separate & ~consolidated, F.lit("separate")).when(consolidated & ~separate, F.lit("consolidated"))


def codes_in_parens(text: Column) -> Column:
    """Runs of 3 or 4 capitals and digits in parentheses of up to 40 characters, small letters counting as capitals."""
    groups = F.regexp_extract_all(text, F.lit("\\(([^)]{1,40})\\)"), 1)
    return F.array_distinct(F.flatten(F.transform(groups, lambda g: F.regexp_extract_all(F.upper(g), F.lit("([A-Z0-9]{3,4})"), 1))))


def companies_with_aliases(companies: DataFrame) -> DataFrame:
    """ticker, name, aliases, name_tokens of a company dimension (ticker, name)."""
    return companies.select("ticker", "name", company_aliases(F.col("name")).alias("aliases"), ascii_tokens(F.col("name")).alias("name_tokens"))


def question_intent(questions: DataFrame, companies: DataFrame, question_col: str = "question") -> DataFrame:
    """questions (with id) plus tickers, years, scope, ticker_in_parens; arrays are sorted.

    Codes in parentheses and bare codes are found by equality with the dimension (words of the question are
    exploded), aliases by containment, keyed by their first characters (runs of that many of the question are exploded).
    The dimension is broadcast up to a size that is checked; beyond it the same joins run as shuffles. A bare code
    that only is a word of the name of another company matched by name doesn't count.
    """
    q = F.col(question_col)
    known = companies_with_aliases(companies)
    small = known.limit(BROADCAST_COMPANIES + 1).count() <= BROADCAST_COMPANIES
    known = F.broadcast(known) if small else known
    words = questions.select("id", q.alias("_q"), F.explode(F.array_distinct(F.filter(F.split(F.upper(q), "[^A-Z0-9]+"), lambda w: w != ""))).alias("ticker"))
    bare = words.join(known.select("ticker"), "ticker").where(F.col("_q").contains(F.col("ticker"))).select("id", "ticker", F.lit("bare").alias("how"))
    inside = questions.select("id", F.explode(codes_in_parens(q)).alias("ticker")).join(known.select("ticker"), "ticker").select("id", "ticker", F.lit("parens").alias("how"))
    # A question holds an alias only if it holds the alias's first characters: those are the key of the join.
    aliases = known.select("ticker", F.explode("aliases").alias("alias")).where("alias <> ''").withColumn("gram", F.left("alias", F.lit(ALIAS_KEY)))
    sizes = sorted(r.size for r in aliases.select(F.length("gram").alias("size")).distinct().collect())
    compact = questions.select("id", ascii_compact(q).alias("_compact"))
    grams = lambda size: F.transform(F.sequence(F.lit(1), F.greatest(F.length("_compact") - size + 1, F.lit(1))), lambda i: F.substr(F.col("_compact"), i, F.lit(size)))
    keyed = compact.select("id", "_compact", F.explode(F.array_distinct(F.concat(F.array().cast("array<string>"), *map(grams, sizes)))).alias("gram"))
    met = keyed.join(F.broadcast(aliases) if small else aliases, "gram").where(F.col("_compact").contains(F.col("alias")))
    named = met.select("id", "ticker", F.lit("name").alias("how")).distinct()
    every = bare.unionByName(inside).unionByName(named)
    by = every.groupBy("id").agg(
        *[F.array_sort(F.collect_set(F.when(F.col("how") == how, F.col("ticker")))).alias(how) for how in ("bare", "parens", "name")]
    )
    # Words of names that matched, with how many companies have each: a code is shadowed by another company only.
    name_words = named.join(known.select("ticker", "name_tokens"), "ticker").select("id", "ticker", F.explode(F.array_distinct("name_tokens")).alias("word"))
    doubtful = by.select("id", F.explode(F.array_except(F.array_except("bare", "parens"), "name")).alias("ticker")).withColumn("word", ascii_compact(F.col("ticker")))
    shadowed = (
        doubtful.join(name_words.withColumnRenamed("ticker", "other"), ["id", "word"], "left_semi").groupBy("id").agg(F.collect_set("ticker").alias("shadowed"))
    )
    none = F.array().cast("array<string>")
    joined = questions.join(by, "id", "left").join(shadowed, "id", "left")
    col = lambda c: F.coalesce(F.col(c), none)
    return joined.select(
        *[questions[c] for c in questions.columns],
        F.array_sort(F.array_union(F.array_union(F.array_except(col("bare"), col("shadowed")), col("name")), col("parens"))).alias("tickers"),
        years_of(q).alias("years"), scope_of_question(q).alias("scope"), col("parens").alias("ticker_in_parens"),
    )
