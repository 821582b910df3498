"""Documents that every operator must take: nulls, empty, long, repeated and clashing ones."""

LONG = "và một câu rất dài lặp lại mãi " * 4000
TEXTS = [
    (1, "The quick brown fox jumps over the lazy dog and runs away from the angry bear today", "en", "a"),
    (2, None, "en", "a"), (3, "", None, None), (4, " \n\t ", "fr", "b"), (5, LONG, "vi", "a"), (None, "no id here but some words follow", None, "b"),
    (6, "The quick brown fox jumps over the lazy dog and runs away from the angry bear today", "en", None), (7, "123 456 !!! ???", "xx", "b"), (8, "ÄÖÜ ÉÈ <|im_end|> <\\|x", "de", "b"), (9, "a", "en", "a"), (9, "a", "en", "a"),
]
DDL = "doc_id long, text string, lang string, source string"


def documents(spark, rows=None):
    """With columns whose names operators use inside."""
    from pyspark.sql import functions as F

    d = spark.createDataFrame(TEXTS if rows is None else rows, DDL)
    return d.withColumns({c: F.lit("clash") for c in ("size", "h", "skey", "n", "node", "comp", "bundle", "part", "score", "label", "key", "range", "cut", "text_key")})


def empty(spark):
    return documents(spark, [])
