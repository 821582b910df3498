"""Text functions as columns. Only NFC composition needs Python; everything else stays in the JVM."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Legal forms that a company name may start with, in the order in which they are tried.
LEGAL_PREFIXES = (
    "congtycophantapdoan", "congtycophan", "ctcptapdoan", "ctcp", "congtytnhh",
    "tnhh", "nganhangtmcp", "nganhang", "tongcongty", "tapdoan",
)
MIN_ALIAS = 6


@lru_cache(maxsize=1)
def _bases() -> tuple[str, str]:
    """Characters of the basic plane that are one base character plus marks, and those bases."""
    pairs = {"đ": "d", "Đ": "D"}
    for code in [*range(0xA0, 0x3000), *range(0xFB00, 0xFFFE)]:
        plain = "".join(c for c in unicodedata.normalize("NFD", chr(code)) if unicodedata.category(c) != "Mn")
        if len(plain) == 1 and plain != chr(code):
            pairs[chr(code)] = {"đ": "d", "Đ": "D"}.get(plain, plain)
    return "".join(pairs), "".join(pairs.values())


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of a value that is computed once, however often body names it; generated code stays small."""
    return F.transform(F.array(value), body)[0]


def ascii_fold(text: Column) -> Column:
    """Without diacritics, đ as d, lower case; separators stay."""
    source, target = _bases()
    return F.lower(F.translate(F.regexp_replace(text, "\\p{Mn}+", ""), source, target))


def ascii_compact(text: Column) -> Column:
    return F.regexp_replace(ascii_fold(text), "[^a-z0-9]", "")


def ascii_tokens(text: Column) -> Column:
    return F.filter(F.split(ascii_fold(text), "[^a-z0-9]+"), lambda t: t != "")


@F.pandas_udf(T.StringType())
def nfc(text: pd.Series) -> pd.Series:
    """Composed form; texts that are composed already are passed through."""
    return text.map(lambda t: t if t is None or t.isascii() or unicodedata.is_normalized("NFC", t) else unicodedata.normalize("NFC", t))


def strip(text: Column) -> Column:
    """Without white space at either end, Unicode's included."""
    return F.regexp_replace(text, "(?U)^\\s+|\\s+$", "")


def collapse(text: Column) -> Column:
    return strip(F.regexp_replace(text, "(?U)\\s+", " "))


def clean_cell(text: Column) -> Column:
    """A cell's text: composed, no-break spaces as spaces, white space collapsed."""
    return collapse(nfc(F.replace(text, F.lit(" "), F.lit(" "))))


def casefold(text: Column) -> Column:
    return F.replace(F.lower(text), F.lit("ß"), F.lit("ss"))


def normalize_text(text: Column, compose: bool = False) -> Column:
    """Case-folded text with single spaces. compose first puts decomposed letters together (in Python)."""
    return collapse(casefold(nfc(text) if compose else text))


TOKENIZERS: dict[str, Callable[[Column], Column]] = {"words": lambda text: F.regexp_extract_all(text, F.lit("([\\p{L}\\p{N}]+)"), 1)}


def register_tokenizer(name: str, split_words: Callable[[str], list[str]]) -> None:
    """Add a word segmenter (a Python function from text to words) by name; it runs on Arrow batches."""

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def segmented(text: pd.Series) -> pd.Series:
        return text.map(lambda t: split_words(t) if t else [])

    TOKENIZERS[name] = segmented


def tokenize(text: Column, tokenizer: str = "words") -> Column:
    """Tokens of the normalised text; null and empty texts have none."""
    return TOKENIZERS[tokenizer](F.coalesce(normalize_text(text), F.lit("")))


def company_aliases(name: Column) -> Column:
    """The compact name, and what follows its first legal prefix if that is long enough."""
    compact = ascii_compact(name)
    rest = F.lit(None).cast("string")
    for prefix in reversed(LEGAL_PREFIXES):
        rest = F.when(compact.startswith(prefix), F.substr(compact, F.lit(len(prefix) + 1))).otherwise(rest)
    both = F.array_compact(F.array(compact, F.when(F.length(rest) >= MIN_ALIAS, rest)))
    return F.when(F.coalesce(compact, F.lit("")) == "", F.array().cast("array<string>")).otherwise(F.array_distinct(both))


def strip_parens(text: Column) -> Column:
    return F.regexp_replace(text, "\\([^)]*\\)", " ")


def table_ref(doc_name: Column, line: Column) -> Column:
    return F.concat_ws("|", doc_name, line.cast("string"))


def parse_table_ref(ref: Column, strict: bool = True) -> Column:
    """(doc_name, line) of ``<doc>|<line>``, cut at the last bar; strict fails on anything else, else null."""
    good = ref.rlike("(?s)^.*\\|\\d+$")
    bad = F.raise_error(F.concat(F.lit("not a table reference: "), F.coalesce(ref, F.lit("null")))).cast("struct<doc_name:string,line:int>") if strict else F.lit(None)
    parts = F.struct(F.regexp_extract(ref, "(?s)^(.*)\\|(\\d+)$", 1).alias("doc_name"), F.regexp_extract(ref, "(?s)^(.*)\\|(\\d+)$", 2).cast("int").alias("line"))
    return F.when(good, parts).otherwise(bad)


def csv_file_name(doc_name: Column, line: Column) -> Column:
    return F.concat(doc_name, F.lit("_table_"), line.cast("string"), F.lit(".csv"))


@F.pandas_udf(T.ArrayType(T.StringType()))
def csv_header(text: pd.Series) -> pd.Series:
    """First record of CSV text; none in empty text."""
    import csv
    import io

    return text.map(lambda t: next(csv.reader(io.StringIO(t or "")), []))


def thousands(number: Column) -> Column:
    """Whole number with dots between groups of three digits."""
    return F.replace(F.format_number(number, 0), F.lit(","), F.lit("."))


def contains_any(text: Column, words: tuple[str, ...]) -> Column:
    found = F.lit(False)
    for word in words:
        found = found | text.contains(word)
    return found
