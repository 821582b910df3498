"""Numbers in Vietnamese notation: dot between thousands, comma before decimals, parentheses for negatives."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import let, strip

REL_TOL, ABS_TOL = 2e-4, 0.0


def _separators(s: Column) -> Column:
    """Group separators out, the decimal sign as a dot."""
    comma, dot = s.contains(","), s.contains(".")
    comma_last = s.rlike(",[^.]*$")
    return (
        F.when(comma & dot & comma_last, F.replace(F.replace(s, F.lit("."), F.lit("")), F.lit(","), F.lit(".")))
        .when(comma & dot, F.replace(s, F.lit(","), F.lit("")))
        .when(comma, F.when(s.rlike("(?s)^[^,]*(,[^,]{3}){2,}$"), F.replace(s, F.lit(","), F.lit(""))).otherwise(F.replace(s, F.lit(","), F.lit("."))))
        .when(dot & s.rlike("(?s)^[^.]*((\\.[^.]*){2,}|\\.[^.]{3})$"), F.replace(s, F.lit("."), F.lit("")))
        .otherwise(s)
    )


def _signed(text: Column, python_float: bool) -> Column:
    """Value of stripped text: sign and parentheses, separators, then a guarded cast."""
    digits = "\\d+(_\\d+)*"
    guard = f"^[+-]?({digits}(\\.({digits})?)?|\\.{digits})([eE][+-]?{digits})?$" if python_float else "^[+-]?(\\d+\\.?\\d*|\\.\\d+)$"

    def value(plain: Column) -> Column:
        return F.when(plain.rlike(guard), (F.replace(plain, F.lit("_"), F.lit("")) if python_float else plain).try_cast("double"))

    def sign(inside: Column) -> Column:
        minus = inside.startswith("-")
        number = let(let(F.when(minus, F.substr(inside, F.lit(2))).otherwise(inside), _separators), value)
        return number * F.when((text.startswith("(") & text.endswith(")")) != minus, -1.0).otherwise(1.0)

    inside = F.regexp_replace(F.replace(F.regexp_replace(text, "^[()]+|[()]+$", ""), F.lit(" "), F.lit("")), "%+$", "")
    return let(F.regexp_replace(inside, "^\\+", ""), sign)


def parse_number(text: Column) -> Column:
    """The number that the whole cell is, else null: ``1.234,5``, ``(1.234)``, ``12,5%`` (as 12.5), ``1,234,567``."""
    whole = lambda s: F.when(s.rlike("(?U)\\d") & s.rlike("(?U)^[\\d.,\\-+()%\\s]+$"), _signed(s, False))
    return let(strip(text.cast("string")), whole)


def to_num(text: Column) -> Column:
    """The laxer reading that queries use: no test of the characters, and Python's float syntax (1e5, 1_000)."""
    return let(strip(text.cast("string")), lambda s: F.when(s.rlike("\\d"), _signed(s, True)))


def is_numeric_cell(text: Column) -> Column:
    return parse_number(text).isNotNull()


def answers_match(expected: Column, actual: Column, rel_tol: float = REL_TOL, abs_tol: float = ABS_TOL) -> Column:
    """Within a relative tolerance of the larger magnitude, or an absolute one; equal infinities match."""
    near = F.abs(expected - actual) <= F.greatest(F.lit(rel_tol) * F.greatest(F.abs(expected), F.abs(actual)), F.lit(abs_tol))
    infinite = (F.abs(expected) == float("inf")) | (F.abs(actual) == float("inf"))
    return (expected == actual) | (~infinite & ~F.isnan(expected) & ~F.isnan(actual) & near)


def coerce_number(value: object) -> float | None:
    """A result of executed code as a float: numbers and numpy scalars, text in Vietnamese notation; else None."""
    if hasattr(value, "item") and callable(value.item) and not isinstance(value, (str, bytes)):
        try:
            value = value.item()
        except (TypeError, ValueError):
            return None
    if isinstance(value, str):
        return parse_text(value)
    if isinstance(value, bool) or not isinstance(value, (int, float)):
        return None
    return float(value) if math.isfinite(value) else None


def read_cell(cell):
    """to_num for one Python value. Its source is also the helper of generated queries, so it needs built-ins only."""
    shown = str(cell).strip()
    if not any(c.isdigit() for c in shown):
        return None
    bare = "".join(c for c in shown.strip("()") if c != " ").rstrip("%")
    bare = bare.removeprefix("+")
    size = bare.removeprefix("-")
    marks = [c for c in size if c in ",."]
    point = marks[-1] if marks else ""
    if len(set(marks)) == 1:
        # One kind of mark groups thousands if its groups look like it; a comma has to do so more than once.
        widths = [len(group) for group in size.split(point)][1:]
        groups = set(widths) == {3} and len(widths) > 1 if point == "," else widths == [3] or len(widths) > 1
        point = "" if groups else point
    try:
        value = float("".join("." if c == point else c for c in size if c == point or c not in ",."))
    except ValueError:
        return None
    inverted = (shown[0] == "(" and shown[-1] == ")") != (bare != size)
    return -value if inverted else value


_STRICT_CHARACTERS = set("0123456789.,-+()%")


def parse_text(text: str) -> float | None:
    """parse_number for one Python string: read_cell of what is written in a number's characters only."""
    return read_cell(text) if all(c in _STRICT_CHARACTERS or c.isspace() for c in text.strip()) else None


@F.pandas_udf(T.DoubleType())
def parse_number_python(text: pd.Series) -> pd.Series:
    """parse_text over a column, for comparison with the column expression."""
    return text.map(lambda t: None if t is None else parse_text(t)).astype("float64")


def format_vn(value: Column, decimals: int = 2) -> Column:
    """``1.234,56``, negatives as ``(1.234,56)``: the inverse of parse_number."""
    body = F.translate(F.format_number(F.abs(value), decimals), ",.", ".,")
    return F.when(value < 0, F.concat(F.lit("("), body, F.lit(")"))).otherwise(body)
