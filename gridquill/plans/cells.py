"""Questions as declarative cell lookups, compiled to DataFrames over the long form of tables.

A lookup names a row label, a column and a scale. Evaluated over cells (qid, table_pos, row, col, value), it
takes the first table with a row whose first cell contains the label, the first such row, the named column
or else the first number of the row, and multiplies. Expressions combine lookups by question.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.numbers import parse_number


def lookup(lookups: DataFrame, cells: DataFrame, keep_missing: bool = True) -> DataFrame:
    """(qid, key, value) of lookups (qid, key, label, col, scale) over cells (qid, table_pos, row, col, value).

    Labels are compared without case. A table whose row has no number is passed over, as one without the row is.
    keep_missing keeps lookups that found nothing, with a null value.
    """
    rows = cells.groupBy("qid", "table_pos", "row").agg(
        F.max(F.when(F.col("col") == 0, F.lower("value"))).alias("label_cell"),
        F.array_sort(F.collect_list(F.when(parse_number(F.col("value")).isNotNull(), F.struct("col", parse_number(F.col("value")).alias("num"))))).alias("nums"),
    )
    found = lookups.alias("l").join(rows.alias("r"), "qid").where(F.col("label_cell").contains(F.lower("label")))
    first = found.withColumn("_n", F.row_number().over(W.partitionBy("qid", "key", "table_pos").orderBy("row"))).where("_n = 1")
    named = F.get(F.filter("nums", lambda x: x["col"] == F.col("l.col")), F.lit(0))["num"]
    valued = first.withColumn("v", F.coalesce(named, F.get("nums", F.lit(0))["num"])).where("v is not null")
    best = valued.groupBy("qid", "key").agg(F.min_by(F.col("v") * F.col("scale"), "table_pos").alias("value"))
    return lookups.select("qid", "key").join(best, ["qid", "key"], "left") if keep_missing else best


@dataclass(frozen=True)
class Cell:
    """A lookup by key."""

    key: str

    def column(self) -> Column:
        return F.col("v")[self.key]


@dataclass(frozen=True)
class Diff:
    """a - b; a magnitude unless directed."""

    a: Cell
    b: Cell
    directed: bool = False

    def column(self) -> Column:
        d = self.a.column() - self.b.column()
        return d if self.directed else F.abs(d)


@dataclass(frozen=True)
class Growth:
    """Change from old to new in percent of old's magnitude; null where old is 0."""

    new: Cell
    old: Cell

    def column(self) -> Column:
        return F.try_divide(self.new.column() - self.old.column(), F.abs(self.old.column())) * 100


@dataclass(frozen=True)
class Ratio:
    """a / b, on the scale of 100 if percent."""

    a: Cell
    b: Cell
    percent: bool = False

    def column(self) -> Column:
        return F.try_divide(self.a.column(), self.b.column()) * (100 if self.percent else 1)


@dataclass(frozen=True)
class Sum:
    parts: tuple[Cell, ...]

    def column(self) -> Column:
        return sum((p.column() for p in self.parts[1:]), self.parts[0].column())


def evaluate(values: DataFrame, expressions: dict[str, Cell | Diff | Growth | Ratio | Sum], fallback: float | None = None) -> DataFrame:
    """(qid, one column for each named expression) over lookup values; null where a part is missing, unless a fallback is given."""
    pairs = F.filter(F.collect_list(F.struct("key", "value")), lambda p: p["value"].isNotNull())
    by = values.groupBy("qid").agg(F.map_from_entries(pairs).alias("v"))
    column = lambda e: e.column() if fallback is None else F.coalesce(e.column(), F.lit(fallback))
    return by.select("qid", *[column(e).alias(name) for name, e in expressions.items()])
