"""Readers and writers of the interchange files: CSV, JSON lines, the submission and its archive."""

from __future__ import annotations

import json
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schema
from ..operators.generation import merge_shards
from . import hadoop

#: Columns of the company file.
TICKER_COLUMN, NAME_COLUMN = "Mã CK", "Tên công ty"


def read_companies(spark: SparkSession, path: str) -> DataFrame:
    """(ticker, name): capitals, blank tickers left out, of one ticker's rows the last in the file."""
    rows = spark.read.option("header", True).option("encoding", "UTF-8").csv(path)
    rows = rows.toDF(*[c.lstrip("﻿") for c in rows.columns])
    clean = rows.select(F.upper(F.trim(F.coalesce(F.col(f"`{TICKER_COLUMN}`"), F.lit("")))).alias("ticker"), F.trim(F.coalesce(F.col(f"`{NAME_COLUMN}`"), F.lit(""))).alias("name"), F.monotonically_increasing_id().alias("_n"))
    return clean.where("ticker <> ''").groupBy("ticker").agg(F.max_by("name", "_n").alias("name"))


def read_questions(spark: SparkSession, path: str) -> DataFrame:
    """(id, question) in order of id; blank lines are skipped, a broken line is an error."""
    return spark.read.schema(schema.QUESTIONS).option("mode", "FAILFAST").json(path).orderBy("id")


def read_retrieval(spark: SparkSession, path: str) -> DataFrame:
    """Retrieval results; a line that doesn't fit the schema, or has more than it, is an error."""
    return read_strict(spark, path, schema.RETRIEVAL)


def _unknown(text: Column, kind: T.StructType) -> Column:
    """Names in a JSON object, and in the objects of its arrays, that its type doesn't have."""
    own = F.array_except(F.json_object_keys(text), F.array(*map(F.lit, kind.names)))
    for field in kind.fields:
        if isinstance(field.dataType, T.ArrayType) and isinstance(field.dataType.elementType, T.StructType):
            inner = F.from_json(text, T.StructType([T.StructField(field.name, T.ArrayType(T.StringType()))]))[field.name]
            element = field.dataType.elementType
            below = F.flatten(F.transform(inner, lambda x: _unknown(x, element)))  # noqa: B023
            own = F.concat(own, F.coalesce(below, F.array().cast("array<string>")))
    return own


def read_strict(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    """JSON lines of exactly these fields: broken lines and unknown fields, nested ones too, are errors."""
    lines = spark.read.text(path).where(F.trim("value") != "")
    kind = T.StructType.fromDDL(ddl)
    parsed = lines.select(F.from_json("value", kind, {"mode": "FAILFAST"}).alias("r"), _unknown(F.col("value"), kind).alias("unknown"))
    checked = F.when(F.size("unknown") > 0, F.raise_error(F.concat(F.lit("unknown field: "), F.array_join("unknown", ", "))).cast("boolean")).otherwise(F.lit(True))
    return parsed.where(checked).select("r.*")


def read_predictions(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Predictions; broken lines are skipped, and of one id's lines the last counts.

    Later is what a later path of several has, then a later run of append_predictions, then, in files from
    elsewhere, the file that was changed later, and the later line of a file.
    """
    paths, parts = [path] if isinstance(path, str) else path, None
    for k, own in enumerate(paths):
        rows = spark.read.schema(schema.PREDICTIONS + ", _corrupt_record string").option("columnNameOfCorruptRecord", "_corrupt_record").option("mode", "PERMISSIVE").json(own)
        run = F.col("run").cast("long") if "run" in rows.columns else F.lit(-1).cast("long")
        place = F.struct(F.lit(k).alias("path"), run.alias("run"), "_metadata.file_modification_time", "_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id().alias("line"))
        good = rows.select("*", place.alias("_place")).where(F.col("_corrupt_record").isNull() & F.col("id").isNotNull())
        good = good.drop("_corrupt_record", "run")
        parts = good if parts is None else parts.unionByName(good)
    return merge_shards(parts, F.col("_place")).drop("_place")


def existing_ids(spark: SparkSession, path: str) -> DataFrame:
    """Ids that predictions already have, broken lines ignored; none if there are no files."""
    if not hadoop.exists(spark, path):
        return spark.createDataFrame([], "id int")
    return spark.read.schema("id int").option("mode", "DROPMALFORMED").json(path).where("id is not null").select("id").distinct()


def read_csv_text(spark: SparkSession, path: str) -> DataFrame:
    """Every cell as text, none missing: an empty field is an empty string."""
    return spark.read.option("header", True).option("inferSchema", False).option("multiLine", True).option("escape", '"').csv(path).na.fill("")


def read_csv_inferred(spark: SparkSession, path: str) -> DataFrame:
    """Types inferred, empty fields null: the other reading of the same file."""
    return spark.read.option("header", True).option("inferSchema", True).option("multiLine", True).option("escape", '"').csv(path)


def load_table(tables: DataFrame, doc_name: str, line: int) -> DataFrame:
    """One table by key, the first by order where a line opens several."""
    return tables.where((F.col("doc_name") == doc_name) & (F.col("line") == line)).orderBy("order").limit(1)


def write_json(rows: DataFrame, path: str, single: bool = False) -> None:
    (rows.coalesce(1) if single else rows).write.mode("overwrite").option("ignoreNullFields", False).json(path)


def append_predictions(rows: DataFrame, path: str) -> int:
    """Durable append, as the next run number below path; a reader sees a run whole or not at all."""
    number = max(hadoop.numbered(rows.sparkSession, path), default=0) + 1
    rows.write.mode("overwrite").option("ignoreNullFields", False).json(f"{path}/run={number}")
    return number


def write_submission(items: DataFrame, assets: DataFrame, folder: str, stats: dict | None = None, report: DataFrame | None = None) -> None:
    """submission.json, and the evidence CSVs in data/ (stale ones are removed first).

    A submission is one file by contract, made for a few thousand questions, so it is written by the driver.
    """
    root = Path(folder)
    (root / "data").mkdir(parents=True, exist_ok=True)
    for stale in (root / "data").glob("*.csv"):
        stale.unlink()
    for row in assets.toLocalIterator():
        (root / "data" / row["file_name"]).write_text(row["csv_text"], encoding="utf-8")
    rows = [r.asDict(recursive=True) for r in items.orderBy("id").toLocalIterator()]
    (root / "submission.json").write_text(json.dumps(rows, ensure_ascii=False, indent=1), encoding="utf-8")
    for name, value in (("assemble_stats.json", stats), ("reexec_report.json", None if report is None else [r.asDict() for r in report.toLocalIterator()])):
        if value is not None:
            (root / name).write_text(json.dumps(value, ensure_ascii=False, indent=2), encoding="utf-8")


#: What write_submission puts beside submission.json.
REPORTS = ("assemble_stats.json", "reexec_report.json")


def extra_json(folder: str) -> list[str]:
    """JSON files of a submission's folder besides submission.json and this package's own reports: an error by contract."""
    found = sorted(p.relative_to(folder).as_posix() for p in Path(folder).rglob("*.json"))
    return [name for name in found if name not in ("submission.json", *REPORTS)]


def zip_submission(folder: str, target: str, errors: list[str] = ()) -> str:
    """submission.json and data/*.csv at the archive's root; refuses a folder with errors."""
    if errors:
        raise InvalidSubmission(list(errors))
    out = Path(target)
    out.parent.mkdir(parents=True, exist_ok=True)
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as archive:
        archive.write(Path(folder) / "submission.json", "submission.json")
        for path in sorted((Path(folder) / "data").glob("*.csv")):
            archive.write(path, f"data/{path.name}")
    return str(out)


class InvalidSubmission(Exception):
    """Names the first five of its errors."""

    def __init__(self, errors: list[str]):
        super().__init__(f"{len(errors)} errors: " + "; ".join(errors[:5]))
        self.errors = errors
