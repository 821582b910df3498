"""Model output for prompts, as a partition function; shards, resumption, and the rows that come out."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import csv_file_name, parse_table_ref
from .code import MAX_COMPLETION, execute, extracted, finalized
from .prompt import build_prompts, used_variables

#: A query for runs without a model: it counts the numbers in the last column of the first table.
STUB_QUERY = """n = 0
for cell in df1.iloc[:, -1]:
    text = str(cell).strip().strip("()").replace(".", "").replace(",", ".")
    if text and all(c.isdigit() or c == "." for c in text):
        n = n + 1
result = float(n)"""


def retry_ladder(tables: int) -> list[int]:
    """Numbers of tables to try in turn when memory runs out: all, half but 3 at least, 2, 1."""
    return list(dict.fromkeys(max(1, min(n, tables)) for n in (tables, max(3, tables // 2), 2, 1)))


def out_of_memory(error: BaseException) -> bool:
    return type(error).__name__ in ("OutOfMemoryError", "CudaOutOfMemoryError") or "out of memory" in str(error).lower()


def shard(rows: DataFrame, index: int, count: int, key: str = "id") -> DataFrame:
    """Rows whose key leaves the remainder index."""
    if not 0 <= index < count:
        raise ValueError(f"shard {index} isn't in 0 to {count - 1}")
    return rows.where(F.pmod(F.col(key), F.lit(count)) == index)


def pending(results: DataFrame, done: DataFrame | None = None, ids: set[int] | None = None, limit: int | None = None) -> DataFrame:
    """Results still to do: those asked for, without those done, the first ones by id."""
    rows = results.where(F.col("id").isin(sorted(ids))) if ids else results
    rows = rows if done is None else rows.join(done.select("id"), "id", "left_anti")
    return rows if limit is None else rows.orderBy("id").limit(limit)


def batches(rows: DataFrame, size: int) -> Iterator[DataFrame]:
    """Rows in parts of about size by a hash of the id: what is written part by part is lost part by part at most."""
    count = -(-rows.count() // size)
    for k in range(count):
        yield rows.where(F.pmod(F.xxhash64("id"), F.lit(count)) == k) if count > 1 else rows


def complete(prompts: DataFrame, start: Callable[[], Callable[[str, str], str]]) -> DataFrame:
    """(id, rung, completion, error) for prompts (id, rungs ARRAY<STRUCT<system,user>>).

    start is called once in each partition and returns the model's function from (system, user) to text. The
    first rung is tried, and the next one only when memory ran out.
    """

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = None
        for batch in batches:
            model = model or start()
            out = []
            for key, rungs in zip(batch["id"], batch["rungs"], strict=True):
                text, error, used = "", None, 0
                for used, rung in enumerate(rungs):
                    try:
                        text, error = model(rung["system"], rung["user"]), None
                        break
                    except Exception as problem:
                        text, error = "", f"{type(problem).__name__}: {problem}"
                        if not out_of_memory(problem):
                            break
                out.append((key, used, text, error))
            yield pd.DataFrame(out, columns=["id", "rung", "completion", "error"])

    return prompts.select("id", "rungs").mapInPandas(rows, f"id {prompts.schema['id'].dataType.simpleString()}, rung int, completion string, error string")


def predict(results: DataFrame, config: dict, start: Callable | None = None, stub: str | None = None, isolated: bool = True, folder: str | None = None) -> DataFrame:
    """Predictions for retrieval results; a row comes out even where generation or execution fails.

    Without start (a model) the stub query stands for every completion.
    """
    r, g, e = config["retrieval"], config["generation"], config["execution"]
    ladder = retry_ladder(r["candidates_in_prompt"]) if start else [r["candidates_in_prompt"]]
    rungs = None
    for k, n in enumerate(ladder):
        built = build_prompts(results, n, r["max_csv_chars"], g["max_prompt_chars"], folder).select("id", F.array(F.struct("system", "user", "variables")).alias(f"r{k}"))
        rungs = built if rungs is None else rungs.join(built, "id")
    prompts = rungs.select("id", F.concat(*[F.col(f"r{k}") for k in range(len(ladder))]).alias("rungs"))
    if start:
        said = complete(prompts, start)
        coded = said.withColumn("code", F.when(F.col("error").isNull(), finalized(extracted("completion"))).otherwise(F.lit("")))
    else:
        coded = prompts.select("id", F.lit(0).alias("rung"), F.lit("").alias("completion"), F.lit(None).cast("string").alias("error"), F.lit(stub or STUB_QUERY).alias("code"))
    every = F.get(F.col("rungs"), F.col("rung"))["variables"]
    used = used_variables(F.col("code"), every)
    named = coded.join(prompts, "id").withColumn("vars", F.when(F.size(used) > 0, used).otherwise(every)).join(results.select("id", "candidates"), "id")
    csv = lambda ref: F.get(F.transform(F.filter("candidates", lambda c: c["table_ref"] == ref), lambda c: c["csv_text"]), F.lit(0))
    tables = F.map_from_arrays(F.transform("vars", lambda v: v["variable"]), F.transform("vars", lambda v: csv(v["table_ref"])))
    ready = named.withColumn("tables", tables)
    ran = execute(ready.where("error is null"), timeout_s=e["timeout_s"], startup_s=e["startup_timeout_s"], isolated=isolated).select("id", "ok", "answer", "value", F.col("error").alias("run_error"))
    file = lambda v: csv_file_name(parse_table_ref(v["table_ref"])["doc_name"], parse_table_ref(v["table_ref"])["line"])
    both = ready.join(ran, "id", "left")
    return both.select(
        "id", F.col("code").alias("pandas_query"), "answer",
        F.transform("vars", lambda v: F.struct(v["variable"].alias("variable"), F.concat(F.lit("data/"), file(v)).alias("csv_path"))).alias("evidence"),
        F.transform("vars", lambda v: v["table_ref"]).alias("used_table_refs"), F.coalesce(F.col("ok") & F.col("answer").isNotNull(), F.lit(False)).alias("exec_ok"),
        F.coalesce("error", "run_error", F.when(F.col("answer").isNull(), F.concat(F.lit("result is no number: "), F.coalesce("value", F.lit("null"))))).alias("exec_error"),
        F.nullif(F.left("completion", F.lit(MAX_COMPLETION)), F.lit("")).alias("raw_completion"),
    )


def merge_shards(rows: DataFrame, order: Column) -> DataFrame:
    """One row for each id, the last by order."""
    last = rows.groupBy("id").agg(F.max_by(F.struct(*[c for c in rows.columns if c != "id"]), order).alias("_last"))
    return last.select(*[F.col("id") if c == "id" else F.col(f"_last.{c}").alias(c) for c in rows.columns])


def missing_ids(rows: DataFrame, last: int) -> DataFrame:
    """Ids 1 to last that have no row."""
    return rows.sparkSession.range(1, last + 1).select(F.col("id").cast("int").alias("id")).join(rows.select("id"), "id", "left_anti")
