"""From predictions to a checked submission."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import csv_file_name, parse_table_ref
from .code import execute

SAME_ANSWER = 1e-6
_REFS = "array<string>"


def file_of(ref: Column) -> Column:
    parsed = parse_table_ref(ref)
    return csv_file_name(parsed["doc_name"], parsed["line"])


def relevant_tables(used: Column, candidates: Column, n: int) -> Column:
    """Tables that the query used, then the candidates; distinct, in order, n at most."""
    none = F.array().cast(_REFS)
    return F.slice(F.array_distinct(F.concat(F.coalesce(used, none), F.coalesce(candidates, none))), 1, n)


def relevant_docs(refs: Column) -> Column:
    return F.array_distinct(F.transform(refs, lambda r: parse_table_ref(r)["doc_name"]))


def resolved_evidence(evidence: Column, refs: Column) -> Column:
    """(variable, table_ref) by CSV file name; names of no known table go, of one variable's entries the first stays."""
    base = lambda path: F.element_at(F.split(path, "/"), -1)
    match = lambda e: F.get(F.filter(refs, lambda r: file_of(r) == base(e["csv_path"])), F.lit(0))
    known = F.filter(F.transform(evidence, lambda e: F.struct(e["variable"].alias("variable"), match(e).alias("table_ref"))), lambda x: x["table_ref"].isNotNull())
    seen = lambda i, x: F.exists(F.slice(known, F.lit(1), i), lambda y: y["variable"] == x["variable"])
    numbered = F.transform(known, lambda x, i: F.struct(x.alias("x"), seen(i, x).alias("again")))
    return F.transform(F.filter(numbered, lambda y: ~y["again"]), lambda y: y["x"])


def assemble(questions: DataFrame, results: DataFrame, predictions: DataFrame, tables: DataFrame | None, config: dict, reexecute: bool = True, isolated: bool = True) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(items, report, assets): submission rows, re-execution remarks, and evidence files (file_name, csv_text).

    Every question has an item, by left joins. The answer of the run here goes before the earlier one; if this
    run fails the earlier one stays and is reported, and without any the fallback stands. CSV text comes from
    the candidates, or from tables (table_ref, csv_text) where theirs is empty.
    """
    n, fallback = config["retrieval"]["submission_tables"], float(config["answer"]["fallback_answer"])
    cands = results.select("id", F.transform("candidates", lambda c: F.struct(c["table_ref"].alias("table_ref"), c["csv_text"].alias("csv_text"))).alias("cands"))
    base = questions.select("id", "question").join(cands, "id", "left").join(predictions, "id", "left")
    refs = relevant_tables(F.col("used_table_refs"), F.transform("cands", lambda c: c["table_ref"]), n)
    none = F.array().cast("array<struct<variable:string,table_ref:string>>")
    named = base.withColumn("refs", refs).withColumn("known", F.array_distinct(F.concat(F.coalesce("used_table_refs", F.array().cast(_REFS)), "refs")))
    planned = named.withColumn("plan", F.coalesce(resolved_evidence(F.col("evidence"), F.col("known")), none))
    needed = F.array_distinct(F.transform("plan", lambda p: p["table_ref"]))
    wanted = planned.withColumn("needed", F.when(F.size(needed) > 0, needed).otherwise(F.slice("refs", 1, 1)))
    each = wanted.select("id", "cands", F.explode("needed").alias("table_ref"))
    own = F.get(F.transform(F.filter("cands", lambda c: (c["table_ref"] == F.col("table_ref")) & (c["csv_text"] != "")), lambda c: c["csv_text"]), F.lit(0))
    csv = each.withColumn("own", own).select("id", "table_ref", "own")
    if tables is not None:
        place = F.col("order") if "order" in tables.columns else F.lit(0)
        stored = tables.join(csv.select("table_ref").distinct(), "table_ref", "left_semi").groupBy("table_ref").agg(F.min_by("csv_text", place).alias("stored"))
        csv = csv.join(stored, "table_ref", "left").select("id", "table_ref", F.coalesce("own", F.nullif("stored", F.lit(""))).alias("own"))
    written = csv.where("own is not null").groupBy("id").agg(F.map_from_entries(F.collect_list(F.struct("table_ref", "own"))).alias("written"))
    ready = wanted.join(written, "id", "left").withColumn("written", F.coalesce("written", F.create_map().cast("map<string,string>")))
    shown = ready.withColumn("shown", F.filter("plan", lambda p: F.map_contains_key("written", p["table_ref"])))
    shown = shown.withColumn("query", F.coalesce("pandas_query", F.lit(""))).withColumn("runs", F.lit(reexecute) & (F.col("query") != "") & (F.size("shown") > 0))
    jobs = shown.where("runs").select("id", F.col("query").alias("code"), F.map_from_arrays(F.transform("shown", lambda p: p["variable"]), F.transform("shown", lambda p: F.col("written")[p["table_ref"]])).alias("tables"))
    e = config["execution"]
    ran = execute(jobs, True, e["timeout_s"], e["startup_timeout_s"], isolated).select("id", F.when(F.col("ok"), F.col("answer")).alias("local"), F.col("error").alias("run_error"), "alt_answer", "alt_error")
    judged = shown.join(ran, "id", "left").withColumns({
        "failed": F.col("runs") & F.col("local").isNull(),
        "fragile": F.col("local").isNotNull() & (F.col("alt_error").isNotNull() | F.col("alt_answer").isNull() | (F.abs(F.col("alt_answer") - F.col("local")) > SAME_ANSWER)),
        "changed": F.coalesce(F.abs(F.col("local") - F.col("answer")) > SAME_ANSWER, F.lit(False)),
        "skipped": F.lit(reexecute) & ~F.col("runs") & F.col("answer").isNotNull(),
    })
    path = lambda ref: F.concat(F.lit("data/"), file_of(ref))
    evidence = F.transform("shown", lambda p: F.struct(p["variable"].alias("variable"), path(p["table_ref"]).alias("csv_path")))
    first = F.get(F.filter("needed", lambda r: F.map_contains_key("written", r)), F.lit(0))
    instead = F.when(first.isNotNull(), F.array(F.struct(F.lit("df1").alias("variable"), path(first).alias("csv_path")))).otherwise(F.array().cast("array<struct<variable:string,csv_path:string>>"))
    items = judged.select(
        "id", "question", F.coalesce("local", "answer", F.lit(fallback)).alias("answer"), relevant_docs(F.col("refs")).alias("relevant_docs"), F.col("refs").alias("relevant_tables"),
        F.when(F.size(evidence) > 0, evidence).otherwise(instead).alias("evidence"), F.col("query").alias("pandas_query"),
    )
    remark = lambda flag, status, detail: F.when(F.col(flag), F.struct(F.lit(status).alias("status"), detail.cast("string").alias("detail")))
    remarks = F.array_compact(F.array(
        remark("failed", "failed", F.coalesce("run_error", F.lit("no number"))), remark("fragile", "fragile_to_default_reader", F.coalesce("alt_error", F.col("alt_answer").cast("string"), F.lit(""))),
        remark("changed", "mismatch_fixed", F.col("answer")), remark("skipped", "skipped", F.when(F.col("query") == "", F.lit("no query")).otherwise(F.lit("no table"))),
    ))
    report = judged.select("id", F.explode(remarks).alias("r"), "answer", "local").select("id", "r.status", F.col("answer").alias("earlier"), "local", "r.detail")
    assets = judged.select(F.explode("written").alias("table_ref", "csv_text")).dropDuplicates(["table_ref"]).select(file_of(F.col("table_ref")).alias("file_name"), "csv_text")
    return items, report, assets


def assembly_stats(items: DataFrame, report: DataFrame, assets: DataFrame) -> DataFrame:
    """One row of counts."""
    by = report.agg(*[F.count_if(F.col("status") == s).alias(s) for s in ("failed", "fragile_to_default_reader", "mismatch_fixed", "skipped")])
    of = items.agg(F.count("*").alias("items"), F.count_if(F.col("pandas_query") == "").alias("empty_query"))
    parts = [of, by, assets.agg(F.count("*").alias("csv_files"))]
    every = reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), parts)
    return every.agg(*[F.max(c).alias(c) for part in parts for c in part.columns])


def repeated_variables(evidence: Column) -> Column:
    """How many entries name a variable that an earlier entry has: those that resolved_evidence leaves out."""
    return F.size(evidence) - F.size(F.array_distinct(F.transform(evidence, lambda e: e["variable"])))


def validate(items: DataFrame, expected: DataFrame | None = None, files: DataFrame | None = None) -> DataFrame:
    """(id, rule, detail) for everything wrong with a submission; no rows if it is valid.

    expected: ids that must be there, and no others; files: csv_path of the files that exist.
    """
    word = "^[A-Za-z_][A-Za-z0-9_]*$"
    row = lambda bad, rule, detail: F.when(F.coalesce(bad, F.lit(True)), F.struct(F.lit(rule).alias("rule"), detail.cast("string").alias("detail")))
    refs, ev = F.col("relevant_tables"), F.col("evidence")
    bad_refs = F.filter(refs, lambda r: ~r.rlike("^.+\\|\\d+$"))
    docs = F.array_except(F.array_distinct(F.transform(F.filter(refs, lambda r: r.contains("|")), lambda r: F.regexp_replace(r, "\\|[^|]*$", ""))), F.col("relevant_docs"))
    names = F.transform(ev, lambda e: e["variable"])
    bad_names = F.filter(names, lambda v: ~F.coalesce(v.rlike(word), F.lit(False)))
    outside = F.filter(ev, lambda e: ~F.coalesce(e["csv_path"].startswith("data/") & ~F.array_contains(F.split(e["csv_path"], "/"), ".."), F.lit(False)))
    checks = F.array_compact(F.array(
        row(F.col("id").isNull(), "id", F.lit("missing")), row(F.coalesce("question", F.lit("")) == "", "question", F.lit("empty")), row(F.col("answer").isNull() | F.isnan("answer"), "answer", F.lit("no number")),
        row(F.col("pandas_query").isNull(), "pandas_query", F.lit("missing")), row(F.size(bad_refs) > 0, "table_ref", F.array_join(bad_refs, ", ")), row(F.size(docs) > 0, "relevant_docs", F.array_join(docs, ", ")),
        row(F.size(bad_names) > 0, "variable", F.array_join(bad_names, ", ")), row(F.size(names) != F.size(F.array_distinct(names)), "variable_twice", F.array_join(names, ", ")),
        row(F.size(outside) > 0, "csv_path", F.array_join(F.transform(outside, lambda e: e["csv_path"]), ", ")),
    ))
    parts = [items.select("id", F.explode(checks).alias("c")).select("id", "c.rule", "c.detail")]
    parts.append(items.groupBy("id").count().where("count > 1 and id is not null").select("id", F.lit("id_twice").alias("rule"), F.col("count").cast("string").alias("detail")))
    if expected is not None:
        parts.append(expected.select("id").join(items.select("id"), "id", "left_anti").select("id", F.lit("id_missing").alias("rule"), F.lit("").alias("detail")))
        parts.append(items.select("id").join(expected.select("id"), "id", "left_anti").select("id", F.lit("id_unknown").alias("rule"), F.lit("").alias("detail")))
    if files is not None:
        asked = items.select("id", F.explode("evidence.csv_path").alias("csv_path"))
        parts.append(asked.join(files.select("csv_path"), "csv_path", "left_anti").select("id", F.lit("file_missing").alias("rule"), F.col("csv_path").alias("detail")))
    return reduce(DataFrame.unionByName, parts)


def orphan_files(items: DataFrame, files: DataFrame) -> DataFrame:
    """Files that no evidence names: worth a warning, no error."""
    return files.join(items.select(F.explode("evidence.csv_path").alias("csv_path")), "csv_path", "left_anti")
