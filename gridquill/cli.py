"""Command line: python -m gridquill.cli STEP [options]. Steps: extract, retrieve, probe, generate, assemble, zip.

--predictions takes several places, divided by commas: the shards of one run, later ones going before earlier ones.
"""

from __future__ import annotations

import argparse
import json
import logging
from pathlib import Path

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .config import extraction_key, load_config, paths
from .operators import assembly, generation, headers, markup, probe, ranking, search
from .session import session, workers_see_package
from .sources import documents, files
from .sources.cache import TableCache

#: Questions that one run of predictions holds: what a failure can cost.
BATCH_QUESTIONS = 1_000


def extract(a, spark) -> dict:
    """Documents to tables and index entries; unchanged documents aren't read again without --rebuild."""
    config, where = load_config(a.config), paths()
    root, cache, index = a.statements_dir or f"{where['data']}/financial_statements", a.cache_dir or f"{where['interim']}/tables", a.index_path or f"{where['interim']}/tables_index"
    cache = f"{cache}/{extraction_key(config)}"
    listed = documents.list_documents(spark, root)
    if a.limit_docs:
        listed = documents.sorted_documents(listed).limit(a.limit_docs)
    base, r = config["extraction"]["table_ref_line_base"], config["retrieval"]
    kept = TableCache(spark, cache)
    kept.update(listed, lambda docs: headers.split_header(markup.extract_tables(docs, base)), root, a.rebuild)
    tables = kept.tables(listed)
    companies = files.read_companies(spark, a.company_meta) if a.company_meta else None
    chosen = tables.where(headers.eligible(F.col("grid"), r["min_table_cells"], r["require_numeric"]))
    headers.index_entries(chosen, companies).write.mode("overwrite").parquet(index)
    return extraction_stats(tables, chosen, base).first().asDict()


def extraction_stats(tables, chosen, line_base: int):
    """Counts over extracted tables in one aggregation."""
    flags = tables.join(chosen.select("doc_name", "order", F.lit(True).alias("chosen")), ["doc_name", "order"], "left")
    return flags.agg(
        F.countDistinct("doc_name").alias("documents"), F.count("*").alias("tables"), F.count_if(~F.col("closed")).alias("unclosed"), F.count_if(F.size("grid") == 0).alias("empty"),
        F.count_if(F.coalesce("chosen", F.lit(False))).alias("indexed"), F.count_if(F.col("page").isNull()).alias("without_page"), F.count_if(F.col("context_before") == "").alias("without_context"),
        F.count_if(F.size(headers.duplicate_positions(F.col("header"))) > 0).alias("with_double_names"), F.sum(F.size("rows")).alias("rows"),
        F.sum(headers.n_cols(F.col("header"), F.col("rows"))).alias("columns"), F.countDistinct("ticker").alias("tickers"), F.lit(line_base).alias("line_base"),
    )


def retrieve(a, spark) -> dict:
    config, where = load_config(a.config), paths()
    questions = files.read_questions(spark, a.questions or f"{where['data']}/questions.jsonl")
    if a.ids:
        questions = questions.where(F.col("id").isin([int(x) for x in a.ids.split(",")]))
    if a.limit:
        questions = questions.orderBy("id").limit(a.limit)
    entries = spark.read.parquet(a.index_path or f"{where['interim']}/tables_index")
    tables = TableCache(spark, f"{a.tables_cache_dir or where['interim'] + '/tables'}/{extraction_key(config)}").tables()
    tables = tables.withColumn("csv_text", headers.table_csv(F.col("header"), F.col("rows"), config["retrieval"]["max_csv_chars"]))
    index = search.stored_index(entries, a.bm25_cache_dir or f"{where['interim']}/bm25", rebuild=a.rebuild_index)
    results = ranking.retrieve(questions, files.read_companies(spark, a.company_meta), entries, tables, config, index)
    out = a.out or f"{where['interim']}/retrieval_results"
    files.write_json(results, out)
    return ranking.retrieval_stats(files.read_retrieval(spark, out)).first().asDict()


def run_probe(a, spark) -> dict:
    from .operators.intent import question_intent

    results = files.read_retrieval(spark, a.retrieval or f"{paths()['interim']}/retrieval_results")
    companies = files.read_companies(spark, a.company_meta)
    told = question_intent(results.select("id", "question"), companies).select("id", "ticker_in_parens")
    rows = results.join(told, "id").cache()
    out = probe.report(rows).first().asDict() | {"hit_rate": probe.hit_rates(rows).first().asDict(), "parser": {r.outcome: r.n for r in probe.parser_agreement(results.select("id", "question"), companies).collect()}}
    scores = rows.where(F.size("candidates") > 0).select(F.get("candidates", F.lit(0))["score"].alias("score"))
    out["top1_score"] = {k: v for k, v in probe.percentiles(scores, [], "score").first().asDict().items()} if scores.limit(1).count() else {}
    out["wrong_top5"] = {r.ticker: r.n for r in probe.wrong_tickers(rows).orderBy(F.desc("n"), "ticker").limit(20).collect()}
    if a.show:
        probe.examples(rows, a.show).show(a.show, truncate=160, vertical=True)
    if a.out:
        Path(a.out).write_text(json.dumps(out, ensure_ascii=False, indent=2), encoding="utf-8")
    return out


def generate(a, spark) -> dict:
    """Without a model in this package, completions come from the stub query; a model is passed to generation.predict()."""
    config, where = load_config(a.config), paths()
    results = files.read_retrieval(spark, a.retrieval or f"{where['interim']}/retrieval_results")
    out = a.out or f"{where['out']}/predictions"
    if a.shard:
        index, count = map(int, a.shard.split("/"))
        results = generation.shard(results, index, count)
    done = None if a.no_resume else files.existing_ids(spark, out)
    todo = generation.pending(results, done, {int(x) for x in a.ids.split(",")} if a.ids else None, a.limit)
    if not (a.dry_run or a.stub_query):
        raise SystemExit("no model here: pass --dry-run or --stub-query, or call gridquill.operators.generation.predict with a model")
    for part in generation.batches(todo, BATCH_QUESTIONS):
        files.append_predictions(generation.predict(part, config, stub=a.stub_query), out)
    return files.read_predictions(spark, out).agg(F.count("*").alias("predictions"), F.count_if("exec_ok").alias("exec_ok")).first().asDict()


def assemble(a, spark) -> dict:
    config, where = load_config(a.config), paths()
    questions = files.read_questions(spark, a.questions or f"{where['data']}/questions.jsonl")
    results = files.read_retrieval(spark, a.retrieval or f"{where['interim']}/retrieval_results")
    predictions = files.read_predictions(spark, (a.predictions or f"{where['out']}/predictions").split(","))
    stored = TableCache(spark, f"{a.tables_cache_dir or where['interim'] + '/tables'}/{extraction_key(config)}")
    tables = stored.tables().select("table_ref", "order", headers.table_csv(F.col("header"), F.col("rows")).alias("csv_text")) if stored.runs() else None
    made = [df.cache() for df in assembly.assemble(questions, results, predictions, tables, config, not a.no_reexecute)]
    stats = assembly.assembly_stats(*made).first().asDict() | {"validation_errors": assembly.validate(made[0], questions).count()}
    files.write_submission(made[0], made[2], a.build_dir or f"{where['out']}/submission", stats, made[1])
    return stats


def archive(a, spark) -> dict:
    where = paths()
    folder = a.build_dir or f"{where['out']}/submission"
    from .schema import SUBMISSION

    items = spark.read.schema(SUBMISSION).option("multiLine", True).json(f"{folder}/submission.json")
    names = spark.createDataFrame([(f"data/{p.name}",) for p in Path(folder, "data").glob("*.csv")], "csv_path string")
    expected = files.read_questions(spark, a.questions) if a.questions else None
    errors = [f"id={r.id} {r.rule} {r.detail}" for r in assembly.validate(items, expected, names).toLocalIterator()]
    errors += [f"id=None extra_json {name}" for name in files.extra_json(folder)]
    if a.check_only:
        return {"errors": errors}
    return {"zip": files.zip_submission(folder, a.zip_path or f"{where['out']}/submission.zip", errors)}


STEPS = {
    "extract": (extract, "--statements-dir --cache-dir --index-path --company-meta --config --rebuild! --limit-docs#"),
    "retrieve": (retrieve, "--questions --index-path --bm25-cache-dir --tables-cache-dir --company-meta --out --config --limit# --ids --rebuild-index!"),
    "probe": (run_probe, "--retrieval --company-meta --show# --out"),
    "generate": (generate, "--retrieval --out --config --limit# --ids --no-resume! --dry-run! --stub-query --shard"),
    "assemble": (assemble, "--questions --retrieval --predictions --tables-cache-dir --build-dir --config --no-reexecute!"),
    "zip": (archive, "--build-dir --zip-path --questions --check-only!"),
}


def parser() -> argparse.ArgumentParser:
    """Options end in # if they take a whole number, in ! if they are flags."""
    top = argparse.ArgumentParser(prog="gridquill", description=__doc__)
    steps = top.add_subparsers(dest="step", required=True)
    for name, (_, options) in STEPS.items():
        sub = steps.add_parser(name)
        for option in (*options.split(), "--log-level"):
            how = {"action": "store_true"} if option.endswith("!") else {"type": int, "default": None} if option.endswith("#") else {"default": None}
            sub.add_argument(option.rstrip("#!"), **how)
    return top


def main(argv: list[str] | None = None) -> int:
    a = parser().parse_args(argv)
    logging.basicConfig(level=a.log_level or "INFO")
    print(json.dumps(STEPS[a.step][0](a, workers_see_package(session())), ensure_ascii=False, indent=2, default=str))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
