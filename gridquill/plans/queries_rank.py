"""Queries on search, intent, ranking, prompts, assembly and quality reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import assembly, generation, headers, markup, probe, ranking, search
from ..operators.intent import question_intent, years_of
from ..sources import documents, files, hadoop
from ..sources.cache import TableCache
from ..streaming.incremental import read_runs, run_new_files
from .rendered import read


def bm25_terms(spark, sf_dir):
    """Document frequency of every term of all documents."""
    return search.term_frequencies(read(spark, sf_dir, "documents"), "text")


def bm25_topk(spark, sf_dir):
    """The ten best documents for each benchmark item."""
    items = read(spark, sf_dir, "benchmark")
    index = search.build_index(read(spark, sf_dir, "documents"), "doc_id", "text", asked=items.select("text"))
    hits = search.search(index, items, 10, "item_id", "text")
    return hits.select(F.col("qid").alias("item_id"), F.col("id").alias("doc_id"), F.round("score", 6).alias("score"), "rank")


def _companies(spark, sf_dir):
    """A dimension made of nations: ticker N00, name with a legal form."""
    n = read(spark, sf_dir, "nation")
    return n.select(F.concat(F.lit("N"), F.lpad(F.col("n_nationkey").cast("string"), 2, "0")).alias("ticker"), F.concat(F.lit("CTCP Quốc gia "), F.translate("n_name", "_0123456789", " abcdefghij")).alias("name"))


def _questions(spark, sf_dir):
    """A question for every customer: by name of its nation, by code in parentheses, or by bare code, with a year and a kind."""
    c = read(spark, sf_dir, "customer").join(read(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    code = F.concat(F.lit("N"), F.lpad(F.col("n_nationkey").cast("string"), 2, "0"))
    name = F.concat(F.lit("Quốc gia "), F.translate("n_name", "_0123456789", " abcdefghij"))
    kind = F.when(F.col("c_custkey") % 4 == 0, F.lit(" báo cáo hợp nhất")).when(F.col("c_custkey") % 4 == 1, F.lit(" công ty mẹ")).otherwise(F.lit(""))
    who = F.when(F.col("c_custkey") % 3 == 0, name).when(F.col("c_custkey") % 3 == 1, F.concat(F.lit("khách ("), F.lower(code), F.lit(")"))).otherwise(code)
    text = F.concat(F.lit("Số dư của "), who, F.lit(" năm "), (2010 + F.col("c_custkey") % 10).cast("string"), F.lit(" và 2019"), kind, F.lit(" là bao nhiêu triệu đồng?"))
    return c.select(F.col("c_custkey").cast("int").alias("id"), text.alias("question"))


def intent_parsing(spark, sf_dir):
    q = question_intent(_questions(spark, sf_dir), _companies(spark, sf_dir))
    return q.select("id", F.array_join("tickers", ",").alias("tickers"), F.array_join(F.transform("years", lambda y: y.cast("string")), ",").alias("years"), "scope", F.array_join("ticker_in_parens", ",").alias("parens"))


def intent_years(spark, sf_dir):
    """Years in range in a text made of order dates and numbers."""
    o = read(spark, sf_dir, "orders")
    text = F.concat((F.year("o_orderdate") + 20).cast("string"), F.lit("-"), (F.year("o_orderdate") + 24).cast("string"), F.lit(" x"), F.col("o_orderkey").cast("string"), F.lit(" 12019 1999"))
    return o.select("o_orderkey", F.array_join(F.transform(years_of(text), lambda y: y.cast("string")), ",").alias("years"))


def _hits(spark, sf_dir):
    """Hits made of orders: a question for every 50th customer, ranked by price, with what it asks for."""
    from pyspark.sql import Window as W

    o = read(spark, sf_dir, "orders").withColumn("qid", (F.col("o_custkey") % 50).cast("int"))
    rank = (F.row_number().over(W.partitionBy("qid").orderBy(F.desc("o_totalprice"), "o_orderkey")) - 1).cast("int")
    return o.select(
        "qid", rank.alias("rank"), F.concat(F.lit("d|"), F.col("o_orderkey").cast("string")).alias("table_ref"), F.col("o_orderstatus").alias("ticker"),
        F.when(F.col("o_orderkey") % 7 != 0, F.year("o_orderdate") + 20).alias("year"), F.when(F.col("o_orderkey") % 3 == 0, F.lit("separate")).when(F.col("o_orderkey") % 3 == 1, F.lit("consolidated")).alias("scope"),
        F.when(F.col("qid") % 2 == 0, F.array(F.lit("F"))).otherwise(F.array().cast("array<string>")).alias("asked_tickers"), F.array(F.lit(2017)).alias("asked_years"),
        F.when(F.col("qid") % 3 == 0, F.lit("separate")).alias("asked_scope"),
    )


def tiered_select(spark, sf_dir):
    chosen = ranking.select_candidates(ranking.annotate(_hits(spark, sf_dir)), 20, 2)
    return chosen.select("qid", "pos", "table_ref", F.array_join("reasons", ",").alias("reasons"))


def last_wins(spark, sf_dir):
    """The last event of each user and type."""
    e = ranking.last_by(read(spark, sf_dir, "events"), ["user_id", "event_type"], "event_id")
    return e.select("user_id", "event_type", "event_id", "value")


def resume_and_shard(spark, sf_dir):
    """Orders of one shard of four that no finished order is done with."""
    o = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), "o_orderstatus")
    return generation.pending(generation.shard(o, 1, 4), o.where("o_orderstatus = 'F'")).select("id")


def missing_orders(spark, sf_dir):
    """Keys up to the number of orders that lineitem has no row of."""
    o = read(spark, sf_dir, "orders")
    done = read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("id")).distinct()
    return generation.missing_ids(done, o.count())


def prompt_budget(spark, sf_dir):
    """By source, how many first documents' texts fit into 20 000 characters, one at least.

    Sums by range of ids say in which range the budget ends; only ranges that begin inside it are summed up row by row.
    """
    from pyspark.sql import Window as W

    d = read(spark, sf_dir, "documents").select("source", "doc_id", F.length("text").alias("size"), F.expr("doc_id div 1024").alias("range"))
    sums = d.groupBy("source", "range").agg(F.sum("size").alias("size"))
    begins = sums.select("source", "range", (F.sum("size").over(W.partitionBy("source").orderBy("range")) - F.col("size")).alias("before")).where("before <= 20000")
    upto = d.join(begins, ["source", "range"]).withColumn("upto", F.col("before") + F.sum("size").over(W.partitionBy("source", "range").orderBy("doc_id").rowsBetween(W.unboundedPreceding, 0)))
    return upto.groupBy("source").agg(F.greatest(F.count_if(F.col("upto") <= 20000), F.lit(1)).alias("fit"))


def score_percentiles(spark, sf_dir):
    """Percentiles of account balances by segment, by the rule of the reports."""
    return probe.percentiles(read(spark, sf_dir, "customer"), ["c_mktsegment"], "c_acctbal")


def hit_rate(spark, sf_dir):
    """Does a document of the item's language lead the search? Languages stand for codes here."""
    d = read(spark, sf_dir, "documents")
    items = read(spark, sf_dir, "benchmark")
    index = search.build_index(d, "doc_id", "text", asked=items.select("text"))
    hits = search.search(index, items, 10, "item_id", "text").join(d.select(F.col("doc_id").alias("id"), F.col("lang").alias("ticker")), "id")
    nested = hits.groupBy("qid").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "ticker"))), lambda c: F.struct(c["ticker"].alias("ticker"))).alias("candidates"))
    asked = nested.withColumn("ticker_in_parens", F.array(F.lit("en")))
    return probe.hit_rates(asked).select("questions", *[F.round(f"top{k}", 6).alias(f"top{k}") for k in (1, 3, 5, 10)])


def relevant_tables(spark, sf_dir):
    """Parts of each order as table references: those with a return first, then all, five at most, distinct in order."""
    l = read(spark, sf_dir, "lineitem")  # noqa: E741
    ref = F.concat(F.lit("p|"), F.col("l_partkey").cast("string"))
    by = l.groupBy("l_orderkey").agg(
        F.transform(F.array_sort(F.collect_list(F.when(F.col("l_returnflag") == "R", F.struct("l_linenumber", "l_partkey")))), lambda x: F.concat(F.lit("p|"), x["l_partkey"].cast("string"))).alias("used"),
        F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", ref.alias("r")))), lambda x: x["r"]).alias("cands"),
    )
    return by.select("l_orderkey", F.array_join(assembly.relevant_tables(F.col("used"), F.col("cands"), 5), ",").alias("tables"))


def validate_ids(spark, sf_dir):
    """A submission made of orders with faults by key, held against the customers' ids."""
    o = read(spark, sf_dir, "orders").where(F.col("o_orderkey") % 11 != 0)
    ref = F.when(F.col("o_orderkey") % 13 == 0, F.lit("no-bar")).otherwise(F.concat(F.lit("d|"), F.col("o_orderkey").cast("string")))
    items = o.select(
        (F.col("o_orderkey") - F.when(F.col("o_orderkey") % 100 == 1, 1).otherwise(0)).cast("int").alias("id"), F.when(F.col("o_orderkey") % 17 == 0, F.lit("")).otherwise(F.lit("q")).alias("question"), F.col("o_totalprice").alias("answer"),
        F.array(F.when(F.col("o_orderkey") % 19 == 0, F.lit("e")).otherwise(F.lit("d"))).alias("relevant_docs"), F.array(ref).alias("relevant_tables"),
        F.array(F.struct(F.when(F.col("o_orderkey") % 23 == 0, F.lit("1x")).otherwise(F.lit("df1")).alias("variable"), F.when(F.col("o_orderkey") % 29 == 0, F.lit("../x.csv")).otherwise(F.lit("data/x.csv")).alias("csv_path"))).alias("evidence"),
        F.lit("result = 1").alias("pandas_query"),
    )
    expected = read(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("int").alias("id"))
    return assembly.validate(items, expected).groupBy("rule").agg(F.count("*").alias("n"))


def incremental_events(spark, sf_dir):
    """Events read as a stream of new files, twice: the second run finds nothing new."""
    root = hadoop.shared_folder(spark, "events")
    ddl = "event_id long, ts timestamp, user_id long, event_type string, value double, props string"
    for _ in range(2):
        run_new_files(spark, sf_dir, ddl, f"{root}/out", f"{root}/log", lambda d: d.select("event_id", "event_type", "value"), glob="events.parquet")
    return read_runs(spark, f"{root}/out").groupBy("event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("total"))


def incremental_extraction(spark, sf_dir):
    """Tables of a tree with one report for each nation, all of one company for each region, after a second run: reports of
    every fifth nation were edited in between and those of every seventh removed. read is how many reports the second run read."""
    root, nations = hadoop.shared_folder(spark, "reports"), [r.asDict() for r in read(spark, sf_dir, "nation").collect()]

    def put(n, note):
        name = f"R{n['n_regionkey']}_{n['n_name']}_2020_separate"
        path = f"{root}/fs/R{n['n_regionkey']}/2020/{name}/{name}_extracted.txt"
        if note is None:
            hadoop.delete(spark, path)
        else:
            hadoop.write_text(spark, path, f"===== PAGE 1 =====\nĐơn vị: VND\n<table><tr><td>{n['n_name']}</td><td>{note}</td></tr></table>\n")

    cache, sizes = TableCache(spark, f"{root}/cache"), []

    def extract(docs):
        sizes.append(docs.count())
        return headers.split_header(markup.extract_tables(docs))

    for round_of in (lambda k: "first", lambda k: None if k % 7 == 3 else "second, longer" if k % 5 == 0 else ""):
        for n in nations:
            if (note := round_of(n["n_nationkey"])) != "":
                put(n, note)
        listed = documents.list_documents(spark, f"{root}/fs")
        cache.update(listed, extract, f"{root}/fs")
    cell = F.col("grid")[0]
    return cache.tables(listed).select("doc_name", "ticker", "year", "scope", "line", "page", "table_ref", cell[0].alias("name"), cell[1].alias("note"), F.lit(sizes[-1]).alias("read"))


def appended_predictions(spark, sf_dir):
    """Predictions for orders in three appends of several files each: of one id's the last append counts."""
    path, o = hadoop.shared_folder(spark, "predictions"), read(spark, sf_dir, "orders")
    for n in range(3):
        rows = o.where(F.col("o_orderkey") % 3 >= n).select(
            F.col("o_orderkey").cast("int").alias("id"), F.lit("result = 1").alias("pandas_query"), F.lit(float(n)).alias("answer"), F.lit(True).alias("exec_ok"),
        )
        files.append_predictions(rows.repartition(4), path)
    done = files.existing_ids(spark, path).withColumn("known", F.lit(True))
    return files.read_predictions(spark, path).join(done, "id").select("id", "answer", "exec_ok", "known")


QUERIES = {
    f.__name__: f
    for f in (
        incremental_extraction, appended_predictions, bm25_terms, bm25_topk, intent_parsing, intent_years, tiered_select, last_wins, resume_and_shard, missing_orders, prompt_budget, score_percentiles, hit_rate, relevant_tables, validate_ids, incremental_events,
    )
}

_TOKENS = "SELECT doc_id, regexp_extract_all(replace(lower(text), 'ß', 'ss'), '[\\p{L}\\p{N}]+') AS t FROM documents"
_BM25 = f"""WITH d AS MATERIALIZED ({_TOKENS}), s AS (SELECT count(*)::DOUBLE AS n, avg(len(t)) AS avgdl FROM d),
    p AS (SELECT doc_id, len(t) AS dl, unnest(t) AS term FROM d), tf AS (SELECT doc_id, dl, term, count(*) AS tf FROM p GROUP BY ALL), df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
    q AS (SELECT item_id, unnest(regexp_extract_all(replace(lower(text), 'ß', 'ss'), '[\\p{{L}}\\p{{N}}]+')) AS term FROM benchmark), qw AS (SELECT item_id, term, count(*) AS w FROM q GROUP BY ALL),
    sc AS (SELECT item_id, doc_id, sum(w * ln(1 + (n - df + 0.5::DOUBLE) / (df + 0.5::DOUBLE)) * tf / (tf + 1.5::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * dl / avgdl))) AS score FROM qw JOIN df USING (term) JOIN tf USING (term), s GROUP BY ALL),
    r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY round(score, 9) DESC, doc_id) - 1 AS rank FROM sc QUALIFY rank < 10)"""
_NAME = "translate(n_name, '_0123456789', ' abcdefghij')"
_HITS = """SELECT qid, row_number() OVER (PARTITION BY qid ORDER BY o_totalprice DESC, o_orderkey) - 1 AS rank, 'd|' || o_orderkey AS table_ref,
    (qid % 2 <> 0 OR o_orderstatus = 'F') AS t, (y IS NULL OR y IN (2017, 2018)) AS yo, (qid % 3 <> 0 OR sc IS NULL OR sc = 'separate') AS so, coalesce(y = 2017, false) AS precise
    FROM (SELECT *, o_custkey % 50 AS qid, CASE WHEN o_orderkey % 7 <> 0 THEN year(o_orderdate) + 20 END AS y, CASE o_orderkey % 3 WHEN 0 THEN 'separate' WHEN 1 THEN 'consolidated' END AS sc FROM orders)"""

ORACLE_SQL = {
    "incremental_extraction": """SELECT 'R' || n_regionkey || '_' || n_name || '_2020_separate' AS doc_name, 'R' || n_regionkey AS ticker, 2020::INT AS year, 'separate' AS scope, 3::INT AS line, 1::INT AS page,
        'R' || n_regionkey || '_' || n_name || '_2020_separate|3' AS table_ref, n_name AS name, CASE WHEN n_nationkey % 5 = 0 THEN 'second, longer' ELSE 'first' END AS note,
        (SELECT count(*) FROM nation WHERE n_nationkey % 5 = 0 AND n_nationkey % 7 <> 3)::INT AS read FROM nation WHERE n_nationkey % 7 <> 3""",
    "appended_predictions": "SELECT o_orderkey::INT AS id, (o_orderkey % 3)::DOUBLE AS answer, true AS exec_ok, true AS known FROM orders",
    "bm25_terms": f"SELECT term, count(DISTINCT doc_id) AS df, count(*) AS cf FROM (SELECT doc_id, unnest(t) AS term FROM ({_TOKENS})) GROUP BY term",
    "bm25_topk": f"{_BM25} SELECT item_id, doc_id, round(score, 6) AS score, rank::INT AS rank FROM r",
    "intent_parsing": f"""WITH q AS (SELECT c_custkey, n_nationkey, 'N' || lpad(n_nationkey::VARCHAR, 2, '0') AS code, 'quocgia' || replace(lower({_NAME}), ' ', '') AS own FROM customer JOIN nation ON c_nationkey = n_nationkey),
        a AS (SELECT 'N' || lpad(n_nationkey::VARCHAR, 2, '0') AS code, 'quocgia' || replace(lower({_NAME}), ' ', '') AS alias FROM nation),
        m AS (SELECT c_custkey, string_agg(a.code, ',' ORDER BY a.code) AS named FROM q JOIN a ON contains(own || 'nam', alias) WHERE c_custkey % 3 = 0 GROUP BY c_custkey)
        SELECT q.c_custkey::INT AS id, CASE WHEN q.c_custkey % 3 = 0 THEN named ELSE code END AS tickers,
        CASE WHEN q.c_custkey % 10 BETWEEN 5 AND 8 THEN (2010 + q.c_custkey % 10) || ',2019' ELSE '2019' END AS years,
        CASE q.c_custkey % 4 WHEN 0 THEN 'consolidated' WHEN 1 THEN 'separate' END AS scope, CASE WHEN q.c_custkey % 3 = 1 THEN code ELSE '' END AS parens FROM q LEFT JOIN m USING (c_custkey)""",
    "intent_years": "SELECT o_orderkey, array_to_string(list_sort(list_distinct(list_filter(list_transform(list_filter(string_split_regex(year(o_orderdate) + 20 || '-' || (year(o_orderdate) + 24) || ' x' || o_orderkey || ' 12019 1999', '[^0-9]+'), lambda s: length(s) = 4 AND s[1:2] = '20'), lambda s: s::INT), lambda y: y BETWEEN 2015 AND 2025))), ',') AS years FROM orders",
    "tiered_select": f"""WITH h AS ({_HITS}), k AS (SELECT *, CASE WHEN t AND yo AND so THEN 0 WHEN t AND (yo OR so) THEN 1 ELSE 2 END AS tier FROM h),
        p AS (SELECT *, row_number() OVER (PARTITION BY qid, tier = 2 ORDER BY tier, CASE WHEN tier = 0 AND NOT precise THEN 1 ELSE 0 END, rank) AS place FROM k),
        b AS (SELECT *, CASE WHEN tier < 2 THEN CASE WHEN place <= 18 THEN 0 ELSE 2 END ELSE CASE WHEN place <= 2 THEN 1 ELSE 3 END END AS block FROM p)
        SELECT qid::INT AS qid, (row_number() OVER (PARTITION BY qid ORDER BY block, place) - 1)::INT AS pos, table_ref, array_to_string(list_filter([CASE WHEN NOT t THEN 'ticker_mismatch' END, CASE WHEN NOT yo THEN 'year_mismatch' END, CASE WHEN NOT so THEN 'scope_mismatch' END], lambda x: x IS NOT NULL), ',') AS reasons FROM b QUALIFY pos < 20""",
    "last_wins": "SELECT user_id, event_type, max(event_id) AS event_id, arg_max(value, event_id) AS value FROM events GROUP BY ALL",
    "resume_and_shard": "SELECT o_orderkey AS id FROM orders WHERE o_orderkey % 4 = 1 AND o_orderstatus <> 'F'",
    "missing_orders": "SELECT range::INT AS id FROM range(1, (SELECT count(*) + 1 FROM orders)) WHERE range NOT IN (SELECT l_orderkey FROM lineitem)",
    "prompt_budget": "SELECT source, greatest(count(*) FILTER (upto <= 20000), 1) AS fit FROM (SELECT source, sum(length(text)) OVER (PARTITION BY source ORDER BY doc_id) AS upto FROM documents) GROUP BY source",
    "score_percentiles": "SELECT c_mktsegment, min(v) AS min, l[1 + least(n - 1, floor(0.10 * n)::INT)] AS p10, l[1 + least(n - 1, floor(0.25 * n)::INT)] AS p25, median AS median, l[1 + least(n - 1, floor(0.75 * n)::INT)] AS p75, l[1 + least(n - 1, floor(0.90 * n)::INT)] AS p90, max(v) AS max FROM (SELECT c_mktsegment, unnest(l) AS v, l, n, median FROM (SELECT c_mktsegment, list_sort(list(c_acctbal)) AS l, count(*) AS n, median(c_acctbal) AS median FROM customer GROUP BY ALL)) GROUP BY c_mktsegment, l, n, median",
    "hit_rate": f"{_BM25} SELECT count(*) AS questions, " + ", ".join(f"round(avg(best < {k}::DOUBLE)::DOUBLE, 6) AS top{k}" for k in (1, 3, 5, 10)).replace("avg(best < ", "avg((coalesce(best, 99) < ").replace("::DOUBLE)::DOUBLE", ")::INT)::DOUBLE") + " FROM (SELECT item_id, min(rank) FILTER (lang = 'en') AS best FROM r JOIN documents USING (doc_id) GROUP BY item_id)",
    "relevant_tables": "SELECT l_orderkey, array_to_string(list_transform(list_sort(list_transform(u, lambda x: [list_position(every, x), x]))[1:5], lambda y: 'p|' || y[2]), ',') AS tables FROM (SELECT l_orderkey, every, list_distinct(every) AS u FROM (SELECT l_orderkey, list_concat(coalesce(list(l_partkey ORDER BY l_linenumber, l_partkey) FILTER (l_returnflag = 'R'), []), list(l_partkey ORDER BY l_linenumber, l_partkey)) AS every FROM lineitem GROUP BY l_orderkey))",
    "validate_ids": """WITH o AS (SELECT o_orderkey AS k, o_orderkey - CASE WHEN o_orderkey % 100 = 1 THEN 1 ELSE 0 END AS id FROM orders WHERE o_orderkey % 11 <> 0), f AS (
        SELECT 'question' AS rule FROM o WHERE k % 17 = 0 UNION ALL SELECT 'table_ref' FROM o WHERE k % 13 = 0 UNION ALL SELECT 'relevant_docs' FROM o WHERE k % 19 = 0 AND k % 13 <> 0
        UNION ALL SELECT 'variable' FROM o WHERE k % 23 = 0 UNION ALL SELECT 'csv_path' FROM o WHERE k % 29 = 0
        UNION ALL SELECT 'id_twice' FROM (SELECT id FROM o GROUP BY id HAVING count(*) > 1) UNION ALL SELECT 'id_missing' FROM orders WHERE o_orderkey NOT IN (SELECT id FROM o)
        UNION ALL SELECT 'id_unknown' FROM o WHERE id NOT IN (SELECT o_orderkey FROM orders)) SELECT rule, count(*) AS n FROM f GROUP BY rule""",
    "incremental_events": "SELECT event_type, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY event_type",
}
