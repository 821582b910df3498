"""Queries on files, the retrieval run, quality reports, prompt texts, completions and re-execution.

Files are written to the shared folder from the tables' rows and read back by the package's readers.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import schema
from ..cli import extraction_stats
from ..config import DEFAULTS, load_config, merged
from ..operators import assembly, code, generation, headers, hints, markup, probe, prompt, ranking, search
from ..operators.intent import question_intent
from ..sources import documents, files, hadoop
from .queries_tables import sql_values
from .rendered import order_reports, read, region_reports

_CANDIDATES = f"array<struct<{schema.CANDIDATE.replace(' ', ':').replace(',:', ',')}>>"


def _code(key):
    return F.concat(F.lit("N"), F.lpad(key.cast("string"), 2, "0"))


def _texts(*values):
    return F.array(*map(F.lit, values))


def company_file(spark, sf_dir):
    """Companies from a CSV made of nations: a mark at its start, codes in small letters, a row without a code, codes that come twice."""
    path, nations = f"{hadoop.shared_folder(spark, 'companies')}/c.csv", read(spark, sf_dir, "nation").collect()
    first = [f"n{n.n_nationkey},Cũ {n.n_name}" for n in nations]
    later = [f'N{n.n_nationkey},"CTCP {n.n_name}, loại {n.n_regionkey}"' for n in nations if n.n_nationkey % 3 == 0]
    hadoop.write_text(spark, path, "\n".join(["﻿Mã CK,Tên công ty", *first, ",trống", *later, ""]))
    return files.read_companies(spark, path)


def question_file(spark, sf_dir):
    """Questions from JSON lines with blank ones between them."""
    path = f"{hadoop.shared_folder(spark, 'questions')}/q"
    c = read(spark, sf_dir, "customer").select(F.col("c_custkey").cast("int").alias("id"), F.concat(F.lit('Số dư của "'), "c_name", F.lit('"?')).alias("question"))
    line = F.to_json(F.struct("id", "question"))
    c.select(F.explode(F.array(line, F.lit(""))).alias("value")).write.text(path)
    return files.read_questions(spark, path)


def report_texts(spark, sf_dir):
    """Texts of a tree of reports: line ends of three kinds, a byte that isn't UTF-8, a second file of one name, and a file of another kind."""
    root = f"{hadoop.shared_folder(spark, 'texts')}/fs"
    for n in read(spark, sf_dir, "nation").collect():
        name = f"BC_{n.n_name}_{'HopNhat' if n.n_nationkey % 2 else 'CongTyMe'}"
        for folder, start in (("2020", n.n_name), ("2021", "later")):
            hadoop.write_text(spark, f"{root}/r{n.n_regionkey}/{folder}/{name}/{name}_extracted.txt", f"{start}\r\ndòng\rx".encode() + b"\xff\n")
        hadoop.write_text(spark, f"{root}/r{n.n_regionkey}/2020/{name}/notes.md", "no report")
    return documents.scan_documents(spark, root).select("doc_name", "ticker", "year", "scope", "text")


def csv_readings(spark, sf_dir):
    """One file read as text and with inferred types: an empty field is an empty string there and null here."""
    path = f"{hadoop.shared_folder(spark, 'csv')}/t.csv"
    rows = [f'{n.n_nationkey},"{n.n_name}, ""x""\nline 2",{"" if n.n_nationkey % 4 == 0 else n.n_nationkey * 1.5}' for n in read(spark, sf_dir, "nation").collect()]
    hadoop.write_text(spark, path, "\n".join(["k,name,v", *rows, ""]))
    typed = files.read_csv_inferred(spark, path).select("k", F.col("v").alias("number"), F.typeof("k").alias("kind"))
    return files.read_csv_text(spark, path).withColumn("k", F.col("k").try_cast("int")).join(typed, "k").select("k", "name", "v", "number", "kind")


def _reports(spark, sf_dir):
    return headers.split_header(markup.extract_tables(region_reports(spark, sf_dir).unionByName(order_reports(spark, sf_dir))))


def extraction_counts(spark, sf_dir):
    """What an extraction run reports."""
    t = _reports(spark, sf_dir)
    stats = extraction_stats(t, t.where(headers.eligible(F.col("grid"))), 1)
    return stats.select("documents", "tables", "unclosed", "empty", "indexed", "without_page", "without_context", "with_double_names", "tickers")


def table_by_key(spark, sf_dir):
    """The table on line 4 of each region's report, by its key."""
    t, found = _reports(spark, sf_dir), None
    for r in read(spark, sf_dir, "region").collect():
        one = files.load_table(t, f"R{r.r_regionkey}_{r.r_name}_2023_consolidated", 4).select("table_ref", F.array_join("header", "#").alias("header"), F.size("rows").alias("n"))
        found = one if found is None else found.unionByName(one)
    return found


def _retrieved(spark, sf_dir):
    """Retrieval results of a question for each region, over the tables of all reports."""
    regions, t = read(spark, sf_dir, "region"), _reports(spark, sf_dir)
    ticker = F.concat(F.lit("R0"), F.col("r_regionkey").cast("string"))
    companies = regions.select(ticker.alias("ticker"), F.concat(F.lit("CTCP "), "r_name").alias("name"))
    questions = regions.select(F.col("r_regionkey").alias("id"), F.concat(F.lit("Số khách của "), ticker, F.lit(" năm 2023 là bao nhiêu?")).alias("question"))
    tables = t.withColumn("csv_text", headers.table_csv(F.col("header"), F.col("rows"), 6000))
    entries = headers.index_entries(t.where(headers.eligible(F.col("grid"))), companies)
    path = f"{hadoop.shared_folder(spark, 'results')}/r"
    files.write_json(ranking.retrieve(questions, companies, entries, tables, load_config()), path)
    return path


def retrieval_run(spark, sf_dir):
    """From questions to written and strictly read results: what was understood, how many tables came, and the first of them."""
    r = files.read_retrieval(spark, _retrieved(spark, sf_dir))
    first = F.get("candidates", F.lit(0))
    return r.select(
        "id", "question", F.array_join("tickers", ",").alias("tickers"), F.array_join(F.transform("years", lambda y: y.cast("string")), ",").alias("years"), F.size("candidates").alias("n"), first["table_ref"].alias("first"),
        first["page"].alias("page"), first["rank"].alias("rank"), F.split_part(first["csv_text"], F.lit("\n"), F.lit(1)).alias("header"), first["context_before"].alias("context"),
    )


def retrieval_counts(spark, sf_dir):
    return ranking.retrieval_stats(files.read_retrieval(spark, _retrieved(spark, sf_dir)))


def stored_search(spark, sf_dir):
    """The ten best documents for each benchmark item, from an index that was stored, found again and loaded."""
    docs, items, path = read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"), hadoop.shared_folder(spark, "bm25")
    made = search.stored_index(docs, path, "doc_id", "text")
    hits = search.search(search.load_index(spark, path, fingerprint=made.fingerprint), items, 10, "item_id", "text")
    return hits.select(F.col("qid").alias("item_id"), F.col("id").alias("doc_id"), F.round("score", 6).alias("score"), "rank")


def shadowed_codes(spark, sf_dir):
    """A code that only is a word of another company's name doesn't count, unless it stands in parentheses or alone."""
    r = read(spark, sf_dir, "region").withColumn("code", F.left("r_name", F.lit(3)))
    other, carrier = F.concat(F.lit("X"), F.col("r_regionkey").cast("string")), F.concat(F.lit("Vận tải "), "code", F.lit(" Toàn Cầu"))
    companies = r.select(F.col("code").alias("ticker"), F.concat(F.lit("CTCP Riêng "), "r_name").alias("name")).unionByName(r.select(other.alias("ticker"), F.concat(F.lit("CTCP "), carrier).alias("name")))
    asked = F.array(F.concat(F.lit("Doanh thu của "), carrier), F.concat(F.lit("Doanh thu của "), "code"), F.concat(F.lit("Doanh thu của "), carrier, F.lit(" ("), "code", F.lit(")")))
    q = r.select("r_regionkey", F.posexplode(asked).alias("k", "question")).select((F.col("r_regionkey") * 3 + F.col("k")).alias("id"), "question")
    return question_intent(q, companies).select("id", F.array_join("tickers", ",").alias("tickers"), F.array_join("ticker_in_parens", ",").alias("parens"))


def _probed(spark, sf_dir):
    """Results made of customers, by the customer's key: of no to four candidates, with other companies' tables and added codes."""
    key, nation = F.col("c_custkey"), F.col("c_nationkey")
    own, none = F.array(_code(nation)), F.array().cast("array<string>")
    added = F.when(key % 4 <= 1, F.array(_code((nation + 1) % 25))).otherwise(none)
    candidate = lambda j: F.struct(
        F.concat(F.lit("d|"), j.cast("string")), F.lit("d"), _code((nation + j * (key % 2)) % 25), 2015 + (key + j) % 10, F.when((key + j) % 2 == 0, "separate").otherwise("consolidated"),
        j, F.lit(1), j, (key % 7 - j).cast("double"), F.lit(""), F.lit(""),
    )
    many = F.transform(F.sequence(F.lit(0).cast("long"), key % 5 - 1), candidate).cast(_CANDIDATES)
    return read(spark, sf_dir, "customer").select(
        key.cast("int").alias("id"), F.array_sort(F.array_union(own, added)).alias("tickers"), F.array((2015 + key % 4).cast("int")).alias("years"), F.when(key % 3 == 1, "separate").when(key % 3 == 2, "consolidated").alias("scope"),
        F.when(key % 5 > 0, many).otherwise(F.array().cast(_CANDIDATES)).alias("candidates"), F.when(key % 3 > 0, own).otherwise(none).alias("ticker_in_parens"),
    )


def probe_counts(spark, sf_dir):
    return probe.report(_probed(spark, sf_dir))


def probe_added_codes(spark, sf_dir):
    return probe.extra_tickers(_probed(spark, sf_dir))


def probe_wrong_codes(spark, sf_dir):
    return probe.wrong_tickers(_probed(spark, sf_dir))


def probe_examples(spark, sf_dir):
    return probe.examples(_probed(spark, sf_dir), 10).select("id", F.size("candidates").alias("n"))


def parser_agreement(spark, sf_dir):
    """Questions of customers name the company in parentheses, and outside of them the same one, none, another one, or both."""
    key, nation = F.col("c_custkey"), F.col("c_nationkey")
    told, other = _code(nation), _code((nation + 1) % 25)
    outside = F.when(key % 4 == 0, told).when(key % 4 == 1, F.lit("")).when(key % 4 == 2, other).otherwise(F.concat(told, F.lit(" và "), other))
    q = read(spark, sf_dir, "customer").select(key.cast("int").alias("id"), F.concat(F.lit("Số dư "), outside, F.lit(" ("), told, F.lit(") là bao nhiêu?")).alias("question"))
    companies = read(spark, sf_dir, "nation").select(_code(F.col("n_nationkey")).alias("ticker"), F.concat(F.lit("CTCP "), F.translate("n_name", "_", " ")).alias("name"))
    return probe.parser_agreement(q, companies)


#: Unit line of a table, unit of an answer, power of ten.
_TABLE_UNITS = (("Đơn vị: VND", "đồng", 0), ("Đơn vị tính: nghìn đồng", "nghìn đồng", 3), ("Đơn vị: triệu VND", "triệu đồng", 6), ("Đơn vị: tỷ đồng", "tỷ đồng", 9))


def conversion_notes(spark, sf_dir):
    """For nations, tables and answers in four units each: the table's unit from its columns, else from the text before, and how to convert."""
    k = F.col("n_nationkey")
    context = F.get(_texts(*[u[0] for u in _TABLE_UNITS]), k % 4)
    asked = F.concat(F.lit("Doanh thu năm 2020 là bao nhiêu "), F.get(_texts(*[u[1] for u in _TABLE_UNITS]), F.floor(k / 4).cast("int") % 4), F.lit("?"))
    header = F.when(k < 16, _texts("Chỉ tiêu", "Số cuối năm")).otherwise(_texts("Chỉ tiêu", "Số cuối năm Triệu VND"))
    n = read(spark, sf_dir, "nation").select(k, hints.table_unit_factor(hints.column_hints(header), context).alias("factor"), hints.answer_unit(asked).alias("u"))
    return n.select("n_nationkey", "factor", hints.unit_label(F.col("factor")).alias("label"), hints.scale_note(F.col("factor"), F.col("u")).alias("note"))


def column_notes(spark, sf_dir):
    """What a prompt says on a table's columns, for headers with a date of each nation."""
    k = F.col("n_nationkey")
    header = F.array(F.lit("Chỉ tiêu"), F.concat(F.lit("31/12/"), (2015 + k % 10).cast("string"), F.lit(" Triệu VND")), F.lit("Số đầu năm (tỷ đồng)"), F.lit("Tỷ trọng %"))
    target = F.when(k % 4 > 0, k % 4).cast("int")
    return read(spark, sf_dir, "nation").select(k, hints.column_note(hints.column_hints(header), target).alias("note"))


def prompt_texts(spark, sf_dir):
    """The parts of a prompt on question and table."""
    k = F.col("id")
    ask = F.get(_texts("Doanh thu là bao nhiêu triệu đồng?", "Doanh thu là bao nhiêu?", "Hệ số thanh toán là bao nhiêu lần?"), k % 3)
    none = F.array()
    rows = read(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("id"), "n_name").select(
        "id", ask.alias("question"), F.when(k % 2 == 0, F.array("n_name")).otherwise(none.cast("array<string>")).alias("tickers"), F.when(k % 4 > 0, F.array(2015 + k % 4, F.lit(2020))).otherwise(none.cast("array<int>")).alias("years"),
        F.when(k % 5 == 0, "separate").when(k % 5 == 1, "consolidated").when(k % 5 == 2, "aggregated").alias("scope"),
    )
    c = F.struct(
        F.when(k % 2 == 0, " Đơn vị: VND ").alias("context_before"), F.concat(F.lit("D|"), k.cast("string")).alias("table_ref"), F.get("tickers", F.lit(0)).alias("ticker"), F.get("years", F.lit(0)).alias("year"), F.col("scope"), k.alias("page"),
    )
    hint = F.struct(F.lit("note 1").alias("column_note"), F.lit("note 2").alias("scale_note"))
    block = prompt.table_block(prompt.variable_name(k + 1), c, _texts("a", "b"), F.lit("a,b\n1,2\n\n"), hint)
    return rows.select("id", prompt.metadata_block().alias("metadata"), block.alias("block"))


def _small_memory():
    def model(system, user):
        if system == "bad":
            raise ValueError("no")
        if len(user) > 9:
            raise MemoryError("out of memory")
        return str(len(user))

    return model


def memory_ladder(spark, sf_dir):
    """A model whose memory holds nine characters, over prompts that get shorter by rung; other errors end a question at once."""
    key = F.col("c_custkey")
    rung = lambda n: F.struct(F.when(key % 13 == 0, "bad").otherwise("good").alias("system"), F.repeat(F.lit("x"), (key % 11 * n).cast("int")).alias("user"))
    prompts = read(spark, sf_dir, "customer").select(key.alias("id"), F.array(*[rung(n) for n in generation.retry_ladder(4)]).alias("rungs"))
    return generation.complete(prompts, _small_memory)


def method_form(spark, sf_dir):
    """Numbers read by the helper as a function and as a method of a column and of a frame, over a table for each nation."""
    k = F.col("n_nationkey")
    csv = F.concat(F.lit("name,v\nx,1.234\ny,("), k.cast("string"), F.lit(")\n"))
    forms = _texts("result = df1['v'].map(to_num).sum()", "result = df1['v'].to_num().sum()", "result = df1[['v']].to_num()['v'].sum()")
    rows = read(spark, sf_dir, "nation").select(k.alias("id"), code.finalized(F.get(forms, k % 3)).alias("code"), F.create_map(F.lit("df1"), csv).alias("tables"))
    return code.execute(rows, isolated=False).select("id", "ok", "answer")


_CSV = "Mã số,Chỉ tiêu,Số cuối năm\n110,Tiền,1.234\n120,Nợ,500\n"
#: Query by the remainder of the nation's key, the earlier answer, the answer, and what the report says.
_QUERIES = (
    ("result = float(len(df1))", 7.0, 2.0, "mismatch_fixed"), ("result = missing", 999.0, 999.0, "failed"), ("result = float(len(df1[df1['Mã số'] == '110']))", 1.0, 1.0, "fragile_to_default_reader"), ("", 3.0, 3.0, "skipped"),
    ("result = 2.0", 2.0, 2.0, ""),
)


def _assembled(spark, sf_dir):
    """Submission parts for a question of each nation: queries of five kinds; evidence names a variable twice, but for the last
    kind, whose table's text isn't in the results and comes from the stored tables."""
    k = F.col("n_nationkey")
    doc = F.concat(F.lit("N"), k.cast("string"), F.lit("_2020"))
    cand = lambda line, csv: F.struct(F.concat(doc, F.lit(f"|{line}")), doc, F.lit("N"), F.lit(2020), F.lit(None).cast("string"), F.lit(line), F.lit(1), F.lit(0), F.lit(1.0), F.lit(""), F.lit(csv))
    n = read(spark, sf_dir, "nation")
    questions = n.select(k.alias("id"), F.col("n_name").alias("question"))
    results = n.select(k.alias("id"), F.array(cand(5, _CSV), cand(9, "")).cast(_CANDIDATES).alias("candidates"))
    named = lambda line: F.struct(F.lit("df1").alias("variable"), F.concat(F.lit("data/"), doc, F.lit(f"_table_{line}.csv")).alias("csv_path"))
    predictions = n.select(
        k.alias("id"), F.get(_texts(*[q[0] for q in _QUERIES]), k % 5).alias("pandas_query"), F.get(F.array(*[F.lit(q[1]) for q in _QUERIES]), k % 5).alias("answer"),
        F.when(k % 5 == 4, F.array(named(9))).otherwise(F.array(named(5), named(9))).alias("evidence"), F.array(F.concat(doc, F.lit("|5"))).alias("used_table_refs"),
    )
    stored = n.select(F.concat(doc, F.lit("|9")).alias("table_ref"), F.lit("a,b\n1,2\n").alias("csv_text"))
    return assembly.assemble(questions, results, predictions, stored, load_config(), isolated=False), predictions


def reexecution(spark, sf_dir):
    """Answers of the run here, what the report says on them, and the evidence that stays."""
    (items, report, _), predictions = _assembled(spark, sf_dir)
    repeated = predictions.select("id", assembly.repeated_variables(F.col("evidence")).alias("repeated"))
    every = items.join(report.select("id", "status"), "id", "left").join(repeated, "id")
    return every.select("id", "answer", F.coalesce("status", F.lit("")).alias("status"), F.array_join("evidence.csv_path", ",").alias("evidence"), F.array_join("relevant_tables", ",").alias("tables"), "repeated")


def evidence_files(spark, sf_dir):
    return _assembled(spark, sf_dir)[0][2]


def assembly_counts(spark, sf_dir):
    return assembly.assembly_stats(*_assembled(spark, sf_dir)[0])


def settings(spark, sf_dir):
    """Settings with some of them given: mappings are merged, other values replaced; without a file the defaults stand."""
    config = merged(DEFAULTS, {"retrieval": {"top_k": 7}, "answer": {"rel_tol": 0.5}, "more": {"x": 1}})
    rows = [(f"{part}.{name}", str(value)) for part, values in config.items() if part in ("extraction", "answer", "more", "execution") for name, value in values.items()]
    rows += [("retrieval.top_k", str(config["retrieval"]["top_k"])), ("retrieval.min_table_cells", str(config["retrieval"]["min_table_cells"])), ("without a file", str(load_config("/nowhere/c.yaml") == DEFAULTS))]
    return spark.createDataFrame(rows, "name string, value string")


QUERIES = {
    f.__name__: f
    for f in (
        company_file, question_file, report_texts, csv_readings, extraction_counts, table_by_key, retrieval_run, retrieval_counts, stored_search, shadowed_codes, probe_counts, probe_added_codes, probe_wrong_codes, probe_examples,
        parser_agreement, conversion_notes, column_notes, prompt_texts, memory_ladder, method_form, reexecution, evidence_files, assembly_counts, settings,
    )
}

_REGIONS = "(SELECT r_regionkey, r_name, 'R' || r_regionkey || '_' || r_name || '_2023_consolidated' AS doc, count(*) AS n FROM region JOIN nation ON r_regionkey = n_regionkey GROUP BY ALL)"
_HAS_ORDERS = "(SELECT least(count(*), 1) FROM orders)"
_PROBED = "(SELECT *, c_custkey AS k, c_nationkey AS n, c_custkey % 5 AS size FROM customer)"


def _n(key: str) -> str:
    return f"'N' || lpad(({key})::VARCHAR, 2, '0')"


def _case(key: str, values) -> str:
    return f"CASE {key} " + " ".join(f"WHEN {i} THEN {v}" for i, v in enumerate(values)) + " END"


def _quoted(values) -> list[str]:
    return ["'" + str(v).replace("'", "''") + "'" for v in values]


_UNIT_ROWS = sql_values([(i, label, asked, power) for i, ((_, asked, power), label) in enumerate(zip(_TABLE_UNITS, ("VND", "Nghìn VND", "Triệu VND", "Tỷ VND"), strict=True))], "i, label, asked, power")
_POWERS = sql_values([(3, "1000"), (6, "1e+06"), (9, "1e+09"), (-3, "0.001"), (-6, "1e-06"), (-9, "1e-09")], "e, g")

ORACLE_SQL = {
    "company_file": "SELECT 'N' || n_nationkey AS ticker, CASE WHEN n_nationkey % 3 = 0 THEN 'CTCP ' || n_name || ', loại ' || n_regionkey ELSE 'Cũ ' || n_name END AS name FROM nation",
    "question_file": "SELECT c_custkey::INT AS id, 'Số dư của \"' || c_name || '\"?' AS question FROM customer",
    "report_texts": """SELECT 'BC_' || n_name || CASE WHEN n_nationkey % 2 = 1 THEN '_HopNhat' ELSE '_CongTyMe' END AS doc_name, 'R' || n_regionkey AS ticker, 2020::INT AS year,
        CASE WHEN n_nationkey % 2 = 1 THEN 'consolidated' ELSE 'separate' END AS scope, n_name || chr(10) || 'dòng' || chr(10) || 'x' || chr(65533) || chr(10) AS text FROM nation""",
    "csv_readings": """SELECT n_nationkey AS k, n_name || ', "x"' || chr(10) || 'line 2' AS name, CASE WHEN n_nationkey % 4 = 0 THEN '' ELSE (n_nationkey * 1.5::DOUBLE)::VARCHAR END AS v,
        CASE WHEN n_nationkey % 4 > 0 THEN n_nationkey * 1.5::DOUBLE END AS number, 'int' AS kind FROM nation""",
    "extraction_counts": f"""SELECT count(*) + {_HAS_ORDERS} AS documents, 2 * count(*) + e + {_HAS_ORDERS} AS tables, e AS unclosed, e AS empty, count(*) + {_HAS_ORDERS} AS indexed, 0::BIGINT AS without_page,
        e AS without_context, 0::BIGINT AS with_double_names, count(*) + {_HAS_ORDERS} AS tickers FROM (SELECT *, count(*) FILTER (r_regionkey % 2 = 0) OVER () AS e FROM {_REGIONS}) GROUP BY e""",
    "table_by_key": f"SELECT doc || '|4' AS table_ref, 'Khu vực#Quốc gia#Số khách#Số cuối năm VND' AS header, n::INT AS n FROM {_REGIONS}",
    "retrieval_run": f"""SELECT r_regionkey AS id, 'Số khách của R0' || r_regionkey || ' năm 2023 là bao nhiêu?' AS question, 'R0' || r_regionkey AS tickers, '2023' AS years, (count(*) OVER () + {_HAS_ORDERS})::INT AS n, doc || '|4' AS first,
        1::INT AS page, 0::INT AS rank, 'Khu vực,Quốc gia,Số khách,Số cuối năm VND' AS header, 'BÁO CÁO ' || r_name || ' Đơn vị: VND' AS context FROM {_REGIONS}""",
    "retrieval_counts": f"SELECT count(*) AS questions, 0::BIGINT AS empty, count(*) * (count(*) + {_HAS_ORDERS}) AS candidates, count(*) AS with_ticker, count(*) AS with_year, 0::BIGINT AS with_scope, 0::BIGINT AS top1_zero FROM {_REGIONS}",
    "shadowed_codes": """SELECT (r_regionkey * 3 + k)::INT AS id, CASE k WHEN 0 THEN other WHEN 1 THEN code ELSE CASE WHEN code < other THEN code || ',' || other ELSE other || ',' || code END END AS tickers, CASE k WHEN 2 THEN code ELSE '' END AS parens
        FROM (SELECT r_regionkey, left(r_name, 3) AS code, 'X' || r_regionkey AS other, unnest([0, 1, 2]) AS k FROM region)""",
    "probe_counts": f"""SELECT count(*) AS questions, count(*) FILTER (size = 0) AS empty, count(*) FILTER (size > 0 AND k % 7 = 0) AS top1_zero, count(*) FILTER (size > 0 AND k % 3 > 0) AS with_paren_ticker, count(*) FILTER (size > 0) AS with_year,
        count(*) FILTER (size > 0 AND k % 10 = k % 4) AS top1_year_match, count(*) FILTER (size > 0 AND k % 3 > 0) AS with_scope, count(*) FILTER (size > 0 AND ((k % 3 = 1 AND k % 2 = 0) OR (k % 3 = 2 AND k % 2 = 1))) AS top1_scope_match FROM {_PROBED}""",
    "probe_added_codes": f"SELECT {_n('(n + 1) % 25')} AS ticker, count(*) AS n, count(*) FILTER (k % 2 = 1 AND size >= 2) AS in_top5 FROM {_PROBED} WHERE size > 0 AND k % 3 > 0 AND k % 4 <= 1 GROUP BY 1",
    "probe_wrong_codes": f"SELECT {_n('(n + j) % 25')} AS ticker, count(*) AS n FROM (SELECT n, unnest(range(1, size)) AS j FROM {_PROBED} WHERE k % 3 > 0 AND k % 2 = 1) GROUP BY 1",
    "probe_examples": "SELECT c_custkey::INT AS id, (c_custkey % 5)::INT AS n FROM (SELECT c_custkey, row_number() OVER (ORDER BY c_custkey) - 1 AS place, greatest(1, count(*) OVER () // 10) AS step FROM customer) WHERE place % step = 0 AND place < step * 10",
    "parser_agreement": "SELECT CASE c_custkey % 4 WHEN 0 THEN 'agree' WHEN 1 THEN 'missing' WHEN 2 THEN 'conflict' ELSE 'superset' END AS outcome, count(*) AS n FROM customer GROUP BY 1",
    "conversion_notes": f"""WITH u AS (SELECT * FROM {_UNIT_ROWS}), x AS (SELECT n_nationkey, t.label, t.power, a.asked, t.power - a.power AS e FROM nation
            JOIN u AS t ON t.i = CASE WHEN n_nationkey < 16 THEN n_nationkey % 4 ELSE 2 END JOIN u AS a ON a.i = n_nationkey // 4 % 4)
        SELECT n_nationkey, pow(10, power)::DOUBLE AS factor, label, 'unit conversion: ' || CASE WHEN x.e = 0 THEN 'none, table and answer are in ' || label
            ELSE CASE WHEN x.e > 0 THEN '× 1' ELSE '÷ 1' END || repeat('.000', abs(x.e)::INT // 3) || ' (factor ' || g || '), from ' || label || ' to ' || asked END AS note FROM x LEFT JOIN (SELECT * FROM {_POWERS}) AS p ON p.e = x.e""",
    "column_notes": """SELECT n_nationkey, 'columns: [1] 31/12/' || (2015 + n_nationkey % 10) || ', Triệu VND; [2] đầu năm/đầu kỳ, Tỷ VND; [3] % -> ' || CASE WHEN n_nationkey % 4 > 0 THEN 'read .iloc[:, ' || n_nationkey % 4 || ']' ELSE 'which one the question means is open' END AS note FROM nation""",
    "prompt_texts": f"""WITH x AS (SELECT n_nationkey AS id, n_name, n_nationkey % 2 = 0 AS named, n_nationkey % 4 AS y, CASE n_nationkey % 5 WHEN 0 THEN 'separate' WHEN 1 THEN 'consolidated' WHEN 2 THEN 'aggregated' ELSE 'unknown' END AS scope FROM nation)
        SELECT id, '* question: ' || id || chr(10) || '* companies: ' || CASE WHEN named THEN n_name ELSE 'unknown' END || chr(10) || '* years: ' || CASE WHEN y > 0 THEN 2015 + y || ', 2020' ELSE 'unknown' END || chr(10) || '* report: '
        || {_case('id % 5', _quoted([*prompt.SCOPE_NAMES.values(), 'any', 'any']))} || chr(10) || '* unit of the answer: '
        || {_case('id % 3', _quoted(['triệu đồng; convert every value that you read to it', 'VND, since the question names none', 'as in the table, ' + hints.REASON_RATIO]))} AS metadata,
        '<table variable="df' || (id + 1) || '" source="D|' || id || '" company="' || CASE WHEN named THEN n_name ELSE 'unknown' END || '" year="' || CASE WHEN y > 0 THEN (2015 + y)::VARCHAR ELSE 'unknown' END || '" report="' || scope || '" page="' || id || '">'
        || chr(10) || '<!-- text before the table: ' || CASE WHEN named THEN 'Đơn vị: VND' ELSE 'none' END || ' -->' || chr(10) || '<!-- note 1 -->' || chr(10) || '<!-- note 2 -->' || chr(10) || 'a,b' || chr(10) || '1,2' || chr(10) || '</table>' AS block FROM x""",
    "memory_ladder": """SELECT id, CASE WHEN bad THEN 0 WHEN w <= 2 THEN 0 WHEN w = 3 THEN 1 WHEN w = 4 THEN 2 ELSE 3 END::INT AS rung,
        CASE WHEN bad OR w = 10 THEN '' ELSE (w * CASE WHEN w <= 2 THEN 4 WHEN w = 3 THEN 3 WHEN w = 4 THEN 2 ELSE 1 END)::VARCHAR END AS completion, CASE WHEN bad THEN 'ValueError: no' WHEN w = 10 THEN 'MemoryError: out of memory' END AS error
        FROM (SELECT c_custkey AS id, c_custkey % 13 = 0 AS bad, c_custkey % 11 AS w FROM customer)""",
    "method_form": "SELECT n_nationkey AS id, true AS ok, 1234.0::DOUBLE - n_nationkey AS answer FROM nation",
    "reexecution": f"""SELECT n_nationkey AS id, {_case('n_nationkey % 5', [f"{q[2]}::DOUBLE" for q in _QUERIES])} AS answer, {_case('n_nationkey % 5', _quoted([q[3] for q in _QUERIES]))} AS status,
        'data/N' || n_nationkey || '_2020_table_' || CASE WHEN n_nationkey % 5 = 4 THEN 9 ELSE 5 END || '.csv' AS evidence, 'N' || n_nationkey || '_2020|5,N' || n_nationkey || '_2020|9' AS tables, CASE WHEN n_nationkey % 5 = 4 THEN 0 ELSE 1 END::INT AS repeated FROM nation""",
    "evidence_files": f"""SELECT 'N' || n_nationkey || '_2020_table_' || CASE WHEN n_nationkey % 5 = 4 THEN 9 ELSE 5 END || '.csv' AS file_name, CASE WHEN n_nationkey % 5 = 4 THEN 'a,b' || chr(10) || '1,2' || chr(10) ELSE {_quoted([_CSV])[0]} END AS csv_text FROM nation""",
    "assembly_counts": """SELECT count(*) AS items, count(*) FILTER (n_nationkey % 5 = 3) AS empty_query, count(*) FILTER (n_nationkey % 5 = 1) AS failed, count(*) FILTER (n_nationkey % 5 = 2) AS fragile_to_default_reader,
        count(*) FILTER (n_nationkey % 5 = 0) AS mismatch_fixed, count(*) FILTER (n_nationkey % 5 = 3) AS skipped, count(*) AS csv_files FROM nation""",
    "settings": f"SELECT * FROM {sql_values([('extraction.table_ref_line_base', '1'), ('answer.abs_tol', '0.0'), ('answer.rel_tol', '0.5'), ('answer.fallback_answer', '0.0'), ('more.x', '1'), ('execution.timeout_s', '20'), ('execution.startup_timeout_s', '120'), ('retrieval.top_k', '7'), ('retrieval.min_table_cells', '4'), ('without a file', 'True')], 'name, value')}",
}
