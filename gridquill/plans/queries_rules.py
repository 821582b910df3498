"""Queries on hints, code checks, execution and assembly. Their cases are literal rows; their SQL states the results."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..config import load_config
from ..operators import assembly, code, generation, headers, hints, markup, prompt
from .queries_tables import sql_values
from .rendered import order_reports, region_reports

UNITS = (
    ("31/12/2018VND", 1.0), ("Triệu VND", 1e6), ("Số cuối nămTriệu đồng", 1e6), ("Đơn vị tính: VND", 1.0), ("Đơn vị: nghìn tỷ đồng", 1e12), ("Hoạt động chính", None), ("Cổ đông", None), ("VNDIRECT", None), ("trăm tỷ đồng", 1e11),
    ("Số tiền", None), ("chục triệu đồng", 1e7), ("nghìn đồng", 1e3), ("", None), ("5 triệu cổ phiếu", None),
)
#: Question, factor, whether the answer isn't converted, whether its unit is assumed.
ASKED = (
    ("Lãi tiền gửi năm 2018 là bao nhiêu triệu đồng?", 1e6, False, False), ("Tổng tài sản cuối năm 2020 là bao nhiêu tỷ đồng?", 1e9, False, False), ("Tổng tài sản là bao nhiêu nghìn tỷ đồng?", 1e12, False, False),
    ("Lợi nhuận năm 2021 là bao nhiêu trăm tỷ đồng?", 1e11, False, False), ("Lãi thuần năm 2017 là mấy trăm tỷ đồng?", 1e11, False, False), ("Tỷ lệ nợ trên vốn năm 2022 là bao nhiêu phần trăm?", None, True, False),
    ("Hệ số thanh toán năm 2021 là bao nhiêu lần?", None, True, False), ("Vốn điều lệ 5.000 tỷ đồng chiếm bao nhiêu phần trăm?", None, True, False), ("Năm nào có tổng nợ cao nhất?", None, True, False),
    ("Chênh lệch số lượng cổ phiếu là bao nhiêu triệu cổ phiếu?", None, True, False), ("Công ty chiếm 5% thị phần có doanh thu là bao nhiêu tỷ đồng?", 1e9, False, False), ("Số dư USD cuối năm 2018 là bao nhiêu triệu USD?", None, True, False),
    ("Nợ nhiều hơn mấy triệu thế nhỉ?", 1e6, False, False), ("Doanh thu thuần năm 2023 là bao nhiêu?", 1.0, False, True), ("Tốc độ tăng trưởng % là bao nhiêu?", None, True, False),
)
#: Header cell, period, year.
PERIODS = (
    ("31/12/2018 | Triệu VND", "31/12/2018", 2018), ("Ngày 1 tháng 1 năm 2019", "01/01/2019", 2019), ("1/1/2018VND", "01/01/2018", 2018), ("6/2020", "06/2020", 2020), ("Năm 2021", "2021", 2021), ("Số cuối năm", "cuối năm/cuối kỳ", None),
    ("Số đầu kỳ", "đầu năm/đầu kỳ", None), ("Năm nay", "năm nay", None), ("Kỳ trước", "năm trước", None), ("Mã số", None, None), ("30.9.2022", "30/09/2022", 2022), ("12345", None, None),
)
#: Header, question, years, year of the report, column.
TARGETS = (
    (["", "31/12/2018VND", "1/1/2018VND"], "Lãi cuối năm 2018 là bao nhiêu triệu đồng?", [2018], 2018, 1), (["", "31/12/2016", "31/12/2015"], "đến ngày 31/12/2016 là bao nhiêu?", [2016], 2016, 1),
    (["", "Số cuối năm", "Số đầu năm"], "Thuế đầu năm 2017 là bao nhiêu?", [2017], 2017, 2), (["", "Số cuối năm", "Số đầu năm"], "Nợ cuối năm 2016", [2016], 2017, 2), (["", "Mã", "TM", "Năm nay", "Năm trước"], "Tiền đầu năm 2022 là bao nhiêu?", [2022], 2022, 3),
    (["", "Mã", "TM", "Năm nay", "Năm trước"], "Chi phí lãi vay năm 2022", [2022], 2023, 4), (["", "Số cuối năm | Dự phòng", "Số cuối năm | Giá gốc"], "Giá gốc cuối năm 2022", [2022], 2022, 2), (["", "Giá trị", "Ghi chú"], "cuối năm 2021", [2021], 2021, None),
    (["", "31/12/2018 | Triệu đồng", "31/12/2018 | %"], "đến ngày 31/12/2018 là bao nhiêu triệu đồng?", [2018], 2018, 1), (["", "31/12/2017", "31/12/2016"], "Chi phí đầu năm 2017 là bao nhiêu?", [2017], 2017, 2),
    (["", "Năm 2022", "Năm 2021"], "cao nhất trong các năm 2020, 2021, 2022", [2020, 2021, 2022], 2022, 1),
)
#: Grid, header, number of rows left.
GRIDS = (
    ([["Tên", "Số cuối năm", "Số cuối năm"], ["Tên", "Giá trị", "Dự phòng"], ["A", "1", "2"], ["B", "3", "4"]], ["Tên", "Số cuối năm | Giá trị", "Số cuối năm | Dự phòng"], 2),
    ([["", "Phát sinh", "Phát sinh"], ["", "Phải nộp", "Đã nộp"], ["", "Triệu VND", "Triệu VND"], ["Thuế", "5", "6"]], ["", "Phát sinh | Phải nộp | Triệu VND", "Phát sinh | Đã nộp | Triệu VND"], 1),
    ([["Tên", "A", "A"], ["x", "b", "c"]], ["Tên", "A", "A"], 1), ([["Tên", "2020", "2021"], ["x", "1", "2"], ["y", "3", "4"]], ["Tên", "2020", "2021"], 2), ([["Một"]], ["Một"], 0), ([], [], 0),
    ([["Tên", "S", "S"], ["x", "như", "như"], ["y", "1", "2"]], ["Tên", "S", "S"], 2),
)
#: Markup, grid.
MARKUP = (
    ("<table><tr><td>a</td><td>b</td></tr></table>", [["a", "b"]]), ('<table><tr><td rowspan="3">r</td><td>1</td></tr><tr><td>2</td></tr><tr><td>3</td></tr></table>', [["r", "1"], ["r", "2"], ["r", "3"]]),
    ('<table><tr><td colspan="2">c</td><td>d</td></tr><tr><td>e</td></tr></table>', [["c", "c", "d"], ["e", "", ""]]), ("<table><tr><td>a<td>b<tr><td>c</table>", [["a", "b"], ["c", ""]]),
    ("<table><tr><td>  x\n y </td></tr><tr><td></td></tr></table>", [["x y"]]), ('<table><tr><td colspan="rác">z</td></tr></table>', [["z"]]), ("", []), ("<table></table>", []), ("<table><tr><th>&amp;</th></tr></table>", [["&"]]),
)
#: Code, whether it may run.
CHECKS = (
    ("result = 1", True), ("import os", False), ("from os import path", False), ("x = (1).__class__", False), ("eval('1')", False), ("__builtins__", False), ("'{}'.format(1)", False), ("f = str.format_map", False), ("open('x')", False),
    ("x = '{0.__class__}'", False), ("global y", False), ("result = df1.iloc[0, 0]", True), ("result = (", False), ("getattr(df1, 'x')", False), ("result = sum([1, 2])", True), ("df1.eval('a')", False),
)
#: Completion, code.
COMPLETIONS = (
    ("```python\nresult = 1\n```", "result = 1"), ("Here is the code:\nresult = 2\nDone now", "result = 2"), ("import pandas as pd\nresult = 3", "result = 3"), ("result = 4", "result = 4"), ("```\nx = 1\n```\n```py\ny = 2\nresult = y\n```", "y = 2\nresult = y"), ("", ""),
    ("Kết quả", "Kết quả"),
)
CSV = "Mã số,Chỉ tiêu,Số cuối năm\n110,Tiền,1.234\n120,Nợ,(500)\n"
#: Code, whether it ran, answer, whether the inferred reading agrees.
RUNS = (
    ("result = len(df1)", True, 2.0, True), ("result = to_num(df1.iloc[0, 2])", True, 1234.0, True), ("result = to_num(df1.iloc[1, 2])", True, -500.0, True), ("x = 1", False, None, False), ("result = 1 / 0", False, None, False),
    ("result = len(df1[df1['Mã số'] == '110'])", True, 1.0, False), ("result = 'abc'", True, None, False), ("result = '1.234,5'", True, 1234.5, True), ("import os", False, None, False), ("", False, None, False), ("result = df['Mã số'].astype(str).str.len().sum()", True, 6.0, True),
)


def _frame(spark, rows, ddl):
    return spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], f"k int, {ddl}")


def unit_factors(spark, sf_dir):
    return _frame(spark, UNITS, "name string, want double").select("k", "name", hints.unit_factor(F.col("name")).alias("factor"))


def answer_units(spark, sf_dir):
    u = hints.answer_unit(F.col("question"))
    rows = _frame(spark, ASKED, "question string, f double, n boolean, a boolean").withColumn("u", u)
    return rows.select("k", "u.factor", "u.no_conversion", "u.assumed")


def column_periods(spark, sf_dir):
    p = _frame(spark, PERIODS, "name string, p string, y int").withColumn("h", hints.column_hints(F.array("name"))[0])
    return p.select("k", "name", "h.period", F.col("h.year").cast("double").alias("year"))


def target_columns(spark, sf_dir):
    t = _frame(spark, TARGETS, "header array<string>, question string, years array<int>, table_year int, want int")
    h = hints.table_hints(F.col("header"), F.lit(""), F.col("question"), F.col("years"), F.col("table_year"))
    return t.withColumn("h", h).select("k", F.col("h.target").cast("double").alias("target"))


def header_tiers(spark, sf_dir):
    g = headers.split_header(_frame(spark, GRIDS, "grid array<array<string>>, want array<string>, left int"))
    return g.select("k", F.array_join("header", "#").alias("header"), F.size("rows").alias("left"))


def markup_grids(spark, sf_dir):
    g = _frame(spark, MARKUP, "html string, want array<array<string>>").withColumn("g", markup.html_grid("html"))
    return g.select("k", F.array_join(F.transform("g", lambda r: F.array_join(r, ",")), ";").alias("grid"))


def code_checks(spark, sf_dir):
    return _frame(spark, CHECKS, "code string, want boolean").select("k", code.check_error("code").isNull().alias("allowed"))


def code_extraction(spark, sf_dir):
    return _frame(spark, COMPLETIONS, "completion string, want string").select("k", code.extracted("completion").alias("code"))


def code_runs(spark, sf_dir):
    """Code over one table in a child process each, under both readings."""
    rows = _frame(spark, RUNS, "code string, want_ok boolean, want double, agree boolean").select(F.col("k").alias("id"), F.when(F.col("code") == "", "").otherwise(code.finalized("code")).alias("code"), F.create_map(F.lit("df1"), F.lit(CSV)).alias("tables"))
    # precheck sees the helper as well; it is allowed code.
    ran = code.execute(rows, cross_check=True)
    agree = F.coalesce(F.col("alt_error").isNull() & (F.abs(F.col("alt_answer") - F.col("answer")) <= 1e-6), F.lit(False))
    return ran.select(F.col("id").alias("k"), "ok", "answer", agree.alias("agree"))


def _results(spark, sf_dir):
    """Retrieval results: for each region a question whose candidates are its report's tables and the orders' table."""
    t = headers.split_header(markup.extract_tables(region_reports(spark, sf_dir).unionByName(order_reports(spark, sf_dir)))).where("closed")
    c = t.select("table_ref", "doc_name", "ticker", "year", "scope", "line", "page", F.row_number().over(_by_doc()).alias("rank"), F.lit(1.0).alias("score"), "context_before", headers.table_csv(F.col("header"), F.col("rows"), 6000).alias("csv_text"))
    regions = c.where("ticker <> 'ORD'").groupBy("ticker").agg(F.array_sort(F.collect_list(F.struct("rank", F.struct(*c.columns).alias("c")))).alias("x"))
    ids = regions.select(F.substring("ticker", 3, 9).try_cast("int").alias("id"), F.concat(F.lit("Số cuối năm 2023 của "), F.col("ticker"), F.lit(" là bao nhiêu triệu đồng?")).alias("question"), F.array("ticker").alias("tickers"), F.array(F.lit(2023)).alias("years"), F.lit(None).cast("string").alias("scope"), F.transform("x", lambda v: v["c"]).alias("candidates"))
    return ids


def _by_doc():
    from pyspark.sql import Window

    return Window.partitionBy("doc_name").orderBy("order")


def prompts(spark, sf_dir):
    """Prompts for all regions under a budget: how many tables fit, and what the hint says."""
    p = prompt.build_prompts(_results(spark, sf_dir), 4, 6000, 16000)
    return p.select("id", "n_tables", F.array_join(F.transform("variables", lambda v: v["variable"]), ",").alias("variables"), F.col("user").contains("read .iloc[:, 3]").alias("names_column"), F.col("user").contains("unit conversion: ÷ 1.000.000").alias("names_factor"), (F.length("system") + F.length("user") <= 16000).alias("fits"))


def predictions_and_assembly(spark, sf_dir):
    """From results over stub predictions to submission rows, answers run again on the tables."""
    config = load_config()
    results = _results(spark, sf_dir).cache()
    made = generation.predict(results, config, isolated=False).cache()
    questions = results.select("id", "question").unionByName(spark.createDataFrame([(99, "thiếu")], "id int, question string"))
    items, _, _ = assembly.assemble(questions, results, made, None, config, isolated=False)
    return items.select("id", "answer", F.array_join("relevant_docs", ",").alias("docs"), F.size("relevant_tables").alias("tables"), F.array_join(F.transform("evidence", lambda e: e["csv_path"]), ",").alias("evidence"), (F.col("pandas_query") == "").alias("empty"))


QUERIES = {
    f.__name__: f
    for f in (unit_factors, answer_units, column_periods, target_columns, header_tiers, markup_grids, code_checks, code_extraction, code_runs, prompts, predictions_and_assembly)
}


def _stated(columns: str, rows, names: str) -> str:
    return f"SELECT {columns} FROM {sql_values([(k, *r) for k, r in enumerate(rows)], names)}"


ORACLE_SQL = {
    "unit_factors": _stated("k, name, want::DOUBLE AS factor", UNITS, "k, name, want"),
    "answer_units": _stated("k, f::DOUBLE AS factor, n AS no_conversion, a AS assumed", ASKED, "k, q, f, n, a"),
    "column_periods": _stated("k, name, p AS period, y::DOUBLE AS year", PERIODS, "k, name, p, y"),
    "target_columns": _stated("k, want::DOUBLE AS target", [r[4:] for r in TARGETS], "k, want"),
    "header_tiers": _stated("k, h AS header, n::INT AS left", [("#".join(h), n) for _, h, n in GRIDS], "k, h, n"),
    "markup_grids": _stated("k, g AS grid", [(";".join(",".join(r) for r in g),) for _, g in MARKUP], "k, g"),
    "code_checks": _stated("k, want AS allowed", [r[1:] for r in CHECKS], "k, want"),
    "code_extraction": _stated("k, want AS code", [r[1:] for r in COMPLETIONS], "k, want"),
    "code_runs": _stated("k, o AS ok, v::DOUBLE AS answer, a AS agree", [r[1:] for r in RUNS], "k, o, v, a"),
    "prompts": "SELECT r_regionkey AS id, 2::INT AS n_tables, 'df1,df2' AS variables, true AS names_column, true AS names_factor, true AS fits FROM region WHERE r_regionkey IN (SELECT n_regionkey FROM nation)",
    # The stub counts the plain numbers of a table's last column; balances in parentheses count, and those of two marks don't.
    "predictions_and_assembly": """WITH b AS (SELECT n_regionkey, n_nationkey, coalesce(sum(c_acctbal), 0) AS s FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey GROUP BY ALL),
        r AS (SELECT r_regionkey AS id, 'R' || r_regionkey || '_' || r_name || '_2023_consolidated' AS doc, count(*)::DOUBLE AS n FROM region JOIN b ON r_regionkey = n_regionkey GROUP BY ALL)
        SELECT id::INT AS id, n AS answer, doc AS docs, 2::INT AS tables, 'data/' || doc || '_table_4.csv' AS evidence, false AS empty FROM r UNION ALL SELECT 99, 0.0, '', 0, '', true""",
}
