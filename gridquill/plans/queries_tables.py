"""Queries on numbers, texts, table extraction, headers and cell plans."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import numbers, text
from ..operators import headers, markup
from ..sources import documents
from . import cells
from .rendered import nation_balances, order_reports, order_totals, read, region_reports

#: Spellings of numbers, with the strict and the lax reading.
EDGES = (
    ("1.234.567", 1234567.0, 1234567.0), ("1.234", 1234.0, 1234.0), ("1.23", 1.23, 1.23), ("1,234", 1.234, 1.234), ("1,234,567", 1234567.0, 1234567.0), ("1.234,56", 1234.56, 1234.56),
    ("1,234,567.89", 1234567.89, 1234567.89), ("(1.234)", -1234.0, -1234.0), ("(12,5)", -12.5, -12.5), ("12,5%", 12.5, 12.5), ("(-5)", 5.0, 5.0), ("--5", 5.0, 5.0), ("1,2,3", None, None), ("(5)%", None, None),
    ("", None, None), ("abc", None, None), ("Ghi chú 5", None, None), ("1e5", None, 100000.0), ("1_000", None, 1000.0), ("+7", 7.0, 7.0), ("-3,5", -3.5, -3.5), (" 42 ", 42.0, 42.0), ("1 234", 1234.0, 1234.0), ("-", None, None), ("5d", None, None),
)


def number_edges(spark, sf_dir):
    rows = spark.createDataFrame([(k, e[0]) for k, e in enumerate(EDGES)], "k int, raw string")
    return rows.select("k", "raw", numbers.parse_number(F.col("raw")).alias("strict"), numbers.to_num(F.col("raw")).alias("lax"), numbers.is_numeric_cell(F.col("raw")).alias("is_number"))


def sql_values(rows, names: str) -> str:
    def literal(v) -> str:
        if v is None:
            return "NULL"
        if isinstance(v, bool):
            return str(v).lower()
        if isinstance(v, (int, float)):
            return f"CAST('{v!r}' AS DOUBLE)" if isinstance(v, float) else str(v)
        if isinstance(v, (list, tuple)):
            return "[" + ", ".join(map(literal, v)) + "]"
        return "'" + str(v).replace("'", "''") + "'"

    return f"(VALUES {', '.join('(' + ', '.join(map(literal, r)) + ')' for r in rows)}) AS t({names})"


def number_roundtrip(spark, sf_dir):
    """Every balance formatted in Vietnamese notation and read again."""
    rows = read(spark, sf_dir, "customer").select("c_custkey", numbers.format_vn(F.col("c_acctbal")).alias("shown"))
    return rows.select("c_custkey", F.round(numbers.parse_number(F.col("shown")), 2).alias("value"), numbers.to_num(F.col("shown")).isNotNull().alias("readable"))


def number_sums(spark, sf_dir):
    """Sums over formatted prices."""
    rows = read(spark, sf_dir, "lineitem").select("l_returnflag", "l_linestatus", numbers.format_vn(F.col("l_extendedprice")).alias("shown"))
    return rows.groupBy("l_returnflag", "l_linestatus").agg(F.round(F.sum(numbers.parse_number(F.col("shown"))), 2).alias("total"), F.count("*").alias("n"))


def answer_tolerance(spark, sf_dir):
    """Which of a price's near values count as the same answer."""
    rows = read(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", (F.col("o_totalprice") * (1 + (F.col("o_orderkey") % 5) * 1e-4)).alias("other"))
    return rows.groupBy((F.col("o_orderkey") % 5).alias("step")).agg(F.count_if(numbers.answers_match(F.col("o_totalprice"), F.col("other"))).alias("matches"), F.count("*").alias("n"))


def ascii_folding(spark, sf_dir):
    """Texts without diacritics: their letters and digits, and their number of words."""
    d = read(spark, sf_dir, "documents")
    return d.select("doc_id", F.md5(text.ascii_compact(F.col("text"))).alias("compact_md5"), F.size(text.ascii_tokens(F.col("text"))).cast("long").alias("tokens"))


def casefold_tokens(spark, sf_dir):
    d = read(spark, sf_dir, "documents").select("doc_id", text.tokenize(F.col("text")).alias("t"))
    return d.select("doc_id", F.size("t").cast("long").alias("tokens"), F.md5(F.array_join("t", " ")).alias("tokens_md5"))


def text_tools(spark, sf_dir):
    """Parentheses cut out, table references read, thousands grouped, file names made, over all orders."""
    o = read(spark, sf_dir, "orders")
    ref = text.table_ref(F.concat(F.lit("D|"), F.col("o_orderpriority")), F.col("o_orderkey"))
    got = text.parse_table_ref(ref)
    return o.select(
        "o_orderkey", text.strip_parens(F.concat(F.col("o_orderpriority"), F.lit(" (mã "), F.col("o_custkey").cast("string"), F.lit(")"))).alias("bare"), got["doc_name"].alias("doc_name"), got["line"].alias("line"),
        text.csv_file_name(got["doc_name"], got["line"]).alias("file_name"), text.thousands(F.floor("o_totalprice")).alias("price"),
    )


def company_alias(spark, sf_dir):
    """Aliases of names that begin with a legal form."""
    n = read(spark, sf_dir, "supplier").select("s_suppkey", F.concat(F.when(F.col("s_suppkey") % 2 == 0, F.lit("CTCP Tập đoàn ")).otherwise(F.lit("Công ty TNHH ")), F.col("s_name")).alias("name"))
    return n.select("s_suppkey", F.array_join(text.company_aliases(F.col("name")), ",").alias("aliases"))


def document_paths(spark, sf_dir):
    """Name, ticker, year and kind of report from paths made of orders."""
    o = read(spark, sf_dir, "orders")
    kind = F.when(F.col("o_orderkey") % 3 == 0, "HopNhat").when(F.col("o_orderkey") % 3 == 1, "CongTyMe").otherwise("Khac")
    name = F.concat(F.lit("T"), F.col("o_custkey").cast("string"), F.lit("_BaoCao_"), (F.year("o_orderdate") + 20).cast("string"), F.lit("_"), kind)
    folder = F.when(F.col("o_orderkey") % 2 == 0, F.concat(F.lit("/"), (F.year("o_orderdate") + 21).cast("string"))).otherwise(F.lit(""))
    path = F.concat(F.lit("/data/fs/t"), F.col("o_custkey").cast("string"), folder, F.lit("/"), name, F.lit("_extracted.txt"))
    rows = o.select("o_orderkey", path.alias("path")).withColumn("doc_name", documents.doc_name_of(F.col("path")))
    return rows.select("o_orderkey", "doc_name", documents.ticker_of(F.col("path"), "/data/fs").alias("ticker"), documents.year_of(F.col("path"), F.col("doc_name")).alias("year"), documents.scope_of_name(F.col("doc_name")).alias("scope"))


def _tables(spark, sf_dir):
    return headers.split_header(markup.extract_tables(region_reports(spark, sf_dir)))


def grid_rowspan(spark, sf_dir):
    """Cells of the first table of each region report: the region's name spans all rows."""
    t = _tables(spark, sf_dir).where("`order` = 1")
    long = headers.cells(t, ("ticker",))
    wide = long.groupBy("ticker", "row").agg(*[F.max(F.when(F.col("col") == k, F.col("value"))).alias(n) for k, n in enumerate(("region", "nation", "customers", "balance"))])
    return wide.select("region", "nation", F.col("customers").cast("long").alias("customers"), F.round(numbers.parse_number(F.col("balance")), 2).alias("balance"))


def grid_colspan(spark, sf_dir):
    """Counts and totals by year from a table with a header of two tiers; the merged names carry the year."""
    t = headers.split_header(markup.extract_tables(order_reports(spark, sf_dir)))
    long = headers.cells(t)
    label = long.where("col = 0").select("row", F.col("value").alias("priority"))
    num = long.where("col > 0").select("row", F.regexp_extract("col_name", "Năm (\\d+) \\| ", 1).cast("int").alias("year"), F.col("col_name").contains("Số đơn").alias("count"), numbers.parse_number(F.col("value")).alias("v"))
    by = num.groupBy("row", "year").agg(F.max(F.when(F.col("count"), F.col("v"))).cast("long").alias("orders"), F.max(F.when(~F.col("count"), F.col("v"))).alias("total"))
    return by.join(label, "row").select("priority", "year", "orders", F.round("total", 2).alias("total"))


def tables_located(spark, sf_dir):
    """Order, line, page, closedness, size and text before of all tables of the region reports."""
    t = _tables(spark, sf_dir)
    return t.select("doc_name", F.col("order").cast("int").alias("ord"), "line", "page", "closed", "context_before", F.size("grid").alias("grid_rows"), headers.n_cols(F.col("header"), F.col("rows")).alias("cols"), "table_ref")


def tag_balance(spark, sf_dir):
    b = markup.tag_balance(F.col("text"))
    return region_reports(spark, sf_dir).select("doc_name", b["opened"].alias("opened"), b["closed"].alias("closed"))


def pages_without_tables(spark, sf_dir):
    """Opening tags in all raw web pages, and pages' tables: there are none."""
    p = read(spark, sf_dir, "pages").select(F.col("page_id").cast("string").alias("doc_name"), F.col("html").alias("text"))
    located = p.select(F.size(markup.locate(F.col("text"))).alias("n"), markup.tag_balance(F.col("text"))["opened"].alias("opened"))
    return located.agg(F.count("*").alias("pages"), F.sum("n").alias("tables"), F.sum("opened").alias("opened"))


def csv_rendering(spark, sf_dir):
    """CSV of rows that need quotes, and cut to 40 characters."""
    p = read(spark, sf_dir, "part").select("p_partkey", F.array(F.array(F.lit("a,b"), F.col("p_name")), F.array(F.concat(F.lit('"'), F.col("p_brand")), F.col("p_type")), F.array(F.lit(""), F.lit(""))).alias("r"))
    return p.select("p_partkey", headers.to_csv(F.col("r")).alias("csv"), headers.cut_csv(headers.to_csv(F.col("r")), 40).alias("cut"))


def eligible_tables(spark, sf_dir):
    """Tables with cells enough and a number, and their index text."""
    t = _tables(spark, sf_dir)
    names = read(spark, sf_dir, "region").select(F.concat(F.lit("R0"), F.col("r_regionkey").cast("string")).alias("ticker"), F.col("r_name").alias("name"))
    chosen = t.withColumn("ok", headers.eligible(F.col("grid"))).where("ok")
    e = headers.index_entries(chosen, names)
    return e.select("table_ref", "n_rows", "n_cols", "page", F.md5("index_text").alias("text_md5"))


def cell_lookup(spark, sf_dir):
    """For every nation a question: its balance, found by label in the tables of its region's report."""
    nations = read(spark, sf_dir, "nation")
    t = _tables(spark, sf_dir)
    asked = nations.select(F.col("n_nationkey").alias("qid"), F.lit("v").alias("key"), F.col("n_name").alias("label"), F.lit(3).alias("col"), F.lit(0.001).alias("scale"), F.concat(F.lit("R0"), F.col("n_regionkey").cast("string")).alias("ticker"))
    # The label column is the nation's: the region before it spans all rows.
    long = headers.cells(t.where("size(header) = 4"), ("ticker", "order")).where("col > 0").select("ticker", F.col("order").alias("table_pos"), "row", (F.col("col") - 1).alias("col"), "value")
    own = asked.select("qid", "ticker").join(long, "ticker").select("qid", "table_pos", "row", "col", "value")
    exact = own.withColumn("value", F.when(F.col("col") == 0, F.concat(F.col("value"), F.lit("#"))).otherwise(F.col("value")))
    found = cells.lookup(asked.select("qid", "key", F.concat("label", F.lit("#")).alias("label"), (F.col("col") - 1).alias("col"), "scale"), exact)
    return cells.evaluate(found, {"answer": cells.Cell("v")}).select("qid", F.round("answer", 4).alias("answer"))


def _year_values(spark, sf_dir):
    """Totals by priority (qid) and year (key), looked up in the rendered table; a year's column is found by its name."""
    t = headers.split_header(markup.extract_tables(order_reports(spark, sf_dir)))
    long = headers.cells(t).repartition("table_ref", "row")
    names = long.where("row = 0 and col > 0 and col_name like '%Giá trị%'").select("table_ref", "col", F.regexp_extract("col_name", "Năm (\\d+)", 1).alias("key"))
    labels = long.where("col = 0").select("table_ref", "row", F.col("value").alias("qid"))
    asked = labels.join(names, "table_ref").select("qid", "key", F.col("qid").alias("label"), "col", F.lit(1.0).alias("scale"))
    rows = long.join(labels, ["table_ref", "row"]).select("qid", F.lit(0).alias("table_pos"), "row", "col", "value")
    return cells.lookup(asked, rows)


def growth_pct(spark, sf_dir):
    return cells.evaluate(_year_values(spark, sf_dir), {"growth": cells.Growth(cells.Cell("2000"), cells.Cell("1999"))}).select(F.col("qid").alias("priority"), F.round("growth", 6).alias("growth"))


def ratio_and_diff(spark, sf_dir):
    a, b = cells.Cell("1996"), cells.Cell("1995")
    wanted = {"ratio": cells.Ratio(a, b, True), "diff": cells.Diff(a, b), "signed": cells.Diff(a, b, True), "total": cells.Sum((a, b))}
    found = cells.evaluate(_year_values(spark, sf_dir), wanted)
    return found.select(F.col("qid").alias("priority"), *[F.round(n, 6).alias(n) for n in wanted])


QUERIES = {
    f.__name__: f
    for f in (
        number_edges, number_roundtrip, number_sums, answer_tolerance, ascii_folding, casefold_tokens, text_tools, company_alias, document_paths, grid_rowspan, grid_colspan, tables_located, tag_balance,
        pages_without_tables, csv_rendering, eligible_tables, cell_lookup, growth_pct, ratio_and_diff,
    )
}

_BALANCES = "SELECT n_regionkey, n_nationkey, n_name, count(c_custkey) AS customers, round(coalesce(sum(c_acctbal), 0), 2) AS balance FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey GROUP BY ALL"
_YEARS = "SELECT o_orderpriority AS priority, year(o_orderdate) AS year, count(*) AS orders, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY ALL"
#: format_number(x, 2) with Vietnamese marks and parentheses, in DuckDB.
_VN = "(CASE WHEN balance < 0 THEN '(' ELSE '' END || replace(replace(replace(format('{:,.2f}', abs(balance)), ',', '#'), '.', ','), '#', '.') || CASE WHEN balance < 0 THEN ')' ELSE '' END)"
_CSV = "'\"a,b\",' || p_name || chr(10) || '\"\"\"' || p_brand || '\",' || p_type || chr(10) || ',' || chr(10)"

ORACLE_SQL = {
    "number_edges": f"SELECT k, raw, strict::DOUBLE AS strict, lax::DOUBLE AS lax, strict IS NOT NULL AS is_number FROM {sql_values([(k, *e) for k, e in enumerate(EDGES)], 'k, raw, strict, lax')}",
    "number_roundtrip": "SELECT c_custkey, round(c_acctbal, 2) AS value, true AS readable FROM customer",
    "number_sums": "SELECT l_returnflag, l_linestatus, round(sum(l_extendedprice), 2) AS total, count(*) AS n FROM lineitem GROUP BY ALL",
    "answer_tolerance": "SELECT step, count(*) FILTER (abs(a - b) <= 2e-4 * greatest(abs(a), abs(b))) AS matches, count(*) AS n FROM (SELECT o_orderkey % 5 AS step, o_totalprice AS a, o_totalprice * (1 + (o_orderkey % 5) * 1e-4::DOUBLE) AS b FROM orders) GROUP BY step",
    "ascii_folding": "SELECT doc_id, md5(regexp_replace(f, '[^a-z0-9]', '', 'g')) AS compact_md5, len(regexp_extract_all(f, '[a-z0-9]+')) AS tokens FROM (SELECT doc_id, lower(replace(replace(strip_accents(text), 'đ', 'd'), 'Đ', 'D')) AS f FROM documents)",
    "casefold_tokens": "SELECT doc_id, len(t) AS tokens, md5(array_to_string(t, ' ')) AS tokens_md5 FROM (SELECT doc_id, regexp_extract_all(replace(lower(text), 'ß', 'ss'), '[\\p{L}\\p{N}]+') AS t FROM documents)",
    "text_tools": "SELECT o_orderkey, o_orderpriority || '  ' AS bare, 'D|' || o_orderpriority AS doc_name, o_orderkey::INT AS line, 'D|' || o_orderpriority || '_table_' || o_orderkey || '.csv' AS file_name, replace(format('{:,d}', floor(o_totalprice)::BIGINT), ',', '.') AS price FROM orders",
    "company_alias": "SELECT s_suppkey, CASE WHEN s_suppkey % 2 = 0 THEN 'ctcptapdoan' || c || ',' || c ELSE 'congtytnhh' || c || ',' || c END AS aliases FROM (SELECT s_suppkey, regexp_replace(lower(s_name), '[^a-z0-9]', '', 'g') AS c FROM supplier)",
    "document_paths": "SELECT o_orderkey, 'T' || o_custkey || '_BaoCao_' || y || '_' || CASE o_orderkey % 3 WHEN 0 THEN 'HopNhat' WHEN 1 THEN 'CongTyMe' ELSE 'Khac' END AS doc_name, 'T' || o_custkey AS ticker, CASE WHEN o_orderkey % 2 = 0 THEN y + 1 ELSE y END::INT AS year, CASE o_orderkey % 3 WHEN 0 THEN 'consolidated' WHEN 1 THEN 'separate' END AS scope FROM (SELECT *, year(o_orderdate) + 20 AS y FROM orders)",
    "grid_rowspan": f"SELECT r_name AS region, n_name AS nation, customers, balance FROM ({_BALANCES}) JOIN region ON r_regionkey = n_regionkey",
    "grid_colspan": f"SELECT priority, year::INT AS year, orders, total FROM ({_YEARS})",
    "tables_located": f"""WITH b AS ({_BALANCES}), r AS (SELECT r_regionkey, 'R' || r_regionkey || '_' || r_name || '_2023_consolidated' AS doc_name, r_name, count(*) AS n FROM region JOIN b ON r_regionkey = n_regionkey GROUP BY ALL), e AS (SELECT *, r_regionkey % 2 = 0 AS even FROM r), t AS (
        SELECT doc_name, 1 AS ord, 4 AS line, 1 AS page, true AS closed, 'BÁO CÁO ' || r_name || ' Đơn vị: VND' AS context_before, n + 1 AS grid_rows, 4 AS cols FROM e
        UNION ALL SELECT doc_name, 2, 7, 2, false, 'Thuyết minh', 0, 0 FROM e WHERE even
        UNION ALL SELECT doc_name, CASE WHEN even THEN 3 ELSE 2 END, CASE WHEN even THEN 8 ELSE 7 END, 2, true, CASE WHEN even THEN '' ELSE 'Thuyết minh' END, n, 2 FROM e)
        SELECT doc_name, ord::INT AS ord, line::INT AS line, page::INT AS page, closed, context_before, grid_rows::INT AS grid_rows, cols::INT AS cols, doc_name || '|' || line AS table_ref FROM t""",
    "tag_balance": "SELECT 'R' || r_regionkey || '_' || r_name || '_2023_consolidated' AS doc_name, (2 + (r_regionkey % 2 = 0)::INT)::INT AS opened, 2::INT AS closed FROM region WHERE r_regionkey IN (SELECT n_regionkey FROM nation)",
    "pages_without_tables": "SELECT count(*) AS pages, sum(len(regexp_extract_all(html, '(?i)<table\\b')))::BIGINT AS tables, sum(len(regexp_extract_all(html, '(?i)<table\\b')))::BIGINT AS opened FROM pages",
    "csv_rendering": f"SELECT p_partkey, csv, CASE WHEN length(csv) > 40 THEN CASE WHEN instr(left(csv, 40), chr(10)) > 1 THEN regexp_replace(left(csv, 40), '\\n[^\\n]*$', '') ELSE left(csv, 40) END || chr(10) ELSE csv END AS cut FROM (SELECT p_partkey, {_CSV} AS csv FROM part)",
    "eligible_tables": f"""WITH b AS ({_BALANCES}), r AS (SELECT r_regionkey, r_name, 'R' || r_regionkey || '_' || r_name || '_2023_consolidated' AS doc_name, count(*) AS n, string_agg(r_name || ' / ' || n_name, ' | ' ORDER BY n_nationkey) AS labels FROM region JOIN b ON r_regionkey = n_regionkey GROUP BY ALL)
        SELECT doc_name || '|4' AS table_ref, (n + 1)::INT AS n_rows, 4::INT AS n_cols, 1::INT AS page, md5(left('Công ty: ' || r_name || ' (mã R0' || r_regionkey || '), năm 2023, phạm vi consolidated, báo cáo ' || doc_name || '. Ngữ cảnh: BÁO CÁO ' || r_name || ' Đơn vị: VND Cột: Khu vực | Quốc gia | Số khách | Số cuối năm VND. Dòng: ' || labels, 1200)) AS text_md5 FROM r""",
    "cell_lookup": f"SELECT n_nationkey AS qid, round(balance * 0.001, 4) AS answer FROM ({_BALANCES})",
    "growth_pct": f"SELECT priority, round((max(total) FILTER (year = 2000) - max(total) FILTER (year = 1999)) / abs(max(total) FILTER (year = 1999)) * 100, 6) AS growth FROM ({_YEARS}) GROUP BY priority",
    "ratio_and_diff": f"SELECT priority, round(a / b * 100, 6) AS ratio, round(abs(a - b), 6) AS diff, round(a - b, 6) AS signed, round(a + b, 6) AS total FROM (SELECT priority, max(total) FILTER (year = 1996) AS a, max(total) FILTER (year = 1995) AS b FROM ({_YEARS}) GROUP BY priority)",
}
