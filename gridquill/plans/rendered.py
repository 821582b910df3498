"""Reports rendered from relational tables, so that table extraction has inputs whose contents are known."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numbers import format_vn


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _row(*cells: Column, tag: str = "td") -> Column:
    return F.concat(F.lit("<tr>"), *[F.concat(F.lit(f"<{tag}>"), c, F.lit(f"</{tag}>")) for c in cells], F.lit("</tr>"))


def nation_balances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(n_regionkey, n_nationkey, n_name, customers, balance) of all customers; few rows, one for each nation."""
    sums = read(spark, sf_dir, "customer").groupBy("c_nationkey").agg(F.count("*").alias("customers"), F.round(F.sum("c_acctbal"), 2).alias("balance"))
    nations = read(spark, sf_dir, "nation").join(sums, F.col("n_nationkey") == F.col("c_nationkey"), "left")
    return nations.select("n_regionkey", "n_nationkey", "n_name", F.coalesce("customers", F.lit(0)).alias("customers"), F.coalesce("balance", F.lit(0.0)).alias("balance"))


def region_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One paged text for each region. Page 1 has a unit line and a table whose first column spans all rows; page 2
    has an unclosed table in regions of even key, and a table of text only in all."""
    rows = nation_balances(spark, sf_dir).groupBy("n_regionkey").agg(F.array_sort(F.collect_list(F.struct("n_nationkey", "n_name", "customers", "balance"))).alias("nations"))
    joined = read(spark, sf_dir, "region").join(rows, F.col("r_regionkey") == F.col("n_regionkey"))
    cell = lambda x: F.concat(F.lit("<td>"), x, F.lit("</td>"))
    data = F.transform("nations", lambda n, i: F.concat(
        F.lit("<tr>"), F.when(i == 0, F.concat(F.lit('<td rowspan="'), F.size("nations").cast("string"), F.lit('">'), F.col("r_name"), F.lit("</td>"))).otherwise(F.lit("")),
        cell(n["n_name"]), cell(n["customers"].cast("string")), cell(format_vn(n["balance"])), F.lit("</tr>"),
    ))
    table = F.concat(F.lit("<table>"), _row(*map(F.lit, ("Khu vực", "Quốc gia", "Số khách", "Số cuối năm VND")), tag="th"), F.array_join(data, ""), F.lit("</table>"))
    broken = F.when(F.col("r_regionkey") % 2 == 0, F.lit("<table><tr><td>mất thẻ đóng</td></tr>\n")).otherwise(F.lit(""))
    names = F.concat(F.lit("<table>"), F.array_join(F.transform("nations", lambda n: F.concat(F.lit("<tr>"), cell(n["n_name"]), cell(F.lit("ghi chú")), F.lit("</tr>"))), ""), F.lit("</table>"))
    text = F.concat(
        F.lit("===== PAGE 1 =====\nBÁO CÁO "), F.col("r_name"), F.lit("\nĐơn vị: VND\n"), table, F.lit("\n===== PAGE 2 =====\nThuyết minh\n"), broken, names, F.lit("\nHết\n"),
    )
    return joined.select(
        F.concat(F.lit("R"), F.col("r_regionkey").cast("string"), F.lit("_"), F.col("r_name"), F.lit("_2023_consolidated")).alias("doc_name"),
        F.concat(F.lit("R0"), F.col("r_regionkey").cast("string")).alias("ticker"), F.lit(2023).alias("year"), F.lit("consolidated").alias("scope"), text.alias("text"),
    )


def order_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(priority, year, orders, total) of all orders."""
    return read(spark, sf_dir, "orders").groupBy(F.col("o_orderpriority").alias("priority"), F.year("o_orderdate").alias("year")).agg(F.count("*").alias("orders"), F.round(F.sum("o_totalprice"), 2).alias("total"))


def order_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One text with a table of priorities by years under a header of two tiers: years span two columns each."""
    # Totals are a few rows, one for each priority and year, so one row can hold them all.
    every = order_totals(spark, sf_dir).groupBy().agg(F.array_sort(F.collect_set("year")).alias("years"), F.array_sort(F.collect_set("priority")).alias("priorities"), F.collect_list(F.struct("priority", "year", "orders", "total")).alias("cells"))
    of = lambda p, y: F.get(F.filter("cells", lambda c: (c["priority"] == p) & (c["year"] == y)), F.lit(0))
    cell = lambda x: F.concat(F.lit("<td>"), F.coalesce(x, F.lit("")), F.lit("</td>"))
    line = lambda p: F.concat(
        F.lit("<tr>"), cell(p), F.array_join(F.transform("years", lambda y: F.concat(cell(of(p, y)["orders"].cast("string")), cell(format_vn(of(p, y)["total"])))), ""), F.lit("</tr>"),
    )
    body = every.where(F.size("years") > 0)
    head = F.concat(
        F.lit('<tr><th rowspan="2">Ưu tiên</th>'), F.array_join(F.transform("years", lambda y: F.concat(F.lit('<th colspan="2">Năm '), y.cast("string"), F.lit("</th>"))), ""), F.lit("</tr><tr>"),
        F.array_join(F.transform("years", lambda y: F.lit("<th>Số đơn</th><th>Giá trị đồng</th>")), ""), F.lit("</tr>"),
    )
    text = F.concat(F.lit("===== PAGE 7 =====\nĐơn hàng theo năm\n<table>"), head, F.array_join(F.transform("priorities", line), ""), F.lit("</table>\n"))
    return body.select(F.lit("ORD_DonHang_2024_separate").alias("doc_name"), F.lit("ORD").alias("ticker"), F.lit(2024).alias("year"), F.lit("separate").alias("scope"), text.alias("text"))
