"""Assembly, its re-execution, and what the validator finds, one broken rule at a time."""

import pytest
from pyspark.sql import functions as F

from gridquill import schema
from gridquill.config import load_config
from gridquill.operators import assembly, probe, prompt, ranking

CSV = "Mã số,Chỉ tiêu,Số cuối năm\n110,Tiền,1.234\n120,Nợ,500\n"


def candidate(line, csv=CSV, ticker="AAA"):
    return (f"AAA_2020|{line}", "AAA_2020", ticker, 2020, None, line, 1, 0, 1.0, "Đơn vị: VND", csv)


@pytest.fixture(scope="module")
def made(spark):
    q = spark.createDataFrame([(k, f"câu {k}") for k in range(1, 7)], schema.QUESTIONS)
    r = spark.createDataFrame([(k, f"câu {k}", ["AAA"], [2020], None, [candidate(5), candidate(9, "")]) for k in range(1, 6)], schema.RETRIEVAL)
    e = lambda *names: [(n, f"data/AAA_2020_table_{line}.csv") for n, line in names]
    p = spark.createDataFrame(
        [
            (1, "result = float(len(df1))", 7.0, e(("df1", 5)), ["AAA_2020|5"], True, None, None), (2, "result = missing", 999.0, e(("df1", 5)), ["AAA_2020|5"], True, None, None),
            (3, "result = float(len(df1[df1['Mã số'] == '110']))", 1.0, e(("df1", 5), ("df1", 9), ("df2", 77)), ["AAA_2020|5"], True, None, None), (4, "", 3.0, [], [], False, None, None),
            (5, "result = 2.0", 2.0, e(("df1", 9)), ["AAA_2020|9"], True, None, None),
        ], schema.PREDICTIONS,
    )
    stored = spark.createDataFrame([("AAA_2020|9", "a,b\n1,2\n")], "table_ref string, csv_text string")
    items, report, assets = assembly.assemble(q, r, p, stored, load_config(), isolated=False)
    return items.cache(), report.cache(), assets.cache()


def test_answers(made):
    got = {r.id: r for r in made[0].collect()}
    assert {k: r.answer for k, r in got.items()} == {1: 2.0, 2: 999.0, 3: 1.0, 4: 3.0, 5: 2.0, 6: 0.0}
    assert [x.variable for x in got[3].evidence] == ["df1"] and got[4].evidence[0].csv_path == "data/AAA_2020_table_5.csv" and got[6].evidence == []
    assert got[1].relevant_tables == ["AAA_2020|5", "AAA_2020|9"] and got[1].relevant_docs == ["AAA_2020"] and got[6].relevant_tables == []


def test_report(made):
    assert sorted((r.id, r.status) for r in made[1].collect()) == [(1, "mismatch_fixed"), (2, "failed"), (3, "fragile_to_default_reader"), (4, "skipped")]
    assert {r.file_name: r.csv_text for r in made[2].collect()} == {"AAA_2020_table_5.csv": CSV, "AAA_2020_table_9.csv": "a,b\n1,2\n"}
    assert assembly.assembly_stats(*made).first().asDict() == {"items": 6, "empty_query": 2, "failed": 1, "fragile_to_default_reader": 1, "mismatch_fixed": 1, "skipped": 1, "csv_files": 2}


def test_a_good_submission_is_valid(made, spark):
    files = made[2].select(F.concat(F.lit("data/"), "file_name").alias("csv_path"))
    assert assembly.validate(made[0], made[0].select("id"), files).count() == 0
    extra = files.union(spark.createDataFrame([("data/x.csv",)], "csv_path string"))
    assert [r.csv_path for r in assembly.orphan_files(made[0], extra).collect()] == ["data/x.csv"]


GOOD = (1, "q", 1.0, ["d"], ["d|3"], [("df1", "data/a.csv")], "result = 1")


@pytest.mark.parametrize(
    ("field", "value", "rule"),
    [
        (0, None, "id"), (1, "", "question"), (1, None, "question"), (2, None, "answer"), (2, float("nan"), "answer"), (3, ["e"], "relevant_docs"), (4, ["d3"], "table_ref"), (4, ["d|x"], "table_ref"), (5, [("1x", "data/a.csv")], "variable"),
        (5, [("df1", "data/a.csv"), ("df1", "data/a.csv")], "variable_twice"), (5, [("df1", "/abs.csv")], "csv_path"), (5, [("df1", "data/../a.csv")], "csv_path"), (5, [("df1", "data/gone.csv")], "file_missing"), (6, None, "pandas_query"),
        (0, 8, "id_unknown"),
    ],
)
def test_broken_rules(field, value, rule, spark):
    row = list(GOOD)
    row[field] = value
    items = spark.createDataFrame([tuple(row)], schema.SUBMISSION)
    files = spark.createDataFrame([("data/a.csv",)], "csv_path string")
    found = {r.rule for r in assembly.validate(items, spark.createDataFrame([(1,)], "id int"), files).collect()}
    assert rule in found and assembly.validate(spark.createDataFrame([GOOD, GOOD], schema.SUBMISSION)).first().rule == "id_twice"


def test_budget_drops_last_tables(spark):
    r = spark.createDataFrame([(1, "Tiền cuối năm 2020 là bao nhiêu triệu đồng?", ["AAA"], [2020], None, [candidate(k, "a,b\n" + "x,1\n" * 400) for k in range(5)]), (2, "không có bảng", [], [], None, [])], schema.RETRIEVAL)
    n = lambda budget: {x.id: x.n_tables for x in prompt.build_prompts(r, 4, None, budget).collect()}
    assert n(None) == {1: 4, 2: 0} and n(6500) == {1: 2, 2: 0} and n(10) == {1: 1, 2: 0}
    built = {x.id: x for x in prompt.build_prompts(r, 2, 50, 16000).collect()}
    assert prompt.NO_TABLES in built[2].user and 'source="AAA_2020|1"' in built[1].user and [v.variable for v in built[1].variables] == ["df1", "df2"]
    assert "* unit of the answer: triệu đồng;" in built[1].user and "{{" not in built[1].user and built[1].user.count("x,1") < 30


def test_quota_keeps_a_wrong_ticker(spark):
    rows = [(1, k, f"d|{k}", "ZZZ" if k else "AAA", 2020, None, ["AAA"], [], None) for k in (1, 2, 3, 0)]
    hits = spark.createDataFrame([(q, n, *rest) for n, (q, _, *rest) in enumerate(rows)], "qid int, rank int, table_ref string, ticker string, year int, scope string, asked_tickers array<string>, asked_years array<int>, asked_scope string")
    got = ranking.select_candidates(ranking.annotate(hits), 3, 1).orderBy("pos").collect()
    assert [r.table_ref for r in got] == ["d|0", "d|1", "d|2"] and got[1].reasons == ["ticker_mismatch"]
    assert ranking.select_candidates(ranking.annotate(hits), 0, 1).count() == 0


def test_year_after_counts_as_near(spark):
    rows = spark.createDataFrame([(2020, [2019], True), (2021, [2019], False), (None, [2019], True), (2021, [], True)], "y int, ys array<int>, want boolean")
    assert all(r.got == r.want for r in rows.select("want", ranking.year_ok(F.col("y"), F.col("ys")).alias("got")).collect())


def test_probe_counts(spark):
    row = lambda k, t, cands: (k, "q", t, [2020], "separate", [candidate(c, ticker=x) for c, x in enumerate(cands)])
    r = spark.createDataFrame([row(1, ["AAA", "BBB"], ["BBB", "AAA"]), row(2, ["AAA"], []), row(3, ["AAA"], ["AAA"])], schema.RETRIEVAL).withColumn("ticker_in_parens", F.array(F.lit("AAA")))
    assert probe.report(r).first().asDict() == {"questions": 3, "empty": 1, "top1_zero": 0, "with_paren_ticker": 2, "with_year": 2, "top1_year_match": 2, "with_scope": 2, "top1_scope_match": 0}
    assert [tuple(x) for x in probe.extra_tickers(r).collect()] == [("BBB", 1, 1)]
    assert [x.id for x in probe.examples(r, 2).collect()] == [1, 2]
