"""The steps over files, from report texts to the archive."""

import json
import zipfile

import pytest
from pyspark.sql import functions as F

from gridquill import cli
from gridquill.sources import documents, files
from gridquill.streaming.incremental import latest, read_runs, run_new_files

TABLE = '<table><tr><th rowspan="2">Chỉ tiêu</th><th colspan="2">Số cuối năm</th></tr><tr><th>Giá trị VND</th><th>Dự phòng VND</th></tr><tr><td>Tiền gửi</td><td>1.234.000.000</td><td>(5)</td></tr><tr><td>Hàng tồn kho</td><td>2.000</td><td>3</td></tr></table>'


def report(tree, ticker, year, name, body):
    folder = tree / ticker / str(year) / name
    folder.mkdir(parents=True)
    (folder / f"{name}_extracted.txt").write_text(body, encoding="utf-8")


@pytest.fixture
def tree(tmp_path):
    root = tmp_path / "fs"
    report(root, "aaa", 2020, "AAA_BCTC_2020_HopNhat", f"===== PAGE 3 =====\r\nBẢNG CÂN ĐỐI\nĐơn vị: VND\n{TABLE}\n<table><tr><td>chữ</td></tr></table>\n")
    report(root, "bbb", 2021, "BBB_BCTC_2021_CongTyMe", f"Thuyết minh\n{TABLE}\n")
    (tmp_path / "companies.csv").write_text("﻿Mã CK,Tên công ty\naaa,CTCP Alpha Beta Gamma\n,trống\nbbb,Cũ\nBBB,CTCP Delta Epsilon\n", encoding="utf-8")
    (tmp_path / "q.jsonl").write_text('{"id": 2, "question": "Tiền gửi cuối năm 2021 của BBB là bao nhiêu triệu đồng?"}\n\n{"id": 1, "question": "Tiền gửi của Alpha Beta Gamma cuối năm 2020 là bao nhiêu tỷ đồng (AAA)?"}\n', encoding="utf-8")
    return tmp_path


def test_listing(spark, tree):
    rows = documents.sorted_documents(documents.list_documents(spark, f"{tree}/fs")).collect()
    assert [(r.ticker, r.year, r.scope, r.doc_name) for r in rows] == [("AAA", 2020, "consolidated", "AAA_BCTC_2020_HopNhat"), ("BBB", 2021, "separate", "BBB_BCTC_2021_CongTyMe")]
    texts = documents.scan_documents(spark, f"{tree}/fs")
    assert all("\r" not in r.text for r in texts.collect())
    assert documents.changed_documents(texts, texts).count() == 0
    companies = {r.ticker: r.name for r in files.read_companies(spark, f"{tree}/companies.csv").collect()}
    assert companies == {"AAA": "CTCP Alpha Beta Gamma", "BBB": "CTCP Delta Epsilon"}


def test_all_steps(spark, tree, capsys, monkeypatch):
    monkeypatch.setattr(cli, "session", lambda: spark)

    def step(*argv):
        assert cli.main([*argv]) == 0
        return json.loads(capsys.readouterr().out)

    t = str(tree)
    stats = step("extract", "--statements-dir", f"{t}/fs", "--cache-dir", f"{t}/tables", "--index-path", f"{t}/index", "--company-meta", f"{t}/companies.csv")
    assert (stats["documents"], stats["tables"], stats["indexed"]) == (2, 3, 2)
    again = step("extract", "--statements-dir", f"{t}/fs", "--cache-dir", f"{t}/tables", "--index-path", f"{t}/index", "--company-meta", f"{t}/companies.csv")
    assert again == stats
    got = step("retrieve", "--questions", f"{t}/q.jsonl", "--index-path", f"{t}/index", "--bm25-cache-dir", f"{t}/bm25", "--tables-cache-dir", f"{t}/tables", "--company-meta", f"{t}/companies.csv", "--out", f"{t}/results")
    assert (got["questions"], got["empty"], got["with_ticker"]) == (2, 0, 2)
    rows = {r.id: r for r in files.read_retrieval(spark, f"{t}/results").collect()}
    assert rows[1].tickers == ["AAA"] and rows[1].candidates[0].ticker == "AAA" and rows[2].candidates[0].ticker == "BBB"
    assert rows[1].candidates[0].csv_text.startswith("Chỉ tiêu,Số cuối năm | Giá trị VND,Số cuối năm | Dự phòng VND\n") and rows[1].candidates[0].page == 3
    probe = step("probe", "--retrieval", f"{t}/results", "--company-meta", f"{t}/companies.csv")
    assert probe["hit_rate"]["top1"] == 1.0 and probe["parser"] == {"agree": 1}
    made = step("generate", "--retrieval", f"{t}/results", "--out", f"{t}/predictions", "--dry-run")
    assert made == {"predictions": 2, "exec_ok": 2}
    assert step("generate", "--retrieval", f"{t}/results", "--out", f"{t}/predictions", "--dry-run") == made
    done = step("assemble", "--questions", f"{t}/q.jsonl", "--retrieval", f"{t}/results", "--predictions", f"{t}/predictions", "--build-dir", f"{t}/build")
    assert (done["items"], done["validation_errors"], done["csv_files"], done["failed"]) == (2, 0, 2, 0)
    assert step("zip", "--build-dir", f"{t}/build", "--questions", f"{t}/q.jsonl", "--check-only") == {"errors": []}
    step("zip", "--build-dir", f"{t}/build", "--questions", f"{t}/q.jsonl", "--zip-path", f"{t}/out.zip")
    names = zipfile.ZipFile(f"{t}/out.zip").namelist()
    assert names[0] == "submission.json" and len(names) == 3
    (tree / "build/data").joinpath(names[1].split("/")[1]).unlink()
    with pytest.raises(files.InvalidSubmission, match="file_missing"):
        cli.main(["zip", "--build-dir", f"{t}/build", "--questions", f"{t}/q.jsonl", "--zip-path", f"{t}/out2.zip"])


def test_predictions_take_the_last_good_line(spark, tmp_path):
    (tmp_path / "p.jsonl").write_text('{"id": 1, "answer": 1.0}\n{"id": 1, "answer": 2.0}\nbroken{\n{"id": 2, "answer": null}\n')
    got = {r.id: r.answer for r in files.read_predictions(spark, f"{tmp_path}/p.jsonl").collect()}
    assert got == {1: 2.0, 2: None}
    assert sorted(r.id for r in files.existing_ids(spark, f"{tmp_path}/p.jsonl").collect()) == [1, 2]
    assert files.existing_ids(spark, f"{tmp_path}/none").count() == 0


def test_strict_json(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"id": 1, "question": "x"}\n')
    (tmp_path / "b.jsonl").write_text('{"id": 1, "question": "x", "more": 2}\n')
    assert files.read_strict(spark, f"{tmp_path}/a.jsonl", "id int, question string").count() == 1
    with pytest.raises(Exception, match="unknown field"):
        files.read_strict(spark, f"{tmp_path}/b.jsonl", "id int, question string").collect()


def test_csv_readings(spark, tmp_path):
    (tmp_path / "c.csv").write_text('a,b\n110,\n120,"x ""y"""\n')
    assert [tuple(r) for r in files.read_csv_text(spark, f"{tmp_path}/c.csv").collect()] == [("110", ""), ("120", 'x "y"')]
    assert dict(files.read_csv_inferred(spark, f"{tmp_path}/c.csv").dtypes)["a"] == "int"


def test_new_files_are_added_once(spark, tmp_path):
    def put(name, rows):
        spark.createDataFrame(rows, "k string, v int").coalesce(1).write.mode("append").json(f"{tmp_path}/in")

    run = lambda: run_new_files(spark, f"{tmp_path}/in", "k string, v int", f"{tmp_path}/out", f"{tmp_path}/log", lambda d: d.withColumn("w", F.col("v") * 2), "json")
    put("a", [("x", 1), ("y", 2)])
    assert run() == 1 and run() == 0
    put("b", [("x", 5)])
    assert run() == 1
    rows = read_runs(spark, f"{tmp_path}/out")
    assert sorted((r.k, r.w) for r in rows.collect()) == [("x", 2), ("x", 10), ("y", 4)]
    assert sorted((r.k, r.w) for r in latest(rows, ["k"]).collect()) == [("x", 10), ("y", 4)]


def test_changed_documents_only_are_extracted_again(spark, tmp_path):
    """Two documents of one company: one is edited, then one is removed; the cache equals a full rebuild each time."""
    from gridquill.operators import headers, markup
    from gridquill.sources.cache import TableCache

    root, body = tmp_path / "fs", "x\n<table><tr><td>a</td><td>{}</td></tr></table>\n"
    for name, value in (("D1_2020", 1), ("D2_2021", 2), ("notable_2021", None)):
        report(root, "aaa", 2020, name, body.format(value) if value else "no table")
    cache, read = TableCache(spark, f"{tmp_path}/cache"), []

    def extract(docs):
        read.append(sorted(r.doc_name for r in docs.select("doc_name").collect()))
        return headers.split_header(markup.extract_tables(docs))

    def run():
        listed = documents.list_documents(spark, str(root))
        number = cache.update(listed, extract, str(root))
        return number, sorted((r.doc_name, r.grid[0][1]) for r in cache.tables(listed).collect())

    assert run() == (1, [("D1_2020", "1"), ("D2_2021", "2")]) and run()[0] is None
    (root / "aaa/2020/D2_2021/D2_2021_extracted.txt").write_text(body.format(22), encoding="utf-8")
    assert run() == (2, [("D1_2020", "1"), ("D2_2021", "22")])
    (root / "aaa/2020/D1_2020/D1_2020_extracted.txt").unlink()
    assert run() == (None, [("D2_2021", "22")])
    assert read == [["D1_2020", "D2_2021", "notable_2021"], ["D2_2021"]]


def test_later_predictions_win(spark, tmp_path):
    from gridquill import schema

    row = lambda k, answer: spark.createDataFrame([(k, "", answer, [], [], True, None, None)], schema.PREDICTIONS)
    for n in range(12):
        assert files.append_predictions(row(1, float(n)).union(row(2, -float(n))).repartition(3), f"{tmp_path}/p") == n + 1
    got = {r.id: r.answer for r in files.read_predictions(spark, f"{tmp_path}/p").collect()}
    assert got == {1: 11.0, 2: -11.0} and sorted(r.id for r in files.existing_ids(spark, f"{tmp_path}/p").collect()) == [1, 2]
    files.append_predictions(row(1, 0.5), f"{tmp_path}/shard")
    both = files.read_predictions(spark, [f"{tmp_path}/p", f"{tmp_path}/shard"])
    assert {r.id: r.answer for r in both.collect()} == {1: 0.5, 2: -11.0}


def test_strict_json_looks_into_arrays(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"id": 1, "c": [{"x": 1}, {"x": 2}]}\n')
    (tmp_path / "b.jsonl").write_text('{"id": 1, "c": [{"x": 1}, {"x": 2, "z": 3}]}\n')
    assert files.read_strict(spark, f"{tmp_path}/a.jsonl", "id int, c array<struct<x:int>>").count() == 1
    with pytest.raises(Exception, match="unknown field: z"):
        files.read_strict(spark, f"{tmp_path}/b.jsonl", "id int, c array<struct<x:int>>").collect()
