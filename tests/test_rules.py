import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gridquill.config import DEFAULTS, load_config, merged
from gridquill.functions import numbers, text
from gridquill.operators import code, generation, probe, search
from gridquill.operators.intent import question_intent
from gridquill.plans import cells


@settings(max_examples=200, deadline=None)
@given(st.floats(-1e12, 1e12, allow_nan=False).map(lambda x: round(x, 2)))
def test_formatted_numbers_read_back(x):
    shown = f"{abs(x):,.2f}".translate(str.maketrans(",.", ".,"))
    shown = f"({shown})" if x < 0 else shown
    assert numbers.parse_text(shown) == pytest.approx(x, abs=1e-6)


def test_column_and_python_readings_agree(spark):
    alphabet = ["1", "23", "456", ".", ",", "-", "+", "(", ")", "%", " ", "x"]
    import itertools
    import random

    random.seed(1)
    words = sorted({"".join(random.choices(alphabet, k=k)) for k in range(1, 7) for _ in range(300)} | {"".join(p) for p in itertools.product(alphabet, repeat=2)})
    rows = spark.createDataFrame([(w,) for w in words], "w string").select("w", numbers.parse_number(F.col("w")).alias("a"), numbers.to_num(F.col("w")).alias("b")).collect()
    space: dict = {"pd": pd}
    exec(code.HELPER, space)
    for r in rows:
        assert r.a == numbers.parse_text(r.w), r.w
        assert r.b == space["to_num"](r.w), r.w


def test_results_as_numbers():
    import numpy as np

    assert [numbers.coerce_number(v) for v in (True, float("nan"), float("inf"), np.float64(2), np.int64(3), "1.234,5", None, [1])] == [None, None, None, 2.0, 3.0, 1234.5, None, None]


def test_confusable_companies(spark):
    companies = spark.createDataFrame([("FPT", "CTCP FPT"), ("FTS", "CTCP Chứng khoán FPT"), ("FOX", "CTCP Viễn thông FPT"), ("VIC", "Tập đoàn Vingroup"), ("HT1", "CTCP Xi Măng Vicem Hà Tiên")], "ticker string, name string")
    asked = ["CTCP Chứng khoán FPT năm 2020", "FPT năm 2019-2024, 1999, 2099", "VIC và CTCP Xi Măng Vicem Hà Tiên", "công ty (fpt) và FTS", "fpt viết thường", "báo cáo hợp nhất công ty mẹ"]
    got = {r.id: r for r in question_intent(spark.createDataFrame(list(enumerate(asked)), "id int, question string"), companies).collect()}
    assert [got[k].tickers for k in range(6)] == [["FTS"], ["FPT"], ["HT1", "VIC"], ["FPT", "FTS"], [], []]
    assert got[1].years == [2019, 2024] and got[5].scope is None and got[3].ticker_in_parens == ["FPT"]


def test_search_edges(spark):
    docs = spark.createDataFrame([("a", "x y"), ("b", "x"), ("c", "")], "table_ref string, index_text string")
    index = search.build_index(docs)
    q = spark.createDataFrame([(1, "y y"), (2, ""), (3, "zzz")], "id int, question string")
    assert [(r.qid, r.id) for r in search.search(index, q, 5).collect()] == [(1, "a")]
    padded = search.search(index, q, 2, pad=True).orderBy("qid", "rank").collect()
    assert [(r.qid, r.id) for r in padded] == [(1, "a"), (1, "b"), (3, "a"), (3, "b")]
    assert search.search(index, q, 0).count() == 0


def test_index_is_kept(spark, tmp_path):
    docs = spark.createDataFrame([("a", "x y"), ("b", "x")], "table_ref string, index_text string")
    search.save_index(search.build_index(docs), f"{tmp_path}/i")
    again = search.load_index(spark, f"{tmp_path}/i")
    assert again.n == 2 and search.load_index(spark, f"{tmp_path}/i", "other") is None
    assert search.search(again, spark.createDataFrame([(1, "y")], "id int, question string"), 1).first().id == "a"


def test_ladder_and_shards(spark):
    assert generation.retry_ladder(6) == [6, 3, 2, 1] and generation.retry_ladder(1) == [1] and generation.retry_ladder(4) == [4, 3, 2, 1]
    with pytest.raises(ValueError):
        generation.shard(spark.range(3), 3, 3)


def test_model_is_asked_again_only_without_memory(spark):
    rows = spark.createDataFrame([(1, [("s", "long"), ("s", "short")]), (2, [("s", "bad"), ("s", "short")])], "id int, rungs array<struct<system:string,user:string>>")

    def start():
        def model(system, user):
            if user == "long":
                raise RuntimeError("CUDA out of memory")
            if user == "bad":
                raise ValueError("broken")
            return "result = 1"

        return model

    got = {r.id: r for r in generation.complete(rows, start).collect()}
    assert (got[1].rung, got[1].completion, got[1].error) == (1, "result = 1", None)
    assert (got[2].rung, got[2].completion) == (0, "") and "broken" in got[2].error


def test_time_limit():
    found = code.run_isolated("while True: pass", {}, timeout_s=1)
    assert not found.ok and "timeout" in found.error
    assert code.run_isolated("result = 1", {"df1": None}).error == "no table for df1"


def test_settings(tmp_path):
    path = tmp_path / "c.yaml"
    path.write_text("retrieval: {top_k: 5}")
    assert load_config(path)["retrieval"]["top_k"] == 5 and load_config(path)["retrieval"]["fetch_multiplier"] == 6
    assert load_config(tmp_path / "none.yaml") == DEFAULTS and merged({"a": {"b": 1}}, {"a": 2}) == {"a": 2}
    path.write_text("- 1")
    with pytest.raises(ValueError):
        load_config(path)


def test_percentile_rule(spark):
    d = probe.percentiles(spark.createDataFrame([(x,) for x in (4.0, 1.0, 3.0, 2.0, None)], "x double"), [], "x").first()
    assert (d.min, d.p10, d.p25, d.median, d.p75, d.p90, d.max) == (1.0, 1.0, 2.0, 2.5, 4.0, 4.0, 4.0)


def test_percentiles_of_many_values(spark):
    rows = spark.range(0, 300_000, 1, 24).select((F.col("id") % 3).alias("k"), (F.pmod(F.xxhash64("id"), F.lit(1_000_003)) / 8).alias("x"))
    for _ in range(3):
        got = {r.k: tuple(r)[1:] for r in probe.percentiles(rows.repartition(24), ["k"], "x").collect()}
        assert got.keys() == {0, 1, 2}
        for k, in_order in rows.groupBy("k").agg(F.array_sort(F.collect_list("x"))).collect():
            n = len(in_order)
            p10, p25, p75, p90 = (in_order[min(n - 1, int(f * n))] for f in (0.1, 0.25, 0.75, 0.9))
            assert got[k] == (in_order[0], p10, p25, (in_order[(n - 1) // 2] + in_order[n // 2]) / 2, p75, p90, in_order[-1])


def test_percentiles_of_a_null_key(spark):
    rows = spark.createDataFrame([(None, 1.0), (None, 2.0), ("a", 3.0), ("b", None)], "k string, x double")
    assert {r.k: (r.min, r.median, r.max) for r in probe.percentiles(rows, ["k"], "x").collect()} == {None: (1.0, 1.5, 2.0), "a": (3.0, 3.0, 3.0)}


def test_references(spark):
    d = spark.createDataFrame([("a|b|12",)], "r string").select(text.parse_table_ref(F.col("r")).alias("p")).first().p
    assert (d.doc_name, d.line) == ("a|b", 12)
    with pytest.raises(Exception, match="not a table reference"):
        spark.createDataFrame([("nope",)], "r string").select(text.parse_table_ref(F.col("r"))).collect()


def test_lookup_passes_over_tables_without_a_number(spark):
    rows = [(1, 0, 0, 0, "Tiền mặt"), (1, 0, 0, 1, ""), (1, 1, 0, 0, "tiền MẶT khác"), (1, 1, 0, 1, "x"), (1, 1, 0, 2, "1.500"), (1, 1, 1, 0, "Tiền mặt"), (1, 1, 1, 1, "9")]
    c = spark.createDataFrame(rows, "qid int, table_pos int, row int, col int, value string")
    asked = spark.createDataFrame([(1, "k", "tiền mặt", 1, 0.001), (1, "none", "zzz", 1, 1.0)], "qid int, key string, label string, col int, scale double")
    got = {r.key: r.value for r in cells.lookup(asked, c).collect()}
    assert got == {"k": 1.5, "none": None}
