"""Plans have the shape that holds at scale."""

import re

from gridquill.plans.catalog import QUERIES


def plan(spark, name, folder):
    return QUERIES[name](spark, folder)._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def columns(text):
    return [set(re.findall(r"(\w+):", s)) for s in re.findall(r"ReadSchema: struct<(.*?)>\n", text)]


def test_scans_read_what_is_used(spark, small):
    assert columns(plan(spark, "number_sums", small)) == [{"l_returnflag", "l_linestatus", "l_extendedprice"}]
    assert all("text" not in c for c in columns(plan(spark, "last_wins", small)))
    assert all(c <= {"doc_id", "text"} | {"item_id"} for c in columns(plan(spark, "bm25_topk", small)) if c)


def test_filters_reach_the_scan(spark, small):
    text = plan(spark, "resume_and_shard", small)
    assert "EqualTo(o_orderstatus,F)" in text and "LeftAnti" in text


def test_ranks_are_cut_before_the_shuffle(spark, small):
    assert "WindowGroupLimit" in plan(spark, "bm25_topk", small) and "WindowGroupLimit" in plan(spark, "last_wins", small)


def test_numbers_and_texts_stay_in_the_jvm(spark, small):
    for name in ("number_sums", "number_roundtrip", "ascii_folding", "casefold_tokens", "bm25_topk", "tiered_select", "intent_parsing", "document_paths", "csv_rendering", "relevant_tables", "validate_ids"):
        text = plan(spark, name, small)
        assert not re.search("Python|Pandas|MapInArrow|CartesianProduct", text), name
