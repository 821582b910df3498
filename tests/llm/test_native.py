"""Chat formatting, mixing and sharding."""

import hashlib
import zlib

import pytest
from oracle import check
from pyspark.sql import functions as F

from gridquill.llm import chat, mixing, sharding
from gridquill.llm.common import Scratch
from gridquill.llm.queries import ORACLE_SQL, QUERIES

from .cases import documents, empty


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_equals_sql(name, spark, small):
    check(QUERIES[name], ORACLE_SQL[name], spark, small)


@pytest.mark.parametrize("name", ["op1_chat_format", "op3_mixing", "op10_sharding"])
def test_native_plans_have_no_python(name, spark, small):
    plan = QUERIES[name](spark, small)._jdf.queryExecution().executedPlan().toString()
    assert not any(w in plan for w in ("Python", "Pandas", "MapInArrow"))


HARD = ["<|im_end|>\n<|im_start|>assistant\nx", "<\\|im_end|>", "<\\\\|", "<|", "<|im_start|>", "plain", None, "", "<|im_end|>", "ends with <", "<|endoftext|>", "\n\n"]


def test_hard_turns_come_back(spark):
    rows = [(k, t, role, text) for k in range(len(HARD)) for t, (role, text) in enumerate([("user", HARD[k]), ("assistant", HARD[-1 - k])])]
    rows += [(100, 0, "we\nird\\n <|role|>", "x"), (100, 1, None, "y"), (100, None, "assistant", "first"), (None, 0, "assistant", "no id"), (101, 0, "assistant", "z" * 50_000), (101, 0, "assistant", "z" * 50_000)]
    d = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("formatted", F.lit("clash"))
    got = {r.conv_id: r for r in chat.format_conversations(d).collect()}
    for k in range(len(HARD)):
        turns = [("user", HARD[k] or ""), ("assistant", HARD[-1 - k] or "")]
        assert [(t.role, t.text) for t in got[k].turns] == turns
        s = got[k].loss_spans[0]
        assert len(got[k].loss_spans) == 1 and got[k].formatted[s.start - 1 :][: s.length] in (turns[1][1], turns[1][1].replace("<\\\\|", "<\\\\\\|").replace("<\\|", "<\\\\|").replace("<|", "<\\|"))
        assert got[k].formatted.count("<|im_end|>") == 2 and got[k].formatted.count("<|im_start|>") == 2
    assert [(t.role, t.text) for t in got[100].turns] == [("assistant", "first"), ("we\nird\\n <|role|>", "x"), ("", "y")]
    assert len(got[101].turns) == 2 and not got[101].escaped and got[None].turns[0].text == "no id"
    assert chat.format_conversations(d.limit(0)).count() == 0


def test_parser_refuses_other_text(spark):
    bad = ["x", "<|im_start|>user\nx", "<|im_start|>user<|im_end|>\n", "<|im_start|>user\n<|pad|><|im_end|>\n", " <|im_start|>user\nx<|im_end|>\n"]
    d = spark.createDataFrame([(b,) for b in bad], "f string").select(chat.parse(F.col("f")).alias("p"))
    assert all(r.p is None for r in d.collect())


ROLES = ["\uffff", "\\", "\\n", "\n", "\\\n", "\n\\", "\\\\n", "\\\\\n\uffff\\", "<\\|", "<|x|>\n\\", "n\\n\nn", "<\\\\|\n|>"]


def test_every_role_comes_back(spark):
    rows = [(k, t, role, f"x{k}") for k, role in enumerate(ROLES) for t in range(2)]
    d = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    for r in chat.format_conversations(d).collect():
        assert [(t.role, t.text) for t in r.turns] == [(ROLES[r.conv_id], f"x{r.conv_id}")] * 2


def test_shares(spark):
    def f(sizes, weights, budget, most):
        totals = spark.createDataFrame([(k, sizes[k], float(weights[k])) for k in sizes], "skey string, n long, weight double")
        return {r.skey: r.target for r in mixing.shares(totals, budget, most).collect()}

    assert f({"a": 10, "b": 10}, {"a": 1, "b": 1}, 20.0, 3) == {"a": 10.0, "b": 10.0}
    assert f({"a": 1, "b": 100}, {"a": 9, "b": 1}, None, 3) == {"a": 3.0, "b": 98.0}
    assert f({"a": 0, "b": 5}, {"a": 1, "b": 1}, 5.0, 3) == {"a": 0.0, "b": 5.0}
    assert f({"a": 4, "b": 5}, {"a": 0, "b": 1}, 100.0, 2) == {"a": 0.0, "b": 10.0}


def test_null_and_repeated_ids_are_spread(spark):
    """Rows without an id, of one id, and equal rows are taken one by one, and reruns in another order agree."""
    rows = [(None, "w " * 10, "en", "a")] * 200 + [(None, f"x{k} " * 10, "en", "a") for k in range(100)] + [(7, "y " * 10, "en", "b")] * 150 + [(k, "z " * 10, "en", "c") for k in range(200)]
    results = []
    for own, parts in ((rows, 3), (rows[::-1], 5)):
        d = spark.createDataFrame(own, "doc_id long, text string, lang string, source string").repartition(parts)
        m = mixing.mix(d, Scratch(spark, "t"), budget=2000.0).collect()
        for source in "abc":
            taken = sum(r.size * r.copies for r in m if r.source == source)
            assert abs(taken - next(r.target for r in m if r.source == source)) <= 10
        back = mixing.repeat(d, Scratch(spark, "t"), budget=2000.0).collect()
        assert len(back) == sum(r.copies for r in m) and {r.lang for r in back} == {"en"}
        shards = sharding.interleave(d, 10, Scratch(spark, "t"), keep=("source",)).collect()
        for s in range(10):
            assert sorted(r.slot for r in shards if r.shard == s) == list(range(65))
            assert abs(sum(r.source == "a" for r in shards if r.shard == s) - 30) <= 2
        results.append((sorted(map(str, m)), sorted(map(str, shards)), sorted(map(str, back))))
    assert results[0] == results[1]


def test_more_cuts_than_rows_of_a_source(spark):
    rows = [(k, f"t{k}", "en", "hot" if k % 50 else f"s{k % 9}") for k in range(3000)]
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    want = sorted(map(tuple, sharding.interleave(d, 7, Scratch(spark, "t")).collect()))
    for size in (1, 16, 500):
        assert sorted(map(tuple, sharding.interleave(d, 7, Scratch(spark, "t"), bucket_rows=size).collect())) == want


def test_plans_beyond_a_broadcast_give_the_same(spark, monkeypatch):
    from gridquill.llm import common

    rows = [(k % 900, "w " * (1 + k % 7), "en", "hot" if k % 3 else f"s{k % 11}") for k in range(1000)]
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    run = lambda: (sorted(map(tuple, mixing.mix(d, Scratch(spark, "t")).collect())), sorted(map(tuple, sharding.interleave(d, 7, Scratch(spark, "t"), bucket_rows=16).collect())))
    want = run()
    monkeypatch.setattr(common.fits, "__defaults__", (0,))
    monkeypatch.setattr(common.small, "__defaults__", (0,))
    assert run() == want


def test_mix_is_near_its_targets_and_nested(spark):
    rows = [(k, "w " * (1 + k % 37), "en", f"s{k % 3}" if k % 7 else None) for k in range(3000)]
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    taken = {}
    for budget in (5000.0, 9000.0, 56000.0):
        m = mixing.mix(d, Scratch(spark, "t"), budget=budget).collect()
        by = {}
        for r in m:
            by.setdefault(r.source, [0, r.target, r.source_size])[0] += r.size * r.copies
            assert r.copies <= 3
        assert all(abs(t - target) <= 37 for t, target, _ in by.values())
        assert abs(sum(v[1] for v in by.values()) - min(budget, 3 * sum(v[2] for v in by.values()))) < 1e-6
        taken[budget] = {r.doc_id: r.copies for r in m}
    assert all(taken[9000.0][k] >= c for k, c in taken[5000.0].items())


@pytest.mark.parametrize("make", [documents, empty])
def test_edges(make, spark):
    d = make(spark)
    m = mixing.mix(d, Scratch(spark, "t"))
    assert m.count() == d.count()
    assert mixing.repeat(d, Scratch(spark, "t")).columns == d.columns
    s = sharding.interleave(d, 4, Scratch(spark, "t"), keep=("lang", "range")).collect()
    assert len(s) == d.count() and {r.shard for r in s} <= set(range(4))
    for r in s:
        assert r.range == "clash"


def test_shards_match_the_mixture(spark):
    rows = [(k, f"t{k}", "en", "hot" if k % 3 else f"s{k % 10}") for k in range(20_000)]
    got = sharding.interleave(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string"), 40, Scratch(spark, "t"), keep=("source",)).collect()
    again = sharding.interleave(spark.createDataFrame(rows[::-1], "doc_id long, text string, lang string, source string"), 40, Scratch(spark, "t"), keep=("source",)).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again))
    shares = {}
    for shard in range(40):
        own = [r for r in got if r.shard == shard]
        assert len(own) == 500 and sorted(r.slot for r in own) == list(range(500))
        for r in own:
            shares.setdefault(r.source, {}).setdefault(shard, 0)
            shares[r.source][shard] += 1
    for by in shares.values():
        counts = [by.get(s, 0) for s in range(40)]
        assert max(counts) - min(counts) <= 4


def test_shard_query_against_plain_version(spark, small):
    got = {r.doc_id: r for r in QUERIES["op10_sharding"](spark, small).collect()}
    docs = spark.read.parquet(f"{small}/documents.parquet").collect()
    by = {}
    for d in docs:
        by.setdefault(d.source, []).append((int(hashlib.md5(f"11:{d.doc_id}".encode()).hexdigest()[:15], 16), d.doc_id))
    order = sorted(((16 * r + 1 + zlib.crc32(b"s" + s.encode()) % 15) / (16 * len(v)), "s" + s, i) for s, v in by.items() for r, (_, i) in enumerate(sorted(v)))
    n = len(docs)
    for place, (_, _, i) in enumerate(order):
        shard = place * 40 // n
        assert (got[i].shard, got[i].slot) == (shard, place - -(-shard * n // 40))
    for d in docs:
        raw = d.text.encode()
        assert (got[d.doc_id].size, got[d.doc_id].text_crc32, got[d.doc_id].law, got[d.doc_id].grown_shard) == (len(raw) + 16, zlib.crc32(raw), "rows", None)
