import pytest
from pyspark.sql import functions as F

from helmwake.llm.mixing import mix_documents, shares
from helmwake.session import table

DOCS = "doc_id bigint, text string, source string"
TARGETS = "source string, target_share double, max_repeats int"


def rows(mix):
    return {r["doc_id"]: r for r in mix.collect()}


def test_shares_and_caps(spark):
    docs = [(i, "word " * (1 + i % 9), "big") for i in range(3000)] + [(10_000 + i, "word " * 3, "small") for i in range(100)] + [(20_000, "x", None), (20_001, "x", "other"), (20_002, "", "big"), (20_003, None, "small")]
    d = spark.createDataFrame(docs, DOCS)
    t = spark.createDataFrame([("big", 0.7, 1), ("small", 0.3, 3), ("absent", 0.0, 1)], TARGETS)
    mix = mix_documents(d, t)
    got = rows(mix)
    assert all(r["copies"] <= (1 if r["source"] == "big" else 3) for r in got.values())
    assert not {20_000, 20_001, 20_002, 20_003} & set(got)
    s = {r["source"]: r for r in shares(mix, t).collect()}
    assert abs(s["big"]["reached_share"] - 0.7) < 0.005 and abs(s["small"]["reached_share"] - 0.3) < 0.005
    assert s["small"]["most_copies"] == 3 and s["absent"]["tokens"] == 0
    assert rows(mix_documents(d, t)) == got


def test_given_total_and_shortfall(spark):
    d = spark.createDataFrame([(i, "a b c d", "x") for i in range(100)] + [(1000 + i, "a b", "y") for i in range(10)], DOCS)
    t = spark.createDataFrame([("x", 0.5, 1), ("y", 0.5, 2)], TARGETS)
    mix = mix_documents(d, t, total_tokens=200)
    s = {r["source"]: r for r in shares(mix, t).collect()}
    assert s["x"]["tokens"] == 100 and s["y"]["tokens"] == 10 * 2 * 2 and s["y"]["most_copies"] == 2


def test_epochs(spark):
    d = spark.createDataFrame([(i, "a b c d", "x") for i in range(10)], DOCS)
    t = spark.createDataFrame([("x", 1.0, 4)], TARGETS)
    got = rows(mix_documents(d, t, total_tokens=100))
    assert sorted(r["copies"] for r in got.values()) == [2] * 5 + [3] * 5


def test_empty_repeats_and_clashes(spark, data, clashing):
    d, t = table(spark, data, "documents"), table(spark, data, "mix_targets")
    want = rows(mix_documents(d, t))
    assert rows(mix_documents(clashing(d), clashing(t))) == want
    assert rows(mix_documents(d.unionAll(d), t.unionAll(t))) == want
    assert mix_documents(d.limit(0), t).count() == 0 and mix_documents(d, t.limit(0)).count() == 0
    s = shares(mix_documents(d.limit(0), t), t)
    assert s.count() == 9 and s.agg(F.sum("tokens")).first()[0] == 0


def test_shares_sum_to_one(spark, data):
    t = table(spark, data.replace("0.001", "0.01"), "mix_targets")
    s = shares(mix_documents(table(spark, data.replace("0.001", "0.01"), "documents"), t), t)
    total = s.agg(F.sum("reached_share"), F.max(F.abs(F.col("reached_share") - F.col("target_share")))).first()
    assert total[0] == pytest.approx(1.0) and total[1] < 0.03
