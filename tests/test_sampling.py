"""Exact stratified cut equals the plain per-stratum window, for any partitioning."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from inkwell.operators import sampling as S


def _samples(spark, n_a=700, n_b=90):
    rows = [(f"a{i}", "compose") for i in range(n_a)] + [(f"b{i}", "reply") for i in range(n_b)]
    return spark.createDataFrame(rows, "sample_id string, task_type string")


def _plain(df, quota, key):
    w = Window.partitionBy("task_type").orderBy(key, "sample_id")
    j = df.withColumn("_rn", F.row_number().over(w)).join(quota, "task_type")
    return {r[0] for r in j.where(F.col("_rn") <= F.col("n_take")).select("sample_id").collect()}


@pytest.mark.parametrize("digits", [1, 2, 4])
@pytest.mark.parametrize("takes", [(0, 0), (1, 90), (350, 45), (700, 1)])
def test_exact_cut_equals_window(spark, digits, takes):
    df = _samples(spark).withColumn("k", S.order_key(42, "t"))
    quota = spark.createDataFrame([("compose", takes[0]), ("reply", takes[1])], "task_type string, n_take long")
    got = {r[0] for r in S.exact_cut(df.repartition(3), quota, "k", digits=digits).where("_take")
           .select("sample_id").collect()}
    assert got == _plain(df, quota, "k")
    assert len(got) == sum(takes)


def test_cap_and_split_counts(spark):
    df = _samples(spark)
    capped = S.cap_samples(df, max_samples=100)
    counts = dict(capped.groupBy("task_type").count().collect())
    assert counts == {"compose": int(100 * 700 / 790), "reply": 100 - int(100 * 700 / 790)}
    split = S.stratified_split(capped, 0.1).groupBy("task_type", "split").count().collect()
    got = {(r[0], r[1]): r[2] for r in split}
    assert got[("compose", "val")] == max(1, int(88 * 0.1)) and got[("reply", "val")] == 1
    assert sum(got.values()) == 100
    assert S.cap_samples(df, max_samples=0).count() == 790
    one = spark.createDataFrame([("x", "reply")], "sample_id string, task_type string")
    assert [r["split"] for r in S.stratified_split(one).collect()] == ["val"]


def test_any_number_of_strata_and_nulls(spark):
    rows = [(f"{t}{i}", t) for t, n in (("compose", 50), ("forward", 30), ("reply", 20)) for i in range(n)]
    rows += [(f"n{i}", None) for i in range(10)]
    df = spark.createDataFrame(rows, "sample_id string, task_type string")
    capped = dict(S.cap_samples(df, max_samples=30).groupBy("task_type").count().collect())
    assert sum(capped.values()) == 30 and capped["compose"] == 13 and capped["forward"] == 8 and capped[None] == 2
    split = S.stratified_split(df, 0.1).groupBy("task_type", "split").count().collect()
    assert sum(r["count"] for r in split) == len(rows)
    assert {r["task_type"]: r["count"] for r in split if r["split"] == "val"} == {
        "compose": 5, "forward": 3, "reply": 2, None: 1}
