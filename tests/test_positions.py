"""Global row numbers and previous rows against a sorted list."""

import random

import pytest
from pyspark.sql import functions as F

from millrace.operators import global_lag, global_row_number

from planutil import plan_text


def test_numbers_follow_the_order(spark):
    df = spark.range(5000, numPartitions=7).select((F.col("id") * 7919 % 5000).alias("k"), F.lit("x").alias("row_number_"))
    got = sorted((r["k"], r["n"]) for r in global_row_number(df, ["k"], "n").collect())
    assert got == [(k, k + 1) for k in range(5000)]
    down = {r["k"]: r["n"] for r in global_row_number(df, [F.desc("k")], "n").collect()}
    assert down[4999] == 1 and down[0] == 5000


def test_no_single_partition(spark):
    df = spark.range(100).withColumn("v", F.col("id") % 3)
    for out in (global_row_number(df, ["id"]), global_lag(df, ["id"], {"p": "v"}, position="n")):
        assert "SinglePartition" not in plan_text(out)


def test_ties_and_repeated_rows_get_one_number_each(spark):
    df = spark.createDataFrame([(1 if i % 3 else None, i % 5, {"a": i % 2}) for i in range(600)],
                               "k int, v int, m map<string,int>")
    out = global_row_number(df, ["k"], "n").collect()
    assert sorted(r["n"] for r in out) == list(range(1, 601))
    assert {r["n"] for r in out if r["k"] is None} == set(range(1, 201))       # nulls first


def test_empty_and_single(spark):
    none = spark.createDataFrame([], "k int, v int")
    assert global_row_number(none, ["k"]).collect() == []
    assert global_lag(none, ["k"], {"p": "v"}).collect() == []
    one = global_lag(spark.createDataFrame([(3, 4)], "k int, v int"), ["k"], {"p": "v"}, position="n").collect()
    assert [tuple(r) for r in one] == [(3, 4, 1, None)]


@pytest.mark.parametrize("partitions", [1, 3, 50])
def test_previous_rows_of_series(spark, partitions):
    rng = random.Random(partitions)
    rows = [(rng.choice(["a", "b", None, "c"]), i, rng.choice([None, f"v{i}"]), float(i)) for i in range(400)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "g string, k int, v string, w double").repartition(partitions)
    was = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        per = global_lag(df, ["k"], {"pv": "v", "pk": "k"}, by=["g"]).collect()
        all_ = global_lag(df, ["k"], {"pw": "w"}, position="n").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", was)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    want, last = {}, {}
    for g, k, v, w in sorted(rows, key=lambda r: r[1]):
        want[k] = last.get(g, (None, None))
        last[g] = (v, k)
    assert {r["k"]: (r["pv"], r["pk"]) for r in per} == want
    assert sorted((r["k"], r["n"], r["pw"]) for r in all_) == [
        (k, k + 1, float(k - 1) if k else None) for k in range(400)]
