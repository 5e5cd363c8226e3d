import random

from pyspark.sql import functions as F

from millrace.operators import equi_join, join_cardinality, ratio_to_max


def test_ratio_to_max(spark):
    df = spark.createDataFrame([("x", 1, 3.0), ("x", 2, 12.0), ("y", 3, 5.0)], "k string, i int, v double")
    out = ratio_to_max(df, "k", "v", max_col="top", ratio_col="part")
    assert out.columns == ["k", "i", "v", "top", "part"]
    assert {r.i: (r.top, r.part) for r in out.collect()} == {1: (12.0, 0.25), 2: (12.0, 1.0), 3: (5.0, 1.0)}


def test_ratio_null_group_and_zero_max(spark):
    df = spark.createDataFrame([(None, 2), (None, 4), (1, 0)], "k int, v int")
    got = sorted((r.k, r.v, r.max_value, r.ratio) for r in ratio_to_max(df, "k", "v").collect()
                 if r.k is None) + [tuple(r) for r in ratio_to_max(df, "k", "v").where("k = 1").collect()]
    assert got == [(None, 2, 4, 0.5), (None, 4, 4, 1.0), (1, 0, 0, None)]


def test_join_cardinality_by_hand(spark):
    left = spark.createDataFrame([(5,), (5,), (5,), (6,), (None,)], "k int")
    right = spark.createDataFrame([(5,), (5,), (7,), (None,)], "k int")
    got = dict(map(tuple, join_cardinality(left, right, "k", "k").collect()))
    assert got == {"inner": 6, "left": 8, "right": 8, "full": 10, "cross": 20}


def test_join_cardinality_matches_real_joins(spark):
    rng = random.Random(5)
    left = spark.createDataFrame([(rng.choice([None, 1, 2, 3, 4]),) for _ in range(60)], "a int")
    right = spark.createDataFrame([(rng.choice([None, 2, 3, 5]),) for _ in range(40)], "b int")
    got = dict(map(tuple, join_cardinality(left, right, "a", "b").collect()))
    for how in ("inner", "left", "right", "full"):
        assert got[how] == equi_join(left, right, "a", "b", how).count(), how
    assert got["cross"] == 60 * 40


def test_joins_match_plain_joins_whatever_the_names(spark):
    rng = random.Random(9)
    left = spark.createDataFrame([(i, rng.choice([None, 1, 1, 1, 2, 3])) for i in range(80)], "ID int, k int")
    right = spark.createDataFrame([(j, rng.choice([None, 1, 3, 7, 7])) for j in range(12)], "id int, k int")
    for how in ("inner", "left", "right", "full", "left_semi", "left_anti"):
        got = equi_join(left, right, "k", "k", how)
        plain = left.alias("a").join(right.alias("b"), F.col("a.k") == F.col("b.k"), how)
        assert got.columns == plain.columns
        assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, plain.collect()), key=repr), how


def test_cross_count_is_a_product_of_counts(spark):
    # No join is materialized: the counts come from per-key counts, and the
    # result type is decimal(38,0), so cross counts beyond bigint still fit.
    left = spark.range(3_000_000).select((F.col("id") % 2).alias("k"))
    right = spark.range(3_100_000).select((F.col("id") % 2).alias("k"))
    got = dict(map(tuple, join_cardinality(left, right, "k", "k").collect()))
    assert int(got["cross"]) == 3_000_000 * 3_100_000
    assert int(got["inner"]) == 2 * 1_500_000 * 1_550_000
    assert dict(join_cardinality(left, right, "k", "k").dtypes)["row_count"] == "decimal(38,0)"
