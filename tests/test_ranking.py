from pyspark.sql import functions as F

from millrace.operators import top_n_per_group, top_n_sum

from planutil import plan_text


def test_top_two_totals_per_team(spark):
    rows = [("red", "ann", 5), ("red", "bo", 9), ("red", "ann", 7), ("red", "cy", 1),
            ("blue", "dee", 4), ("blue", "ed", 4), ("blue", "fay", 3)]
    points = spark.createDataFrame(rows, "team string, player string, points int")
    totals = points.groupBy("team", "player").agg(F.sum("points").alias("total"))
    top = top_n_per_group(totals, "team", [F.desc("total"), "player"], 2, rank_col="place")
    assert sorted((r.team, r.place, r.player, r.total) for r in top.collect()) == [
        ("blue", 1, "dee", 4), ("blue", 2, "ed", 4), ("red", 1, "ann", 12), ("red", 2, "bo", 9)]
    assert dict(top.dtypes)["place"] == "bigint"


def test_tie_break_is_deterministic(spark):
    df = spark.createDataFrame([("g", "b", 5), ("g", "a", 5), ("g", "c", 5)], "g string, k string, v int")
    top = top_n_per_group(df, "g", [F.desc("v"), "k"], 2)
    assert sorted(r.k for r in top.collect()) == ["a", "b"]


def test_sum_of_best_three(spark):
    rows = [(k, v) for k in ("p", "q") for v in ((8, 6, 6, 2) if k == "p" else (1, 30))]
    df = spark.createDataFrame([(k, i, v) for i, (k, v) in enumerate(rows)], "k string, i int, v int")
    out = top_n_sum(df, "k", "v", [F.desc("v"), "i"], 3, alias="best")
    assert sorted(map(tuple, out.collect())) == [("p", 20), ("q", 31)]


def test_partial_limit_before_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("g"), F.col("id").alias("v"))
    plan = plan_text(top_n_per_group(df, "g", [F.desc("v")], 2))
    # Partial limit runs before the exchange, Final after it.
    assert "Partial" in plan and "Final" in plan and "WindowGroupLimit" in plan


def test_same_cut_for_every_n_and_column_type(spark):
    df = spark.range(6000, numPartitions=5).select(
        (F.col("id") % 2).alias("g"), F.col("id").alias("v"),
        F.create_map(F.lit("k"), F.col("id")).alias("m"))
    for n in (3, 999, 1000, 1001, 1500, 4000):
        out = top_n_per_group(df, "g", [F.desc("v")], n)
        size = min(n, 3000)
        assert sorted(r.v for r in out.where("g = 0").collect()) == list(range(6000 - 2 * size, 6000, 2))
        assert sorted(r.rn for r in out.where("g = 1").collect()) == list(range(1, size + 1))
        # A small n needs one shuffle; a large one spreads hot groups first.
        plan = plan_text(out).split("\n\n")[0]
        assert ("SPARK_PARTITION_ID" in plan_text(out).upper()) == (n > 100)
        assert plan.count("Exchange") == (1 if n <= 100 else 2)
