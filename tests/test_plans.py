"""Plan shapes that the scale design depends on."""

from pyspark.sql import functions as F

from millrace.operators import equi_join, islands, ordered_lag, ratio_to_max

from planutil import plan_text


def _big(spark, n=20000):
    # one key holds a third of the rows
    return spark.range(n).select(F.col("id").alias("lid"),
                                 F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id") % 50).alias("a"))


def test_small_side_is_broadcast_by_measured_size_only(spark):
    big = _big(spark)
    small = spark.range(30).select(F.col("id").alias("rid"), (F.col("id") % 7).alias("b"))
    for how in ("inner", "left", "right", "full"):
        out = equi_join(big, small, "a", "b", how)
        out.collect()
        assert "BroadcastHashJoin" in plan_text(out), how
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
        try:
            plan = plan_text(equi_join(big, small, "a", "b", how))
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
            spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
        # No forced broadcast, and no join kind whose hot side cannot be split.
        assert "Broadcast" not in plan and "FullOuter" not in plan and "RightOuter" not in plan, how


def test_ratio_to_max_uses_no_window(spark):
    plan = plan_text(ratio_to_max(_big(spark), "a", "lid"))
    assert "Window" not in plan and "partial_max" in plan


def test_islands_window_is_bucketed(spark):
    df = spark.range(5000).select((F.col("id") * 2).alias("v"))
    plan = plan_text(islands(df, "v", width=128))
    assert "hashpartitioning(__b" in plan


def test_ordered_lag_reuses_its_exchange(spark):
    df = spark.range(3000).select(F.col("id").alias("k"), (F.col("id") * 7 % 11).alias("v")) \
        .groupBy("k").agg(F.sum("v").alias("v"))
    out = ordered_lag(df, "k", "v", (F.col("k") / 100).cast("int"))
    out.collect()
    assert "ReusedExchange" in plan_text(out)


def test_curated_reads_prune_by_process_date(spark, workdir):
    import datetime as dt

    from millrace.operators import transform_v2
    from millrace.sinks import write_curated
    from millrace.sources import read_curated
    raw = spark.createDataFrame([("T1", "C1", "1.0")], ["id", "cust", "amount"])
    for day in ("2026-04-28", "2026-04-29"):
        write_curated(transform_v2(raw, f"b{day}", day), f"{workdir}/t", replay_safe=True)
    q = read_curated(spark, f"{workdir}/t").where(F.col("process_date") == dt.date(2026, 4, 29))
    plan = plan_text(q)
    assert "PartitionFilters: [isnotnull(process_date" in plan and "2026-04-29" in plan
    assert q.count() == 1
