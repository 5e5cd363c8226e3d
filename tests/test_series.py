import datetime as dt
import random

from pyspark.sql import functions as F

from millrace.functions import parse_date
from millrace.operators import declines, ordered_lag


def test_declining_days(spark):
    levels = [("2031-01-30", 40), ("2031-01-31", 44), ("2031-02-01", 41), ("2031-02-02", 41), ("2031-02-05", 3)]
    df = spark.createDataFrame(levels, "day string, level int").withColumn("day", parse_date("day"))
    out = declines(df, "day", "level", F.trunc("day", "month"), prev="before")
    assert sorted((r.day.isoformat(), r.level, r.before) for r in out.collect()) == [
        ("2031-02-01", 41, 44), ("2031-02-05", 3, 41)]


def test_ordered_lag_across_sparse_buckets(spark):
    rng = random.Random(1)
    days = sorted(rng.sample(range(0, 900), 300))
    base = dt.date(2020, 1, 1)
    rows = [(base + dt.timedelta(days=d), rng.randint(0, 100)) for d in days]
    df = spark.createDataFrame(rows, "d date, v int")
    got = {r.d: r.prev_value for r in ordered_lag(df, "d", "v", F.trunc("d", "month")).collect()}
    want = {rows[i][0]: (rows[i - 1][1] if i else None) for i in range(len(rows))}
    assert got == want


def test_adjacent_only_skips_gaps(spark):
    data = [("2026-05-01", 1000), ("2026-05-02", 900), ("2026-05-04", 800), ("2026-05-05", 700)]
    df = spark.createDataFrame(data, "date string, price int").withColumn("date", parse_date("date"))
    b = F.trunc("date", "month")
    assert sorted(r.price for r in declines(df, "date", "price", b).collect()) == [700, 800, 900]
    assert sorted(r.price for r in declines(df, "date", "price", b, adjacent_only=True).collect()) == [700, 900]


def test_prev_order_across_buckets(spark):
    df = spark.createDataFrame([(1, 5), (7, 3), (30, 9), (31, 1)], "k int, v int")
    out = ordered_lag(df, "k", "v", (F.col("k") / 10).cast("int"), prev_order="pk")
    assert sorted((r.k, r.prev_value, r.pk) for r in out.collect()) == \
        [(1, None, None), (7, 5, 1), (30, 3, 7), (31, 9, 30)]


def test_ordered_lag_per_series(spark):
    rng = random.Random(4)
    rows = [(g, k, rng.randint(0, 9)) for g in ("a", "b", None) for k in rng.sample(range(200), 40)]
    df = spark.createDataFrame(rows, "g string, k int, v int")
    got = {(r.g, r.k): r.prev_value
           for r in ordered_lag(df, "k", "v", (F.col("k") / 16).cast("int"), by="g").collect()}
    want = {}
    for g in ("a", "b", None):
        s = sorted((k, v) for gg, k, v in rows if gg == g)
        want.update({(g, s[i][0]): (s[i - 1][1] if i else None) for i in range(len(s))})
    assert got == want
