import datetime as dt

from pyspark.sql import functions as F

from millrace.functions import legacy_integral, parse_date, safe_ratio, swap_values, to_type


def test_swap_values(spark):
    df = spark.createDataFrame([(1, "f"), (2, "m"), (3, "f"), (4, "m"), (5, "m"), (6, None), (7, "x")],
                               "id int, gender string")
    got = dict((r.id, r.s) for r in df.select("id", swap_values("gender", "f", "m").alias("s")).collect())
    assert got == {1: "m", 2: "f", 3: "m", 4: "f", 5: "f", 6: None, 7: "x"}


def test_bad_conversions_become_null(spark):
    df = spark.createDataFrame([("abc", "", "abc", " 2 ", "2.5", "1e3", "-3.")],
                               "a string, b string, c string, d string, e string, f string, g string")
    r = df.select(to_type("a", "double").alias("a"), to_type("b", "int").alias("b"),
                  to_type("c", "timestamp").alias("c"), to_type("d", "int").alias("d"),
                  legacy_integral("e").alias("e"), legacy_integral("f").alias("f"),
                  legacy_integral("g").alias("g")).first()
    assert (r.a, r.b, r.c, r.d, r.e, r.f, r.g) == (None, None, None, 2, 2, None, -3)


def test_parse_date_and_ratio(spark):
    df = spark.createDataFrame([("2026-05-01", 1, 4), ("nope", 1, 0)], "s string, n int, d int")
    rows = df.select(parse_date("s").alias("d"), safe_ratio("n", "d").alias("r")).collect()
    assert rows[0].d == dt.date(2026, 5, 1) and rows[0].r == 0.25
    assert rows[1].d is None and rows[1].r is None


def test_legacy_integral_cases(spark):
    cases = {" 7 ": 7, "+4": 4, "3.": 3, " 2.9 ": 2, "-0.5": 0, ".5": None, "1e3": None,
             "2.5d": None, "": None, None: None, "12345678901": None}
    df = spark.createDataFrame([(k,) for k in cases], "s string")
    got = {r.s: r.i for r in df.select("s", legacy_integral("s").alias("i")).collect()}
    assert got == cases
    assert df.select(legacy_integral("s", "bigint").alias("i")).where("s = '12345678901'").first().i == 12345678901
