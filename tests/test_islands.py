import random

from pyspark.sql import functions as F

from millrace.operators import islands, runs


def brute_islands(pairs):
    """{group: [(lo, hi), ...]} from (group, value) pairs."""
    out = {}
    by = {}
    for g, v in pairs:
        by.setdefault(g, set()).add(v)
    for g, vals in by.items():
        vs = sorted(vals)
        start = prev = vs[0]
        for v in vs[1:]:
            if v != prev + 1:
                out.setdefault(g, []).append((start, prev))
                start = v
            prev = v
        out.setdefault(g, []).append((start, prev))
    return {g: sorted(x) for g, x in out.items()}


def test_islands_of_two_groups(spark):
    rows = [("m", v) for v in (-2, -1, 0, 4, 10, 11)] + [("n", v) for v in (7, 8, 12)]
    df = spark.createDataFrame(rows, "who string, at bigint")
    got = sorted(map(tuple, islands(df, "at", by="who").collect()))
    assert got == [("m", -2, 0), ("m", 4, 4), ("m", 10, 11), ("n", 7, 8), ("n", 12, 12)]


def test_duplicates_form_one_island(spark):
    df = spark.createDataFrame([("A", 1), ("A", 2), ("A", 2), ("A", 3)], ["g", "s"])
    assert [tuple(r) for r in islands(df, "s", by="g").collect()] == [("A", 1, 3)]


def test_runs_of_at_least_two(spark):
    seats = spark.createDataFrame([(s, s not in (13, 16, 17)) for s in range(11, 20)], "seat int, free boolean")
    out = runs(seats.where("free"), "seat", min_length=2)
    assert sorted((r.seat, r.run_start, r.run_length) for r in out.collect()) == [
        (11, 11, 2), (12, 11, 2), (14, 14, 2), (15, 14, 2), (18, 18, 2), (19, 18, 2)]


def test_null_sequence_belongs_to_no_island(spark):
    df = spark.createDataFrame([("a", None), ("a", 1), ("b", None)], "g string, v bigint")
    assert [tuple(r) for r in islands(df, "v", by="g").collect()] == [("a", 1, 1)]
    assert runs(df, "v", by="g").count() == 1


def test_one_far_off_key_changes_nothing(spark):
    df = spark.range(200_000).select(F.when(F.col("id") == 7, 2 ** 60).otherwise(F.col("id")).alias("v"))
    got = sorted(map(tuple, islands(df, "v").collect()))
    assert got == [(0, 6), (8, 199_999), (2 ** 60, 2 ** 60)]


def test_bucket_edges_match_brute_force(spark):
    rng = random.Random(7)
    pairs = []
    for g in ("x", "y", None):
        pairs += [(g, v) for v in range(-50, 300) if rng.random() < 0.8]
    pairs += [("y", 17)]  # a duplicate
    df = spark.createDataFrame(pairs, "g string, v bigint")
    want = brute_islands(pairs)
    for width in (1, 2, 3, 4, 16, 1024, None):
        got = {}
        for r in islands(df, "v", by="g", width=width).collect():
            got.setdefault(r.g, []).append((r.min_sequence, r.max_sequence))
        assert {g: sorted(x) for g, x in got.items()} == want, width


def test_runs_match_brute_force_across_buckets(spark):
    rng = random.Random(3)
    vals = [v for v in range(0, 2000) if rng.random() < 0.85]
    df = spark.createDataFrame([(v, v * 10) for v in vals], "id bigint, payload bigint")
    isl = brute_islands([(None, v) for v in vals])[None]
    want = {}
    for lo, hi in isl:
        if hi - lo + 1 >= 4:
            for v in range(lo, hi + 1):
                want[v] = (lo, hi - lo + 1)
    for width in (4, 8, 100, None):
        out = runs(df, "id", min_length=4, width=width)
        got = {r.id: (r.run_start, r.run_length) for r in out.collect()}
        assert got == want, width
        assert set(out.columns) == {"id", "payload", "run_start", "run_length"}


def test_runs_per_group_with_null_group(spark):
    pairs = [(g, v) for g in ("a", None) for v in range(0, 40) if v % 10 != 9]
    df = spark.createDataFrame(pairs, "g string, v bigint")
    out = runs(df, "v", by="g", min_length=9, width=4)
    got = sorted(((r.g or ""), r.v, r.run_start, r.run_length) for r in out.collect())
    want = sorted(((g or ""), v, v - v % 10, 9) for g, v in pairs)
    assert got == want


def test_bucket_arithmetic_is_exact_for_huge_and_negative_keys(spark):
    from millrace.functions import integral_bucket
    vals = [2 ** 60 + 999, 2 ** 60 + 1000, -1, -1000, -1001, 0]
    df = spark.createDataFrame([(v,) for v in vals], "v bigint")
    got = {r.v: r.b for r in df.select("v", integral_bucket("v", 1000).alias("b")).collect()}
    assert got == {v: v // 1000 for v in vals}
    base = 2 ** 60
    keys = spark.createDataFrame([(base + i,) for i in (0, 1, 2, 5, 6, 1023, 1024, 1025)], "v bigint")
    got_isl = sorted((r.min_sequence - base, r.max_sequence - base)
                     for r in islands(keys, "v", width=1024).collect())
    assert got_isl == [(0, 2), (5, 6), (1023, 1025)]


def test_runs_keep_every_row_of_a_hot_duplicated_value(spark):
    from planutil import plan_text
    # value 5 is a third of the rows; 4..6 is a run of three distinct values
    hot = [(5, i) for i in range(600)]
    rest = [(v, 10_000 + v) for v in list(range(4, 7)) + list(range(20, 22)) for _ in range(300)]
    df = spark.createDataFrame(hot + rest, "v bigint, payload bigint")
    out = runs(df, "v", min_length=3, width=4)
    got = out.groupBy("v").count().collect()
    assert sorted((r.v, r["count"]) for r in got) == [(4, 300), (5, 900), (6, 300)]
    assert {(r.run_start, r.run_length) for r in out.select("run_start", "run_length").collect()} == {(4, 3)}
    plan = plan_text(out)
    assert "partial" in plan.lower() and "hashpartitioning(__b" in plan
