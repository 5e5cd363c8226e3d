"""Property tests: bucketed operators equal brute force for any input."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.operators import islands, join_cardinality, ordered_lag, runs

SETTINGS = settings(max_examples=15, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])


def brute(vals):
    vs = sorted(set(vals))
    out, start = [], None
    for i, v in enumerate(vs):
        if start is None:
            start = v
        if i + 1 == len(vs) or vs[i + 1] != v + 1:
            out.append((start, v))
            start = None
    return out


@SETTINGS
@given(st.lists(st.integers(-40, 40), min_size=1, max_size=60), st.integers(1, 9))
def test_islands_property(spark, vals, width):
    df = spark.createDataFrame([(v,) for v in vals], "v bigint")
    got = sorted((r.min_sequence, r.max_sequence) for r in islands(df, "v", width=width).collect())
    assert got == brute(vals)


@SETTINGS
@given(st.lists(st.integers(0, 50), min_size=1, max_size=60), st.integers(1, 7), st.integers(1, 4))
def test_runs_property(spark, vals, width, k):
    df = spark.createDataFrame([(v,) for v in vals], "v bigint")
    want = sorted(v for v in vals for lo, hi in brute(vals) if lo <= v <= hi and hi - lo + 1 >= k)
    got = sorted(r.v for r in runs(df, "v", min_length=k, width=width).collect())
    assert got == want


@SETTINGS
@given(st.lists(st.sampled_from([None, 1, 2, 3]), max_size=25),
       st.lists(st.sampled_from([None, 2, 3, 4]), max_size=25))
def test_join_cardinality_property(spark, a, b):
    left = spark.createDataFrame([(x,) for x in a], "k int")
    right = spark.createDataFrame([(x,) for x in b], "k int")
    got = dict(map(tuple, join_cardinality(left, right, "k", "k").collect()))
    inner = sum(1 for x in a for y in b if x is not None and x == y)
    lm = sum(1 for x in a if x is None or x not in b)
    rm = sum(1 for y in b if y is None or y not in a)
    assert got == {"inner": inner, "left": inner + lm, "right": inner + rm,
                   "full": inner + lm + rm, "cross": len(a) * len(b)}


@SETTINGS
@given(st.lists(st.integers(0, 500), min_size=1, max_size=40, unique=True), st.integers(1, 50))
def test_ordered_lag_property(spark, keys, width):
    rows = [(k, k * 7 % 13) for k in keys]
    df = spark.createDataFrame(rows, "k int, v int")
    got = {r.k: r.prev_value for r in ordered_lag(df, "k", "v", (F.col("k") / width).cast("int")).collect()}
    s = sorted(rows)
    assert got == {s[i][0]: (s[i - 1][1] if i else None) for i in range(len(s))}
