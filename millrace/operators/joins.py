"""Equi-joins and the join-cardinality report.

``join_cardinality`` answers "how many rows would each join kind return" from
per-key row counts, never materializing a join: each side is grouped by key
(partial aggregation, so a hot key shuffles one row per map task), the two
count tables are full-outer-joined on the key, and the five totals are sums
over that. Work is linear in the input; the cross-join count is a product.
NULL keys never match, as in SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

JOIN_KINDS = ("inner", "left", "right", "full", "cross")


def _position(df: DataFrame, name: str) -> int:
    """Index of a column by exact name, else ignoring case."""
    exact = [i for i, c in enumerate(df.columns) if c == name]
    return (exact or [i for i, c in enumerate(df.columns) if c.lower() == name.lower()])[0]


def equi_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str,
              how: str = "inner") -> DataFrame:
    """Join on ``left_key == right_key``; both key columns are kept. NULL keys
    never match; duplicate keys multiply. Columns are matched by position, so
    names that occur on both sides, or differ only by case, are no trouble.

    There is one path for every size; AQE converts to a broadcast join where
    the measured side is small enough. Inner and left joins are the plain
    equi-join, whose hot partitions AQE splits. AQE cannot split the left side of
    a right join nor either side of a full join, so these are written as the
    inner (or left) join plus the right rows whose key never occurs on the
    left, found by an anti-join against the left side's *distinct keys*
    (partially aggregated, so a hot key leaves each task once).
    """
    if how == "cross":
        raise ValueError("cross joins are not materialized; use join_cardinality")
    lc, rc = [f"l{i}" for i in range(len(left.columns))], [f"r{i}" for i in range(len(right.columns))]
    lk, rk = lc[_position(left, left_key)], rc[_position(right, right_key)]
    l, r = left.toDF(*lc), right.toDF(*rc)
    cond = F.col(lk) == F.col(rk)
    if how not in ("right", "full"):
        out = l.join(r, cond, how)
        return out.toDF(*left.columns, *(right.columns if len(out.columns) > len(lc) else []))
    matched = l.join(r, cond, "inner" if how == "right" else "left")
    keys = l.select(F.col(lk).alias("k")).where(F.col("k").isNotNull()).distinct()
    unmatched = (r.join(keys, F.col(rk) == F.col("k"), "left_anti")
                 .select(*[F.lit(None).cast(t).alias(c) for c, t in l.dtypes], *rc))
    return matched.union(unmatched).toDF(*left.columns, *right.columns)


def join_cardinality(left: DataFrame, right: DataFrame, left_key: str,
                     right_key: str) -> DataFrame:
    """Rows ``(join_kind, row_count decimal(38,0))`` for inner, left, right,
    full and cross."""
    dec = "decimal(38,0)"
    lc = left.groupBy(F.col(left_key).alias("__k")).agg(F.count(F.lit(1)).cast(dec).alias("cl"))
    rc = right.groupBy(F.col(right_key).alias("__k")).agg(F.count(F.lit(1)).cast(dec).alias("cr"))
    both = lc.join(rc, "__k", "full")
    matched = F.col("cl").isNotNull() & F.col("cr").isNotNull() & F.col("__k").isNotNull()
    zero = F.lit(0).cast(dec)
    totals = both.agg(
        F.coalesce(F.sum(F.when(matched, F.col("cl") * F.col("cr"))), zero).alias("inner"),
        F.coalesce(F.sum(F.when(~matched, F.col("cl"))), zero).alias("left_only"),
        F.coalesce(F.sum(F.when(~matched, F.col("cr"))), zero).alias("right_only"),
        F.coalesce(F.sum("cl"), zero).alias("nl"),
        F.coalesce(F.sum("cr"), zero).alias("nr"),
    )
    kinds = totals.select(F.explode(F.array(
        F.struct(F.lit("inner").alias("join_kind"), F.col("inner").alias("n")),
        F.struct(F.lit("left").alias("join_kind"), (F.col("inner") + F.col("left_only")).alias("n")),
        F.struct(F.lit("right").alias("join_kind"), (F.col("inner") + F.col("right_only")).alias("n")),
        F.struct(F.lit("full").alias("join_kind"),
                 (F.col("inner") + F.col("left_only") + F.col("right_only")).alias("n")),
        F.struct(F.lit("cross").alias("join_kind"), (F.col("nl") * F.col("nr")).alias("n")),
    )).alias("k"))
    # decimal(38,0): a cross count of two large tables overflows bigint.
    return kinds.select(F.col("k.join_kind").alias("join_kind"),
                        F.col("k.n").alias("row_count"))
