"""Top-N per group and sums over it.

Written as ``row_number() <= n`` over a partitioned window, which Catalyst plans
with a ``WindowGroupLimit`` *before* the shuffle (Partial) and after it (Final):
each map task forwards at most ``n`` rows per group, so a group holding a third of
the table costs no more shuffle than a small one, and one shuffle is enough.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions._util import as_col


def _names(cols) -> list:
    return [cols] if isinstance(cols, (str, Column)) else list(cols)


SALTS = 1024   # parts a group is cut into before the final cut, where n is large
ONE_LEVEL = 100     # the largest n whose n rows a map task and group may meet in one task


def top_n_per_group(df: DataFrame, by, order: Sequence, n: int,
                    rank_col: str = "rn") -> DataFrame:
    """Rows ranked ``1..n`` within each group of ``by``.

    ``order`` must end in a unique tie-break so the cut is deterministic
    (e.g. ``[F.desc("revenue"), "name"]``). ``rank_col`` is a bigint.

    Up to ``ONE_LEVEL`` one shuffle does: the limit before it leaves a group ``n`` rows
    a map task. A larger ``n`` (beyond Spark's
    ``spark.sql.optimizer.windowGroupLimitThreshold`` nothing is cut before a shuffle)
    takes two: the top ``n`` of each (group, part), a part holding the rows of some
    input partitions, so that a hot group is spread over ``SALTS`` tasks, then the top
    ``n`` of each group over at most ``n * SALTS`` rows.
    """
    if n < 1:
        raise ValueError("n must be >= 1")
    keys = [as_col(c) for c in _names(by)]
    order_cols = [as_col(c) for c in order]
    cut = df
    if n > ONE_LEVEL:
        # The part only spreads the work; the final cut does not depend on it.
        parts = df.withColumn("__part", F.pmod(F.spark_partition_id(), F.lit(SALTS)))
        first = Window.partitionBy(*keys, "__part").orderBy(*order_cols)
        cut = (parts.withColumn("__pre", F.row_number().over(first))
                    .where(F.col("__pre") <= n).drop("__pre", "__part"))
    w = Window.partitionBy(*keys).orderBy(*order_cols)
    return (cut.withColumn(rank_col, F.row_number().over(w))
               .where(F.col(rank_col) <= n)
               .withColumn(rank_col, F.col(rank_col).cast("bigint")))


def top_n_sum(df: DataFrame, by, value, order: Sequence, n: int,
              alias: str = "total") -> DataFrame:
    """Sum of ``value`` over the top ``n`` rows of each group.

    The final window and the aggregate share the same clustering on ``by``.
    """
    keys = _names(by)
    top = top_n_per_group(df, keys, order, n, rank_col="__rn")
    return top.groupBy(*keys).agg(F.sum(as_col(value)).alias(alias))
