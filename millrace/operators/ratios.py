"""Each row next to its group maximum and the ratio to it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.casts import safe_ratio


def ratio_to_max(df: DataFrame, by, value: str, max_col: str = "max_value",
                 ratio_col: str = "ratio") -> DataFrame:
    """Append the per-group maximum of ``value`` and ``value / maximum``.

    A ``max() over (partition by g)`` window would send every row of a group
    to one task. Instead the maximum is a grouped aggregate (partial maxima
    per map task, so a hot group shuffles one row per task) joined back on the
    key; the join is broadcast when the measured maxima table is small, and
    otherwise a sort-merge join whose skewed partitions AQE splits.
    A zero or NULL maximum gives a NULL ratio.
    """
    keys = [by] if isinstance(by, str) else list(by)
    maxima = df.groupBy(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)]) \
               .agg(F.max(value).alias(max_col))
    # NULL keys form a group, as in a window partition: null-safe equality.
    cond = [F.col(k).eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(keys)]
    return (df.join(maxima, on=cond, how="left")
              .drop(*[f"__k{i}" for i in range(len(keys))])
              .withColumn(ratio_col, safe_ratio(value, max_col)))
