"""Previous-row comparisons in one global order, without a single-partition window.

``lag(x) over (order by k)`` with no partition moves the whole input to one
task. Here the order key is cut into ordered buckets; ``lag`` runs inside each
bucket, and the first row of a bucket takes the last value of the nearest
earlier non-empty bucket, found with a window over one row per bucket.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType
from pyspark.sql.window import Window

from ..functions._util import as_col


def ordered_lag(df: DataFrame, order: str, value: str, bucket: Column,
                prev: str = "prev_value", prev_order: str | None = None,
                by=()) -> DataFrame:
    """Append ``prev``: ``value`` of the previous row in ascending ``order``
    (and, if ``prev_order`` is given, that row's ``order`` value too), within
    each series of ``by`` (default: one global series).

    ``order`` must be unique per series (else "previous row" is ambiguous) and
    ``bucket`` must be monotone in it (e.g. the month of a date), so bucket
    order agrees with row order. Per-bucket work is partitioned by (series,
    bucket); only one row per bucket meets in the stitching window.
    """
    by = [by] if isinstance(by, str) else list(by)
    po = prev_order or "__prev_order"
    x = df.withColumn("__bk", bucket)
    w = Window.partitionBy(*by, "__bk").orderBy(order)
    x = (x.withColumn(prev, F.lag(value).over(w))
          .withColumn(po, F.lag(order).over(w))
          .withColumn("__first", F.col(po).isNull())
          .withColumn("__last", F.lead(order).over(w).isNull()))
    # Tails come from the same windowed rows, so both branches share one
    # exchange (Spark reuses it) instead of recomputing the input.
    wb = Window.partitionBy(*by).orderBy("__bk")
    keys = [(c, f"__sk{i}") for i, c in enumerate(by)]
    tails = (x.where("__last")
              .select(*[F.col(c).alias(a) for c, a in keys], F.col("__bk").alias("__tbk"),
                      F.lag(value).over(wb).alias("__prev_tail"),
                      F.lag(order).over(wb).alias("__prev_tail_order")))
    cond = [F.col(c).eqNullSafe(F.col(a)) for c, a in keys] + [F.col("__bk") == F.col("__tbk")]
    first = F.col("__first")
    out = (x.join(tails, cond, "left")
            .drop(*[a for _, a in keys], "__tbk")
            .withColumn(prev, F.when(first, F.col("__prev_tail")).otherwise(F.col(prev)))
            .withColumn(po, F.when(first, F.col("__prev_tail_order")).otherwise(F.col(po)))
            .drop("__bk", "__first", "__last", "__prev_tail", "__prev_tail_order"))
    return out if prev_order else out.drop(po)


def declines(df: DataFrame, order: str, value: str, bucket: Column,
             prev: str = "prev_value", adjacent_only: bool = False, by=()) -> DataFrame:
    """Rows whose ``value`` is below the previous row's.

    By default "previous" is the previous *row*: gaps in ``order`` are skipped
    over. With ``adjacent_only`` the previous row must be exactly one step
    earlier (one day for a date ``order``, one unit for an integer one)."""
    out = ordered_lag(df, order, value, bucket, prev, prev_order="__po", by=by) \
        .where(as_col(value) < F.col(prev))
    if adjacent_only:
        is_date = isinstance(df.schema[order].dataType, DateType)
        step = F.datediff(order, "__po") if is_date else F.col(order) - F.col("__po")
        out = out.where(step == 1)
    return out.drop("__po")
