"""Value-level helpers used by the analytic operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._util import as_col


def swap_values(c, a, b) -> Column:
    """Exchange ``a`` and ``b`` in one pass; every other value, NULL included,
    is left as it is."""
    col = as_col(c)
    return F.when(col == F.lit(a), F.lit(b)).when(col == F.lit(b), F.lit(a)).otherwise(col)


def integral_bucket(name: str, width: int) -> Column:
    """``floor(name / width)`` for an integral column, in exact integer
    arithmetic: no double rounding for keys beyond 2^53, right for negatives."""
    w = int(width)
    return F.expr(f"(cast(`{name}` as bigint) - pmod(cast(`{name}` as bigint), {w})) div {w}")
