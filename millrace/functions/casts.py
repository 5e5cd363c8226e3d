"""Null-on-failure scalar conversions.

The reference ran with ANSI mode off, where a bad cast, parse or division gives
NULL. Spark 4 defaults to ANSI on, so every conversion here uses the ``try_``
forms: bad input becomes NULL instead of failing the job. All of these are
built-in expressions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, IntegerType, LongType, ShortType, ByteType

from ._util import as_col

# A decimal string with an integral part ("2.5", "-3.", "+7.25") is truncated
# to that part before the integer cast, as a non-ANSI cast does; exponents and
# type suffixes ("1e3", "2.5d") stay invalid and become NULL.
_INT_WITH_FRACTION = r"^([+-]?\d+)\.\d*$"

_INTEGRAL = (IntegerType, LongType, ShortType, ByteType)


def legacy_integral(c, dtype: DataType | str = "int") -> Column:
    """String to an integral type with truncation of a fractional part.

    The regex only runs on values holding a '.', so the common all-digit value
    costs a plain ``try_cast`` (which trims surrounding blanks itself)."""
    col = as_col(c)
    stripped = F.when(col.contains("."),
                      F.regexp_replace(F.trim(col), _INT_WITH_FRACTION, "$1")).otherwise(col)
    return stripped.try_cast(dtype)


def to_type(c, dtype: DataType | str) -> Column:
    """Cast to ``dtype``; a value that does not convert becomes NULL."""
    if isinstance(dtype, str):
        from pyspark.sql.types import _parse_datatype_string
        dtype = _parse_datatype_string(dtype)
    if isinstance(dtype, _INTEGRAL):
        return legacy_integral(c, dtype)
    return as_col(c).try_cast(dtype)


def parse_date(c, fmt: str = "yyyy-MM-dd") -> Column:
    """String to date with a pattern; unparseable text becomes NULL."""
    return F.try_to_date(as_col(c), fmt)


def safe_ratio(num, den) -> Column:
    """``num / den`` as double; a zero or NULL denominator gives NULL."""
    return F.try_divide(as_col(num).cast("double"), as_col(den).cast("double"))
