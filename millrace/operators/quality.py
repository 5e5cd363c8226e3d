"""Data-quality split: rows with a NULL key are quarantined, the rest are good.

The ingest job gathers its counts with an ``Observation`` on the same pass that
writes the data, instead of separate ``count()`` actions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEY_COLUMN = "customer_id"


def is_bad(key: str = KEY_COLUMN):
    return F.col(key).isNull()


def split_by_key(df: DataFrame, key: str = KEY_COLUMN) -> tuple[DataFrame, DataFrame]:
    """``(good, bad)``: key present / key NULL. Empty CSV fields read as NULL
    and are bad; a field of blanks is a value and is good."""
    return df.where(~is_bad(key)), df.where(is_bad(key))


def quality_counts(df: DataFrame, key: str = KEY_COLUMN) -> DataFrame:
    """One row ``(total_rows, good_rows, bad_rows)`` from a single aggregate."""
    return df.agg(F.count(F.lit(1)).alias("total_rows"),
                  F.count_if(~is_bad(key)).alias("good_rows"),
                  F.count_if(is_bad(key)).alias("bad_rows"))
