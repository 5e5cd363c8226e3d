"""Reading curated tables and the driver test tables."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.errors import AnalysisException

TEST_TABLES = ("region nation customer supplier part orders lineitem events documents "
               "embeddings pages benchmark labels conversations").split()


def test_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the generated test tables: ``{sf_dir}/{name}.parquet``."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def read_curated(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Read a curated table back, with the schema its writers recorded: columns
    added by later batches are NULL in older files, no footer is opened to find
    them, and a table that has no rows yet is empty and typed. Without a record
    (a table of another writer) the file schemas are merged, which reads every
    footer. Partition columns come back typed (``process_date`` as a date).
    Delta tables carry their own schema."""
    from ..sinks.tables import recorded_schema
    if fmt == "delta":
        return spark.read.format("delta").load(path)
    schema = recorded_schema(spark, path)
    if schema is None:
        return spark.read.option("mergeSchema", "true").parquet(path)
    if path_exists(path) is False:
        return spark.createDataFrame([], schema)
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
            return spark.createDataFrame([], schema)
        raise


def path_exists(path: str) -> bool | None:
    """Whether a local ``path`` exists, asked of the file system directly (metadata
    only, no Spark job); ``None`` for any other file system, in which case the
    caller lets Spark find out."""
    if "://" in path and not path.startswith("file://"):
        return None
    return os.path.exists(path.removeprefix("file:"))
