"""Writing curated and quarantine tables."""

from __future__ import annotations

import json
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..sources.tables import path_exists
from .ledger import append_control, read_control

PARTITION_COLUMNS = ("process_date",)
#: Files that one task of ``open_files`` holds open at once.
OPEN_FILES = 64


@contextmanager
def open_files(spark: SparkSession, most: int = OPEN_FILES) -> Iterator[None]:
    """Writes begun inside keep a file open for each partition value that a task meets, up to
    ``most``, and do not sort the task's rows by the partition columns first. Only the rows that
    come after a task has met more values than that are sorted. The session's setting is put back."""
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.getAll.get(name)
    spark.conf.set(name, most)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def schema_path(path: str) -> str:
    """The small table beside ``path`` that holds its schema, one row for each change."""
    return path.rstrip("/") + "_schema"


def recorded_schema(spark: SparkSession, path: str) -> StructType | None:
    """The table's schema as its writers recorded it, or ``None`` if none did."""
    if path_exists(schema_path(path)) is False:
        return None
    try:
        rows = read_control(spark, schema_path(path), "schema string, at timestamp").collect()
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
            return None
        raise
    merged = StructType()
    for r in sorted(rows, key=lambda r: r["at"]):
        known = {f.name for f in merged.fields}
        for f in StructType.fromJson(json.loads(r["schema"])).fields:
            if f.name not in known:
                merged = merged.add(f.name, f.dataType, True)
    return merged if merged.fields else None


def record_schema(df: DataFrame, path: str) -> None:
    """Add a row to the schema table if ``df`` brings columns it does not have yet."""
    spark, old = df.sparkSession, recorded_schema(df.sparkSession, path)
    if {f.name for f in df.schema.fields} - {f.name for f in (old or StructType()).fields}:
        append_control(spark.createDataFrame([(df.schema.json(),)], "schema string")
                       .withColumn("at", F.current_timestamp()), schema_path(path))


def write_curated(df: DataFrame, path: str, partition_by=PARTITION_COLUMNS,
                  fmt: str = "parquet", replay_safe: bool = False) -> None:
    """Append ``df`` to a table partitioned by ``partition_by``.

    Schema evolution: Delta merges new columns on write (``mergeSchema``);
    Parquet readers merge file schemas on read (see ``read_curated``).

    ``replay_safe`` partitions additionally by ``batch_id`` and overwrites
    only the partitions being written (dynamic partition overwrite), so
    re-running a batch replaces its own rows instead of duplicating them and
    leaves every other batch alone.

    A Parquet table's schema is recorded beside it, so it can be read without
    opening its files, also when every batch so far was empty.
    """
    if fmt == "parquet":
        record_schema(df, path)
    cols = list(partition_by)
    if replay_safe and "batch_id" not in cols:
        cols.append("batch_id")
    w = df.write.format(fmt).partitionBy(*cols)
    if fmt == "delta":
        w = w.option("mergeSchema", "true")
    if replay_safe:
        w = w.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    else:
        w = w.mode("append")
    w.save(path)


def quarantine_path(target: str) -> str:
    """Bad rows live *next to* the table, never inside it (a sub-folder without
    the partition layout would break reading the table)."""
    return target.rstrip("/") + "_bad_records"


def write_quarantine(bad: DataFrame, target: str, fmt: str = "parquet",
                     partition_by=PARTITION_COLUMNS, replay_safe: bool = False) -> str:
    """Write quarantined rows beside ``target`` (same layout rules as the
    table, so a replayed batch replaces its own bad rows); returns the path."""
    path = quarantine_path(target)
    write_curated(bad, path, partition_by=partition_by, fmt=fmt, replay_safe=replay_safe)
    return path


def rescued_path(target: str) -> str:
    """Values that could not be kept in the table's types, beside it."""
    return target.rstrip("/") + "_rescued"
