"""Importing JSON control records written by file-based incremental jobs.

Two record kinds exist in the wild:

* a watermark object ``{"last_processed_time": "<ISO instant>"}``;
* one object per batch ``{"batch_id", "process_date", "watermark_ts", "files",
  ...}`` where ``files`` is either a list of path strings or a list of
  ``{"file_path": ...}`` objects, optionally with ``status``,
  ``records_processed``, ``error_message`` and ``job_end_time``.

Both are read with Spark's JSON reader (one pretty-printed object per file,
any number of files) and normalized to the ledger/watermark schemas, so the
history of an existing deployment can be appended to the ledger tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.casts import to_type

# ``files`` is read as raw JSON text so both shapes parse.
BATCH_JSON_SCHEMA = ("batch_id string, process_date string, watermark_ts string, files string, "
                     "status string, records_processed string, bad_records string, "
                     "error_message string, job_end_time string")
WATERMARK_JSON_SCHEMA = "last_processed_time string"


def _instant(c):
    return to_type(c, "timestamp")


def read_batch_records(spark: SparkSession, path) -> DataFrame:
    """Batch JSON records as ledger rows (``low_watermark`` unknown -> NULL)."""
    raw = spark.read.schema(BATCH_JSON_SCHEMA).option("multiLine", "true").json(path)
    items = F.from_json("files", "array<string>")
    files = F.transform(items, lambda x: F.coalesce(F.get_json_object(x, "$.file_path"), x))
    end = _instant("job_end_time")
    return raw.select(
        "batch_id",
        to_type("process_date", "date").alias("process_date"),
        F.lit(None).cast("timestamp").alias("low_watermark"),
        _instant("watermark_ts").alias("watermark_ts"),
        files.alias("files"),
        F.coalesce("status", F.lit("PLANNED")).alias("status"),
        to_type("records_processed", "bigint").alias("records_processed"),
        to_type("bad_records", "bigint").alias("bad_records"),
        "error_message",
        F.coalesce(end, _instant("watermark_ts")).alias("event_time"),
    )


def read_watermark_record(spark: SparkSession, path) -> DataFrame:
    """Watermark JSON as one row per file: ``last_processed_time`` (instant)."""
    raw = spark.read.schema(WATERMARK_JSON_SCHEMA).option("multiLine", "true").json(path)
    return raw.select(_instant("last_processed_time").alias("last_processed_time"))


def import_control_records(spark: SparkSession, control: str, batch_path=None,
                           watermark_path=None) -> None:
    """Append imported records to the ledger: batches as they are, the
    watermark as a ``WATERMARK`` row (not a batch)."""
    from ..sinks.ledger import LEDGER_SCHEMA, WATERMARK
    target = control.rstrip("/") + "/ledger"
    if batch_path is not None:
        read_batch_records(spark, batch_path).write.mode("append").parquet(target)
    if watermark_path is not None:
        cols = [f.split()[0] for f in LEDGER_SCHEMA.split(", ")]
        wm = read_watermark_record(spark, watermark_path)
        fields = {
            "batch_id": F.concat(F.lit("watermark_"),
                                 F.date_format("last_processed_time", "yyyyMMdd_HHmmss")),
            "watermark_ts": F.col("last_processed_time"),
            "status": F.lit(WATERMARK),
            "event_time": F.current_timestamp(),
        }
        empty = spark.createDataFrame([], LEDGER_SCHEMA)
        typed = {f.name: f.dataType for f in empty.schema.fields}
        wm.select(*[(fields[c] if c in fields else F.lit(None)).cast(typed[c]).alias(c)
                    for c in cols]).write.mode("append").parquet(target)
