"""Registered queries for conform, quality, incremental selection, sinks and
the ingest job, all on data Spark derives from the ``orders`` and ``events``
test tables (so their work grows with the tables).

``orders`` is rendered as raw all-string transaction records in three header
dialects. Some values are made bad by fixed rules on the data: the customer is
empty for status ``P`` (quarantined), the amount is ``n/a`` for priority
``4-NOT SPECIFIED`` (NULL after conversion), the quantity is written as
``"3.0"`` for status ``O`` (truncated to 3). The oracles compute the expected
typed values straight from ``orders``.
"""

from __future__ import annotations

from datetime import datetime, timezone

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.conform import conform, transform_v1, transform_v2
from ..operators.incremental import select_new_files
from ..operators.quality import quality_counts, split_by_key
from ..session import fresh_dir
from ..sinks import ledger as L
from ..sinks.tables import open_files, quarantine_path, rescued_path, write_curated, write_quarantine
from ..sources.csv import read_csv_batch
from ..sources.listing import list_everything
from ..sources.manifest import list_files
from ..sources.tables import read_curated, test_table
from .ingest import STEPS, IngestConfig, run_batch, run_until_drained

BATCH_ID, PROCESS_DATE = "batch_20260428_000000", "2026-04-28"

# Header dialects, source names that the aliases must know.
DIALECT_A = ["transaction_id", "custId", "txnAmt", "transaction_timestamp", "country",
             "product_id", "quantity", "status"]
DIALECT_B = ["Channel", "Qty", "TxnID", "Customer", "Amount", "Txn_Time", "Location", "PID",
             "State"]
DIALECT_C = ["id", "cust_id", "amt", "time"]


def _raw_fields(o: DataFrame) -> dict:
    """Canonical meaning -> raw string expression over ``orders``."""
    prio_digit = F.substring("o_orderpriority", 1, 1)
    return {
        "transaction_id": F.concat(F.lit("TXN"), F.col("o_orderkey").cast("string")),
        "customer_id": F.when(F.col("o_orderstatus") == "P", F.lit(None).cast("string"))
                        .otherwise(F.concat(F.lit("C"), F.col("o_custkey").cast("string"))),
        "transaction_amount": F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", F.lit("n/a"))
                               .otherwise(F.col("o_totalprice").cast("string")),
        "transaction_timestamp": F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'"),
        "country": F.substring("o_orderpriority", 3, 100),
        "product_id": F.concat(F.lit("P"), F.col("o_custkey").cast("string")),
        "quantity": F.when(F.col("o_orderstatus") == "O", F.concat(prio_digit, F.lit(".0")))
                     .otherwise(prio_digit),
        "status": F.col("o_orderstatus"),
        "channel": F.concat(F.lit("ch-"), prio_digit),
    }


_DIALECT_NAMES = {
    "A": dict(zip(["transaction_id", "customer_id", "transaction_amount", "transaction_timestamp",
                   "country", "product_id", "quantity", "status"], DIALECT_A)),
    "B": {"channel": "Channel", "quantity": "Qty", "transaction_id": "TxnID",
          "customer_id": "Customer", "transaction_amount": "Amount",
          "transaction_timestamp": "Txn_Time", "country": "Location", "product_id": "PID",
          "status": "State"},
    "C": {"transaction_id": "id", "customer_id": "cust_id", "transaction_amount": "amt",
          "transaction_timestamp": "time"},
}
_DIALECT_ORDER = {"A": DIALECT_A, "B": DIALECT_B, "C": DIALECT_C}


def raw_transactions(orders: DataFrame, dialect: str) -> DataFrame:
    """``orders`` as raw all-string records with a dialect's header."""
    fields = _raw_fields(orders)
    names = _DIALECT_NAMES[dialect]
    inv = {v: k for k, v in names.items()}
    return orders.select(*[fields[inv[h]].alias(h) for h in _DIALECT_ORDER[dialect]])


def _orders(spark, sf):
    return test_table(spark, sf, "orders")


def _split_frames(spark, sf):
    """Status F rows in dialect A, the rest in dialect B (with an extra column)."""
    o = _orders(spark, sf)
    return (raw_transactions(o.where(F.col("o_orderstatus") == "F"), "A"),
            raw_transactions(o.where(F.col("o_orderstatus") != "F"), "B"))


def _write_csv_landing(spark, sf) -> str:
    landing = fresh_dir(spark, "landing")
    a, b = _split_frames(spark, sf)
    a.write.option("header", "true").mode("errorifexists").csv(f"{landing}/dialect_a")
    b.write.option("header", "true").mode("errorifexists").csv(f"{landing}/dialect_b")
    return landing


# --- conform -------------------------------------------------------------------

def q_conform_v1(spark: SparkSession, sf: str) -> DataFrame:
    return transform_v1(raw_transactions(_orders(spark, sf), "A"), BATCH_ID, PROCESS_DATE)


def q_conform_aliases(spark: SparkSession, sf: str) -> DataFrame:
    return transform_v2(raw_transactions(_orders(spark, sf), "B"), BATCH_ID, PROCESS_DATE)


def q_conform_expected_schema(spark: SparkSession, sf: str) -> DataFrame:
    return conform(raw_transactions(_orders(spark, sf), "C"))


# --- quality split -------------------------------------------------------------

def _conformed_a(spark, sf):
    return transform_v2(raw_transactions(_orders(spark, sf), "A"), BATCH_ID, PROCESS_DATE)


def q_quality_good(spark: SparkSession, sf: str) -> DataFrame:
    return split_by_key(_conformed_a(spark, sf))[0]


def q_quality_bad(spark: SparkSession, sf: str) -> DataFrame:
    return split_by_key(_conformed_a(spark, sf))[1]


def q_quality_counts(spark: SparkSession, sf: str) -> DataFrame:
    return quality_counts(_conformed_a(spark, sf))


# --- incremental file window ----------------------------------------------------
# ``events`` stands in for a file manifest: one "file" per event, landed at ts.
# Bounds are real ts values: the last event before Jan 10 (exclusive low) and
# the last event before Jan 20 (inclusive cutoff), so both bounds are hit.

def _events_manifest(spark, sf):
    e = test_table(spark, sf, "events")
    return e.select(F.concat(F.lit("events/"), F.col("event_id").cast("string"), F.lit(".csv"))
                    .alias("path"), F.col("ts").alias("modificationTime"))


def _bound(spark, sf, before: str):
    e = test_table(spark, sf, "events")
    return e.where(F.col("ts") < F.lit(before).cast("timestamp_ntz")).agg(F.max("ts")).scalar()


def q_ingest_manifest(spark: SparkSession, sf: str) -> DataFrame:
    """The listing of a landing of nested folders and hidden names, one file of ``orders`` rows for
    each customer digit and status: how many files each folder holds, and which Spark would skip."""
    landing, o = fresh_dir(spark, "landing"), _orders(spark, sf)
    rows = raw_transactions(o, "A").withColumn("digit", F.pmod(F.substring("custId", 2, 20).cast("long"), F.lit(10)))
    with open_files(spark):
        for name, part in (("seen", rows.where("status <> 'O'")), ("_kept", rows.where("status = 'O'"))):
            (part.withColumn("state", F.col("status")).repartition("state", "digit").write
             .partitionBy("state", "digit").option("header", "true").csv(f"{landing}/{name}"))
    files = list_everything(spark, landing)
    folder = F.regexp_extract("path", r"/([^/]+/state=[^/]*/digit=[^/]*)/[^/]*$", 1)
    return files.groupBy(folder.alias("folder"), "hidden").agg(F.count(F.lit(1)).alias("files"))


def q_incremental_window(spark: SparkSession, sf: str) -> DataFrame:
    # Both bounds from one aggregate, as a scalar subquery.
    b = test_table(spark, sf, "events").agg(F.struct(*[
        F.max(F.when(F.col("ts") < F.lit(day).cast("timestamp_ntz"), F.col("ts"))).alias(name)
        for name, day in (("lo", "2024-01-10"), ("hi", "2024-01-20"))])).scalar()
    return select_new_files(_events_manifest(spark, sf), b["lo"], b["hi"])


def q_incremental_first_run(spark: SparkSession, sf: str) -> DataFrame:
    return select_new_files(_events_manifest(spark, sf), None, _bound(spark, sf, "2024-01-20"))


# --- sinks ----------------------------------------------------------------------

def q_partitioned_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Two batches with different process dates appended to one partitioned
    table, read back (partition column returns as a date)."""
    target = fresh_dir(spark, "curated")
    o = _orders(spark, sf)
    first = raw_transactions(o.where(F.col("o_orderstatus") == "F"), "A")
    rest = raw_transactions(o.where(F.col("o_orderstatus") != "F"), "A")
    write_curated(transform_v2(first, "batch_1", "2026-04-28"), target)
    write_curated(transform_v2(rest, "batch_2", "2026-04-29"), target)
    return read_curated(spark, target)


def q_schema_evolution_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """A later batch brings a new column; reading merges the schemas."""
    target = fresh_dir(spark, "curated")
    a, b = _split_frames(spark, sf)
    write_curated(transform_v2(a, "batch_1", "2026-04-28"), target)
    write_curated(transform_v2(b, "batch_2", "2026-04-29"), target)
    return read_curated(spark, target)


def q_quarantine_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Good rows to the table, bad rows beside it; both read back, labelled."""
    target = fresh_dir(spark, "curated")
    good, bad = split_by_key(_conformed_a(spark, sf))
    write_curated(good, target)
    write_quarantine(bad, target)
    return (read_curated(spark, target).withColumn("destination", F.lit("curated"))
            .unionByName(read_curated(spark, quarantine_path(target))
                         .withColumn("destination", F.lit("quarantine"))))


# --- CSV with mixed headers, and the whole job ----------------------------------

def q_mixed_header_csv(spark: SparkSession, sf: str) -> DataFrame:
    landing = _write_csv_landing(spark, sf)
    files = [r["path"] for r in list_files(spark, landing, "*.csv").select("path").collect()]
    return read_csv_batch(spark, files, per_header=conform)


def _expected_cols(df: DataFrame) -> DataFrame:
    return df.drop("batch_id", "process_date")


def q_ingest_batch(spark: SparkSession, sf: str) -> DataFrame:
    """Full run on a landing folder, then a second run that finds nothing new.
    Returns the curated table without the run stamps."""
    landing = _write_csv_landing(spark, sf)
    cfg = IngestConfig(landing=landing, target=fresh_dir(spark, "curated"),
                       control=fresh_dir(spark, "control"), replay_safe=True)
    # The landing folder is complete (nothing else writes to it), so the cutoff
    # may be "now" rather than the last completed second.
    run_batch(spark, cfg, cutoff=datetime.now(timezone.utc))
    run_batch(spark, cfg, cutoff=datetime.now(timezone.utc))
    return _expected_cols(read_curated(spark, cfg.target))


def q_ingest_batch_v1(spark: SparkSession, sf: str) -> DataFrame:
    """The first-generation job (fixed renames, three conversions, no quality
    split) over a landing of files in the original header, with that job's
    plain append layout (partitioned by process_date only)."""
    landing = fresh_dir(spark, "landing")
    raw_transactions(_orders(spark, sf), "A").write.option("header", "true") \
        .mode("errorifexists").csv(f"{landing}/dialect_a")
    cfg = IngestConfig(landing=landing, target=fresh_dir(spark, "curated"),
                       control=fresh_dir(spark, "control"), version="v1", replay_safe=False)
    run_batch(spark, cfg, cutoff=datetime.now(timezone.utc))
    return _expected_cols(read_curated(spark, cfg.target))


def _put(spark: SparkSession, lines: DataFrame, path: str, mtime: datetime | None = None) -> None:
    """Write one column of lines as files named like ``path`` behind a number, one for each
    partition, optionally back-dated."""
    folder = fresh_dir(spark, "file")
    lines.write.mode("append").text(folder)
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    to = jvm.org.apache.hadoop.fs.Path(path)
    fs = to.getFileSystem(conf)
    fs.mkdirs(to.getParent())
    parts = sorted(s.getPath().toString() for s in fs.listStatus(jvm.org.apache.hadoop.fs.Path(folder))
                   if s.getPath().getName().startswith("part-"))
    for k, part in enumerate(parts):
        name = to if k == 0 else jvm.org.apache.hadoop.fs.Path(to.getParent(), f"{k}{to.getName()}")
        fs.rename(jvm.org.apache.hadoop.fs.Path(part), name)
        if mtime:
            fs.setTimes(name, int(mtime.timestamp() * 1000), -1)


def _csv_lines(rows: DataFrame, blank: int = 0) -> DataFrame:
    """Rows as CSV lines; in each partition under a header, with some blank lines ahead of it."""
    head = [""] * blank + [",".join(rows.columns)]

    def run(batches):
        yield pa.RecordBatch.from_arrays([pa.array(head, pa.string())], names=["value"])
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0)], names=["value"])
    line = F.concat_ws(",", *[F.coalesce(c, F.lit("")) for c in rows.columns])
    return rows.select(line.alias("value")).mapInArrow(run, "value string")


# Names that globs, URIs or name filters would miss; one eighth of the orders each.
AWKWARD_NAMES = ["upper.CSV", "noextension", "txn 1.csv", "txn[1].csv", "100%.txt", "a{b}*#+ü.csv",
                 "2026/01/02/back.csv", "late.csv"]


def q_ingest_awkward_landing(spark: SparkSession, sf: str) -> DataFrame:
    """A landing of awkward names, leading blank lines, a back-dated day folder and,
    after the first run, a late file much older than the watermark: every row of
    ``orders`` with a customer arrives, exactly once."""
    landing, orders = fresh_dir(spark, "landing"), _orders(spark, sf)
    cfg = IngestConfig(landing=landing, target=fresh_dir(spark, "curated"), control=fresh_dir(spark, "control"))
    for i, name in enumerate(AWKWARD_NAMES):
        part = raw_transactions(orders.where(F.pmod("o_orderkey", F.lit(8)) == i), "AB"[i % 2])
        if name == "late.csv":
            run_batch(spark, cfg, cutoff=datetime.now(timezone.utc))
        old = datetime(2026, 1, 2, tzinfo=timezone.utc) if i > 5 else None
        _put(spark, _csv_lines(part, blank=i % 3), f"{landing}/{name}", old)
    run_until_drained(spark, cfg, cutoff=datetime.now(timezone.utc))
    return _expected_cols(read_curated(spark, cfg.target))


class _Killed(BaseException):
    """Ends a run at once, as losing the driver would: nothing of the job catches it."""


def q_ingest_crash_recovery(spark: SparkSession, sf: str) -> DataFrame:
    """Runs that die after each of the job's durable steps in turn, on small batches, then runs that
    do not: every row of ``orders`` with a customer arrives, exactly once."""
    landing, todo = _write_csv_landing(spark, sf), list(STEPS)
    files = list_files(spark, landing).count()

    def die(step: str) -> None:
        if todo and step == todo[0]:
            del todo[0]
            raise _Killed(step)
    cfg = IngestConfig(landing=landing, target=fresh_dir(spark, "curated"), control=fresh_dir(spark, "control"),
                       max_files=max(1, -(-files // 3)), on_step=die)
    cutoff = datetime.now(timezone.utc)
    while True:
        try:
            run_until_drained(spark, cfg, cutoff=cutoff)
            return _expected_cols(read_curated(spark, cfg.target))
        except _Killed:
            continue


def _two_runs(spark: SparkSession, sf: str) -> IngestConfig:
    cfg = IngestConfig(landing=_write_csv_landing(spark, sf), target=fresh_dir(spark, "curated"),
                       control=fresh_dir(spark, "control"))
    cutoff = datetime.now(timezone.utc)
    run_batch(spark, cfg, cutoff=cutoff)
    run_batch(spark, cfg, cutoff=cutoff)          # same cutoff: must not hide the first
    return cfg


def q_ingest_ledger(spark: SparkSession, sf: str) -> DataFrame:
    """The run record of two runs with one cutoff: status and counts of each batch, the
    rows of the table that carry the batch's id and date, whether it is the latest
    batch, and whether the watermark stands at its cutoff."""
    cfg = _two_runs(spark, sf)
    states = L.batch_states(spark, cfg.control)
    stamped = (read_curated(spark, cfg.target).groupBy("batch_id", "process_date")
               .agg(F.count(F.lit(1)).alias("stamped_rows")))
    latest = L.latest_batch(spark, cfg.control).select("batch_id", F.lit(True).alias("latest"))
    mark = L.watermark(spark, cfg.control).scalar()
    return (states.join(stamped, ["batch_id", "process_date"], "left").join(latest, "batch_id", "left")
            .select("status", "records_processed", "bad_records", "rejected_files", "hidden_files",
                    F.coalesce("stamped_rows", F.lit(0)).cast("long").alias("stamped_rows"),
                    F.coalesce(F.col("cast_failures")["transaction_amount"], F.lit(0)).cast("long").alias("amount_failures"),
                    F.coalesce("latest", F.lit(False)).alias("latest"),
                    (F.col("watermark_ts") == mark).alias("at_watermark")))


def q_ingest_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    """The bad rows of a real run, as the job quarantines them."""
    return _expected_cols(read_curated(spark, quarantine_path(_two_runs(spark, sf).target)))


def q_ingest_rescued(spark: SparkSession, sf: str) -> DataFrame:
    """The raw value of every field of a run that did not convert to its type."""
    cfg = IngestConfig(landing=_write_csv_landing(spark, sf), target=fresh_dir(spark, "curated"),
                       control=fresh_dir(spark, "control"), rescue=True)
    run_batch(spark, cfg, cutoff=datetime.now(timezone.utc))
    rows = read_curated(spark, rescued_path(cfg.target))
    return rows.select("transaction_id", F.explode("rescued").alias("field", "raw_value"),
                       F.col("line").isNotNull().alias("odd_line"))


def q_ingest_all_bad(spark: SparkSession, sf: str) -> DataFrame:
    """A landing of bad rows only: the table is there, typed and empty, and joins the
    quarantine's rows."""
    landing = fresh_dir(spark, "landing")
    raw_transactions(_orders(spark, sf).where("o_orderstatus = 'P'"), "A").write \
        .option("header", "true").mode("append").csv(landing)
    cfg = IngestConfig(landing=landing, target=fresh_dir(spark, "curated"), control=fresh_dir(spark, "control"))
    run_batch(spark, cfg, cutoff=datetime.now(timezone.utc))
    return _expected_cols(read_curated(spark, cfg.target).withColumn("destination", F.lit("curated")).unionByName(
        read_curated(spark, quarantine_path(cfg.target)).withColumn("destination", F.lit("quarantine"))))


def q_ingest_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The same through the availableNow file stream."""
    from ..streaming.ingest_stream import drain
    landing = _write_csv_landing(spark, sf)
    cfg = IngestConfig(landing=landing, target=fresh_dir(spark, "curated"),
                       control=fresh_dir(spark, "control"), replay_safe=True)
    drain(spark, cfg)
    drain(spark, cfg)   # nothing new: no second copy
    return _expected_cols(read_curated(spark, cfg.target))


QUERIES = {
    "conform_v1": q_conform_v1,
    "conform_aliases": q_conform_aliases,
    "conform_expected_schema": q_conform_expected_schema,
    "quality_good": q_quality_good,
    "quality_bad": q_quality_bad,
    "quality_counts": q_quality_counts,
    "incremental_window": q_incremental_window,
    "incremental_first_run": q_incremental_first_run,
    "partitioned_roundtrip": q_partitioned_roundtrip,
    "schema_evolution_roundtrip": q_schema_evolution_roundtrip,
    "quarantine_roundtrip": q_quarantine_roundtrip,
    "mixed_header_csv": q_mixed_header_csv,
    "ingest_batch": q_ingest_batch,
    "ingest_batch_v1": q_ingest_batch_v1,
    "ingest_stream": q_ingest_stream,
    "ingest_awkward_landing": q_ingest_awkward_landing,
    "ingest_crash_recovery": q_ingest_crash_recovery,
    "ingest_manifest": q_ingest_manifest,
    "ingest_ledger": q_ingest_ledger,
    "ingest_quarantine": q_ingest_quarantine,
    "ingest_all_bad": q_ingest_all_bad,
    "ingest_rescued": q_ingest_rescued,
}

# Expected typed values, straight from orders.
_TYPED = """
    SELECT 'TXN' || CAST(o_orderkey AS VARCHAR) AS transaction_id,
           CASE WHEN o_orderstatus = 'P' THEN NULL
                ELSE 'C' || CAST(o_custkey AS VARCHAR) END AS customer_id,
           CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN NULL
                ELSE o_totalprice END AS transaction_amount,
           o_orderdate AS transaction_timestamp,
           substr(o_orderpriority, 3) AS country,
           'P' || CAST(o_custkey AS VARCHAR) AS product_id,
           CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS quantity,
           o_orderstatus AS status,
           'ch-' || substr(o_orderpriority, 1, 1) AS channel,
           o_orderstatus AS src_status
    FROM orders
"""
_CORE = ("transaction_id, customer_id, transaction_amount, transaction_timestamp, country, "
         "product_id, quantity, status")
_STAMPS = f"'{BATCH_ID}' AS batch_id, DATE '{PROCESS_DATE}' AS process_date"
_TWO_BATCHES = ("CASE WHEN src_status = 'F' THEN 'batch_1' ELSE 'batch_2' END AS batch_id, "
                "CASE WHEN src_status = 'F' THEN DATE '2026-04-28' ELSE DATE '2026-04-29' END "
                "AS process_date")
_CHANNEL_B = "CASE WHEN src_status = 'F' THEN NULL ELSE channel END AS channel"
_BOUNDS = """
    (SELECT MAX(ts) FROM events WHERE ts < TIMESTAMP '2024-01-10') AS lo,
    (SELECT MAX(ts) FROM events WHERE ts < TIMESTAMP '2024-01-20') AS hi
"""

SQL = {
    "conform_v1": f"SELECT {_CORE}, {_STAMPS} FROM ({_TYPED}) t",
    "conform_aliases": f"SELECT {_CORE}, channel, {_STAMPS} FROM ({_TYPED}) t",
    "conform_expected_schema": f"""
        SELECT transaction_id, customer_id, transaction_amount, transaction_timestamp,
               CAST(NULL AS VARCHAR) AS country, CAST(NULL AS VARCHAR) AS product_id,
               CAST(NULL AS INTEGER) AS quantity, CAST(NULL AS VARCHAR) AS status
        FROM ({_TYPED}) t""",
    "quality_good": f"SELECT {_CORE}, {_STAMPS} FROM ({_TYPED}) t WHERE customer_id IS NOT NULL",
    "quality_bad": f"SELECT {_CORE}, {_STAMPS} FROM ({_TYPED}) t WHERE customer_id IS NULL",
    "quality_counts": f"""
        SELECT COUNT(*) AS total_rows, COUNT(customer_id) AS good_rows,
               COUNT(*) - COUNT(customer_id) AS bad_rows
        FROM ({_TYPED}) t""",
    "incremental_window": f"""
        SELECT 'events/' || CAST(event_id AS VARCHAR) || '.csv' AS path, ts AS modificationTime
        FROM events, (SELECT {_BOUNDS}) b
        WHERE ts > b.lo AND ts <= b.hi""",
    "incremental_first_run": f"""
        SELECT 'events/' || CAST(event_id AS VARCHAR) || '.csv' AS path, ts AS modificationTime
        FROM events, (SELECT {_BOUNDS}) b
        WHERE ts <= b.hi""",
    "partitioned_roundtrip": f"SELECT {_CORE}, {_TWO_BATCHES} FROM ({_TYPED}) t",
    "schema_evolution_roundtrip": f"SELECT {_CORE}, {_CHANNEL_B}, {_TWO_BATCHES} FROM ({_TYPED}) t",
    "quarantine_roundtrip": f"""
        SELECT {_CORE}, {_STAMPS},
               CASE WHEN customer_id IS NULL THEN 'quarantine' ELSE 'curated' END AS destination
        FROM ({_TYPED}) t""",
    "mixed_header_csv": f"SELECT {_CORE}, {_CHANNEL_B} FROM ({_TYPED}) t",
    "ingest_batch": f"SELECT {_CORE}, {_CHANNEL_B} FROM ({_TYPED}) t WHERE customer_id IS NOT NULL",
}
SQL["ingest_stream"] = SQL["ingest_crash_recovery"] = SQL["ingest_batch"]
_KEY = "CAST(substr(transaction_id, 4) AS BIGINT)"
SQL["ingest_awkward_landing"] = f"""
    SELECT {_CORE}, CASE WHEN {_KEY} % 8 % 2 = 0 THEN NULL ELSE channel END AS channel
    FROM ({_TYPED}) t WHERE customer_id IS NOT NULL"""
SQL["ingest_ledger"] = f"""
    SELECT 'SUCCESS' AS status, COUNT(customer_id) AS records_processed,
           COUNT(*) - COUNT(customer_id) AS bad_records, CAST(0 AS BIGINT) AS rejected_files,
           CAST(0 AS BIGINT) AS hidden_files, COUNT(customer_id) AS stamped_rows,
           COUNT(*) - COUNT(transaction_amount) AS amount_failures, TRUE AS latest, TRUE AS at_watermark
    FROM ({_TYPED}) t
    UNION ALL
    SELECT 'NO_FILES', 0, 0, 0, 0, 0, 0, FALSE, TRUE"""
SQL["ingest_rescued"] = """
    SELECT 'TXN' || CAST(o_orderkey AS VARCHAR) AS transaction_id, 'transaction_amount' AS field,
           'n/a' AS raw_value, FALSE AS odd_line
    FROM orders WHERE o_orderpriority = '4-NOT SPECIFIED'"""
SQL["ingest_manifest"] = f"""
    SELECT DISTINCT CASE WHEN status = 'O' THEN '_kept' ELSE 'seen' END || '/state=' || status || '/digit=' ||
           coalesce((CAST(substr(customer_id, 2) AS BIGINT) % 10)::VARCHAR, '__HIVE_DEFAULT_PARTITION__') AS folder,
           status = 'O' AS hidden, CAST(1 AS BIGINT) AS files
    FROM ({_TYPED}) t"""
SQL["ingest_quarantine"] = f"SELECT {_CORE}, {_CHANNEL_B} FROM ({_TYPED}) t WHERE customer_id IS NULL"
SQL["ingest_all_bad"] = f"""
    SELECT {_CORE}, 'quarantine' AS destination FROM ({_TYPED}) t WHERE customer_id IS NULL"""
SQL["ingest_batch_v1"] = f"SELECT {_CORE} FROM ({_TYPED}) t"
