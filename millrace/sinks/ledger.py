"""Control table: the batch ledger, which also carries the watermark.

Two append-only Parquet tables under a control folder. ``ledger`` has a few rows
for each batch and no paths; ``files`` has a row for each file of a batch and
one for its outcome. Nothing is overwritten in place: the state of a batch is
its ``SUCCESS`` row if it has one, else its latest row; the "latest batch" is the
newest batch by cutoff; and the watermark is the newest cutoff among *finished*
rows (``SUCCESS``, ``NO_FILES``, or an explicit ``WATERMARK`` row). A crashed run
therefore leaves history that a later run can read and finish.

Commit order used by the ingest job: ``files`` rows of an attempt -> claim
(``claims``) -> ledger ``PLANNED`` row -> data -> outcomes of files -> ledger ``SUCCESS``
row. The claim is the one commit point of planning: before it the rows of ``files``
belong to nobody and their files are free, after it the batch is pending, with or
without its ``PLANNED`` row. The last single-file append is the one commit point of
loading: it records the batch as done and moves the watermark at once, so no
crash can leave a finished batch behind an old watermark (which would make the
next run ingest its files again), and a failure before it never skips files.
"""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import path_exists
from .claims import claim_rows, claims_path

LEDGER_SCHEMA = ("batch_id string, process_date date, low_watermark timestamp, "
                 "watermark_ts timestamp, status string, n_files bigint, rejected_files bigint, "
                 "hidden_files bigint, full_listing boolean, records_processed bigint, "
                 "bad_records bigint, error_message string, event_time timestamp, "
                 "cast_failures map<string,bigint>")
FILES_SCHEMA = ("batch_id string, path string, modificationTime timestamp, length bigint, "
                "state string, error string, event_time timestamp, attempt string")
PLANNED, SUCCESS, FAILED, NO_FILES = "PLANNED", "SUCCESS", "FAILED", "NO_FILES"
WATERMARK = "WATERMARK"      # a watermark move that is not a batch (manual or imported)
ABANDONED = "ABANDONED"      # given up by hand; its files stay taken
RELEASED = "RELEASED"        # given up by hand; its files may be taken again
TERMINAL = (SUCCESS, NO_FILES, WATERMARK, ABANDONED, RELEASED)
MOVES_WATERMARK = (SUCCESS, NO_FILES, WATERMARK)
DONE, REJECTED, HIDDEN = "DONE", "REJECTED", "HIDDEN"    # outcomes of files


def _ledger_path(control: str) -> str:
    return control.rstrip("/") + "/ledger"


def now() -> datetime:
    return datetime.now(timezone.utc)


def _append(spark: SparkSession, path: str, schema: str, row: dict) -> None:
    names = [f.split()[0] for f in schema.split(", ")]
    append_control(spark.createDataFrame([tuple(row.get(n) for n in names)], schema), path)


def append_control(rows: DataFrame, path: str) -> None:
    """Append a few rows to a control table, as one small file in a folder of its own: writers
    that share an output folder share its temporary files, and would remove each other's."""
    rows.coalesce(1).write.mode("errorifexists").parquet(f"{path}/{now():%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:12]}")


def read_control(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A control table, whose files lie in folders of their own (or, of older versions, flat)."""
    return spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(path)


def record_batch(spark: SparkSession, control: str, **fields) -> dict:
    """Append one ledger row; ``event_time`` is stamped now."""
    row = dict(fields)
    row.setdefault("event_time", now())
    if isinstance(row.get("process_date"), str):
        row["process_date"] = datetime.fromisoformat(row["process_date"]).date()
    _append(spark, _ledger_path(control), LEDGER_SCHEMA, row)
    return row


def _existing_ledger(spark: SparkSession, control: str) -> DataFrame | None:
    """The ledger table, or ``None`` before its first row is written."""
    if path_exists(_ledger_path(control)) is False:
        return None
    try:
        return read_control(spark, _ledger_path(control), LEDGER_SCHEMA)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
            return None
        raise


def ledger_rows(spark: SparkSession, control: str) -> DataFrame:
    """Every ledger row ever written (empty before the first run)."""
    return _read(spark, _ledger_path(control), LEDGER_SCHEMA)


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A control table, empty before its first row."""
    if path_exists(path) is False:
        return spark.createDataFrame([], schema)
    try:
        return read_control(spark, path, schema)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
            return spark.createDataFrame([], schema)
        raise


def record_files(spark: SparkSession, control: str, batch_id: str, rows: list, state: str,
                 attempt: str | None = None) -> None:
    """Append one row for each ``(path, modificationTime, length, error)`` of one batch.

    Rows of an ``attempt`` count once a claim names it; others once the ledger has the batch."""
    if rows:
        at = now()
        append_control(spark.createDataFrame([(batch_id, p, m, n, state, e, at, attempt) for p, m, n, e in rows],
                                             FILES_SCHEMA), control.rstrip("/") + "/files")


def record_listing(files: DataFrame, control: str, batch_id: str, state: str, error: str | None,
                   attempt: str | None = None) -> int:
    """Append a row for each file of a listing, without bringing them to the driver; their number."""
    seen = Observation("files")
    rows = files.select(F.lit(batch_id).alias("batch_id"), "path", "modificationTime", "length",
                        F.lit(state).alias("state"), F.lit(error).alias("error"),
                        F.current_timestamp().alias("event_time"), F.lit(attempt).cast("string").alias("attempt"))
    folder = f"{control.rstrip('/')}/files/{now():%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:12]}"
    rows.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("errorifexists").parquet(folder)
    return int(seen.get["n"])


def file_rows(spark: SparkSession, control: str) -> DataFrame:
    """Every file row ever written."""
    return _read(spark, control.rstrip("/") + "/files", FILES_SCHEMA)


def owned_files(spark: SparkSession, control: str) -> DataFrame:
    """The rows of ``files`` that belong to a batch: of a claimed attempt, or of no attempt and
    a batch of the ledger. What a crashed or beaten run left is not among them."""
    rows = file_rows(spark, control)
    claimed = claim_rows(spark, control).select("batch_id", "attempt")
    known = ledger_rows(spark, control).select("batch_id").distinct()
    return (rows.where(F.col("attempt").isNotNull()).join(claimed, ["batch_id", "attempt"], "left_semi")
            .unionByName(rows.where(F.col("attempt").isNull()).join(known, "batch_id", "left_semi")))


def taken_files(spark: SparkSession, control: str) -> DataFrame:
    """``(path, modificationTime)`` of the files of all batches but released ones."""
    freed = ledger_rows(spark, control).where(F.col("status") == RELEASED).select("batch_id")
    return (owned_files(spark, control).where(F.col("state").isin(PLANNED, HIDDEN))
            .join(freed, "batch_id", "left_anti").select("path", "modificationTime"))


def batch_files(spark: SparkSession, control: str, batch_id: str) -> list:
    """``(path, modificationTime, length)`` of one batch's files (bounded by the plan)."""
    rows = owned_files(spark, control).where((F.col("batch_id") == batch_id) & (F.col("state") == PLANNED))
    return sorted((r["path"], as_utc(r["modificationTime"]), r["length"]) for r in rows.collect())


def abandon_batch(spark: SparkSession, control: str, batch_id: str, note: str | None = None,
                  release: bool = False) -> None:
    """Give up an unfinished batch, so that later files can be taken. Its files stay
    recorded as taken, or with ``release`` may be taken by the next batch. The
    watermark does not move."""
    record_batch(spark, control, batch_id=batch_id, status=RELEASED if release else ABANDONED,
                 error_message=note)


def unused_batch_id(spark: SparkSession, control: str, batch_id: str) -> str:
    """``batch_id``, or with a run suffix if the ledger or a claim already has it."""
    same = F.col("batch_id").rlike(f"^{batch_id}(_r[0-9]+)?$")
    known = ledger_rows(spark, control).select("batch_id").unionByName(claim_rows(spark, control).select("batch_id"))
    n = known.where(same).distinct().count()
    return f"{batch_id}_r{n + 1}" if n else batch_id


def _with_claims(spark: SparkSession, control: str) -> DataFrame:
    """Ledger rows, and a ``PLANNED`` row for each claimed batch (a run may have ended between both)."""
    claims = claim_rows(spark, control).where(F.col("batch_id").isNotNull()).drop("attempt")
    return ledger_rows(spark, control).unionByName(claims.withColumn("status", F.lit(PLANNED)),
                                                   allowMissingColumns=True)


def batch_states(spark: SparkSession, control: str) -> DataFrame:
    """Current state of each batch: its ``SUCCESS`` row, else its latest row (of the ledger or,
    before that has one, its claim)."""
    rows = _with_claims(spark, control).where(F.col("status") != WATERMARK)
    cols = rows.columns
    return (rows.groupBy("batch_id")
                .agg(F.max_by(F.struct(*cols), F.struct(F.col("status") == SUCCESS, "event_time")).alias("s"))
                .select("s.*"))


def _state(spark: SparkSession, control: str, rows: DataFrame | None = None) -> DataFrame:
    """One row, one global aggregate over the (path-free) ledger: ``latest``, the newest
    row of the newest batch by cutoff, where a run that found nothing never hides
    one that loaded data; ``last_processed_time``, the newest cutoff among finished
    rows; and the time of the last finished run that listed the whole landing."""
    rows = rows if rows is not None else ledger_rows(spark, control)
    is_batch = (F.col("status") != WATERMARK) & F.col("watermark_ts").isNotNull()
    order = F.when(is_batch, F.struct("watermark_ts", F.col("status") != NO_FILES,
                                      F.col("status") == SUCCESS, "event_time"))
    finished = F.col("status").isin(SUCCESS, NO_FILES)
    return rows.agg(
        F.max_by(F.struct(*rows.columns), order).alias("latest"),
        F.max(F.when(F.col("status").isin(*MOVES_WATERMARK), F.col("watermark_ts"))).alias("last_processed_time"),
        F.max(F.when(finished & F.col("full_listing"), F.col("event_time"))).alias("last_full"))


def latest_batch(spark: SparkSession, control: str) -> DataFrame:
    """The newest batch (by cutoff) and its state; zero or one row."""
    return _state(spark, control).where(F.col("latest").isNotNull()).select("latest.*")


def control_state(spark: SparkSession, control: str):
    """``(pending, watermark)``: the newest batch that did not finish
    (``PLANNED``/``FAILED``, to be re-run before anything new) or ``None``, and the
    watermark as an aware UTC datetime or ``None``."""
    open_, mark = open_batches(spark, control)
    return (open_[0] if open_ else None), mark


def open_batches(spark: SparkSession, control: str):
    """``(batches, watermark)``: the batches that did not finish, newest first (at most one for
    each run at work), and the watermark."""
    rows = _existing_ledger(spark, control)
    if rows is None and path_exists(claims_path(control)) is False:     # first run: no job needed
        return [], None
    open_ = batch_states(spark, control).where(~F.col("status").isin(*TERMINAL)).collect()
    mark = _state(spark, control, rows).first()["last_processed_time"]
    return sorted(open_, key=lambda r: r["event_time"], reverse=True), as_utc(mark)


def runs_since_full_listing(spark: SparkSession, control: str) -> int:
    """Finished runs after the last one that listed the whole landing."""
    last = _state(spark, control).first()["last_full"]
    rows = ledger_rows(spark, control).where(F.col("status").isin(SUCCESS, NO_FILES))
    return rows.where(F.col("event_time") > F.lit(last)).count() if last else rows.count()


def pending_batch(spark: SparkSession, control: str):
    """The newest batch if it did not finish, as a Row, else ``None``."""
    return control_state(spark, control)[0]


def watermark(spark: SparkSession, control: str) -> DataFrame:
    """One row: ``last_processed_time``, the newest cutoff of a finished row
    (NULL before the first run)."""
    return _state(spark, control).select("last_processed_time")


def current_watermark(spark: SparkSession, control: str):
    """The watermark as an aware UTC datetime, or ``None`` on a first run."""
    return control_state(spark, control)[1]


def as_utc(ts):
    """A collected timestamp as an aware UTC datetime. PySpark returns
    instants as naive datetimes in the Python process's local zone."""
    if ts is None:
        return None
    return ts.astimezone(timezone.utc)


def advance_watermark(spark: SparkSession, control: str, cutoff: datetime,
                      note: str | None = None) -> None:
    """Record ``cutoff`` as processed without a batch (e.g. importing the
    watermark of an earlier deployment). Never moves the watermark backwards:
    readers take the maximum."""
    record_batch(spark, control, batch_id=f"watermark_{cutoff:%Y%m%d_%H%M%S}",
                 watermark_ts=cutoff, status=WATERMARK, error_message=note)
