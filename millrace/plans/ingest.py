"""The incremental ingest job: new files -> conformed, typed, partitioned table.

One run (``run_batch`` = ``plan_batch`` then ``process_batch``, which can also
run as two separate jobs) takes one bounded batch; ``run_until_drained`` repeats
it until nothing is left:

1. take the cutoff (last completed second) *before* listing;
2. if a batch never finished and no other run holds it, re-run exactly that
   batch (same id, same files); otherwise
3. list the landing folder (in executors, every name) and keep the files with
   ``mtime <= cutoff`` that no batch has taken yet (an anti-join of the listing
   with the ``files`` control table on path and mtime). The oldest ones, up to
   ``max_files`` and ``max_bytes``, are the batch; with files left over, the batch's
   cutoff is lowered to before the first of them. No files -> ledger
   ``NO_FILES``, watermark -> cutoff, stop;
4. append the batch's files to ``files`` under an attempt, claim the batch by
   creating the next numbered claim (see ``sinks/claims.py``; a run that was beaten
   to it goes back to 2), then the ledger's ``PLANNED`` row;
5. read the files grouped by header, standardize each group, union by name. A
   file that is gone, or whose header cannot be mapped, is rejected on its own;
6. write good rows to the curated table, counting rows and bad rows with an
   ``Observation`` on the same pass; quarantine bad rows beside the table;
7. outcomes of the files, then ledger ``SUCCESS`` with counts: the single commit
   point, which also moves the watermark.

Any failure in 5-7 appends a ``FAILED`` ledger row (with the whole error) and
re-raises; the watermark does not move, so the next run retries the batch,
unless it is given up with ``abandon_batch``. With ``replay_safe`` (the default)
the table is partitioned by (process_date, batch_id) and written with dynamic
partition overwrite, so a retried batch replaces its own partitions and never
duplicates rows; with it off, the table is a plain append partitioned by
process_date (a batch re-run after its data write but before its ledger commit
would then add its rows twice).

Any number of runs may work on one landing: a file belongs to one claimed
batch, and a batch to the run that holds its lease (``lease_seconds``; a run that
fails, or a later run of the same ``owner``, need not wait for its end). A run that
dies between any two writes loses nothing: what it had not claimed is free, what
it had claimed is pending.

Because files are chosen by what was taken and not by the watermark alone, a
file that appears late with an old mtime, in an old day folder, or beside files
of the same second is never skipped. Names Spark's readers cannot see (a leading
``_`` or ``.``) are recorded in ``files`` as ``HIDDEN`` and counted in the ledger.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.conform import FAIL_PREFIX, RESCUED, failure_flags, transform_v1, transform_v2
from ..operators.incremental import (batch_identity, day_folders_glob, run_cutoff,
                                     select_new_files)
from ..operators.quality import KEY_COLUMN, is_bad
from ..sinks import claims as C
from ..sinks import ledger as L
from ..sinks.tables import rescued_path, write_curated, write_quarantine
from ..sources.csv import read_csv_batch
from ..sources.listing import can_list, list_everything
from ..sources.manifest import MANIFEST_SCHEMA, hidden_files, list_files


@dataclass
class IngestConfig:
    landing: str                 # folder new CSV files arrive in
    target: str                  # curated table path
    control: str                 # folder for the ledger table
    version: str = "v2"          # "v1": fixed renames, no split; "v2": aliases + quality split
    glob: str | None = None      # an optional filter on names; by default every file counts
    day_folders: str | None = None   # e.g. "%Y/%m/%d": landing laid out by arrival day
    margin_days: int = 1             # day folders listed before the watermark's day
    full_listing_every: int = 24     # with day folders: every so many runs list everything
    replay_safe: bool = True         # False: plain append by process_date only
    max_files: int = 10_000          # bounds of one batch, and so of the paths the driver
    max_bytes: int = 1 << 40         # holds; the rest waits for the next batch
    fmt: str = "parquet"
    rescue: bool = False             # v2: keep raw values that did not convert, and whole odd lines
    owner: str | None = None         # who holds leases; by default the Spark application
    lease_seconds: int = 6 * 3600    # how long another owner leaves an unfinished batch alone
    on_step: Callable[[str], None] | None = None     # told after each step is durable


#: The steps told to ``on_step``, in order.
STEPS = ("files", "claimed", "planned", "data", "quarantine", "outcomes", "finished")


class Overtaken(RuntimeError):
    """Another run took this batch over, because its lease had ended."""


def _told(cfg: IngestConfig, step: str) -> None:
    if cfg.on_step:
        cfg.on_step(step)


def standardize(version: str, batch_id: str, process_date):
    """The per-header-group standardization step of a job version."""
    if version == "v1":
        return lambda df: transform_v1(df, batch_id, process_date)
    if version == "v2":
        return lambda df: transform_v2(df, batch_id, process_date, flag_failures=True)
    raise ValueError(f"unknown version {version!r}")


SOURCE_FILE = "__source_file"
CORRUPT = "__line"
KEY_RECORD = "transaction_id"


def ingest_files(spark: SparkSession, files: list, batch_id: str, process_date,
                 cfg: IngestConfig) -> dict:
    """Steps 5-6 for an explicit file list (one bounded batch); returns the counts, and
    ``rejected``: (path, error) of files left out.

    One pass reads, standardizes and writes the good rows while an
    Observation counts rows, bad rows and conversion failures and collects the
    files that held bad rows (at most the batch's ``max_files`` paths). Only
    those files are read again, to write the quarantine, so a clean batch is
    read once and a batch with one bad file re-reads one file, not the batch."""
    step = standardize(cfg.version, batch_id, process_date)
    rejected: list = []
    corrupt = CORRUPT if cfg.rescue and cfg.version == "v2" else None
    df = read_csv_batch(spark, files, per_header=step, file_column=SOURCE_FILE, rejected=rejected,
                        corrupt_column=corrupt)
    if df is None:
        return {"records_processed": 0, "bad_records": 0, "cast_failures": None, "rejected": rejected}
    flags = failure_flags(df)
    split = cfg.version == "v2"       # the first-generation job has no quality split
    metrics = [F.count(F.lit(1)).alias("rows")]
    if split:
        metrics += [F.count_if(is_bad(KEY_COLUMN)).alias("bad"),
                    F.collect_set(F.when(is_bad(KEY_COLUMN), F.col(SOURCE_FILE))).alias("bad_files")]
    metrics += [F.count_if(F.coalesce(F.col(c), F.lit(False))).alias(c) for c in flags]
    rescue = cfg.rescue and split
    if rescue:
        odd = F.col(CORRUPT).isNotNull()
        for c in flags:
            odd = odd | F.coalesce(F.col(c), F.lit(False))
        metrics.append(F.collect_set(F.when(odd, F.col(SOURCE_FILE))).alias("odd_files"))
    obs = Observation("ingest")
    observed = df.observe(obs, *metrics)
    good = observed.where(~is_bad()) if split else observed
    write_curated(good.drop(*flags, SOURCE_FILE, CORRUPT), cfg.target, fmt=cfg.fmt,
                  replay_safe=cfg.replay_safe)
    _told(cfg, "data")
    m = obs.get
    bad = int(m.get("bad", 0) or 0)
    if bad > 0:
        again = read_csv_batch(spark, sorted(m["bad_files"]), per_header=step)      # without raw lines
        write_quarantine(again.where(is_bad()).drop(*failure_flags(again)), cfg.target,
                         fmt=cfg.fmt, replay_safe=cfg.replay_safe)
    _told(cfg, "quarantine")
    if rescue and m["odd_files"]:
        _write_rescued(spark, sorted(m["odd_files"]), batch_id, process_date, cfg)
    failures = {c[len(FAIL_PREFIX):]: int(m[c]) for c in flags}
    return {"records_processed": int(m["rows"]) - bad, "bad_records": bad,
            "cast_failures": failures or None, "rejected": rejected}


def _write_rescued(spark: SparkSession, files: list, batch_id: str, process_date, cfg: IngestConfig) -> None:
    """Raw values that did not convert, and whole lines with too many or too few fields, beside the
    table; only the files that hold some are read again."""
    def step(df):
        return transform_v2(df, batch_id, process_date, rescue=True)
    rows = read_csv_batch(spark, files, per_header=step, file_column=SOURCE_FILE, corrupt_column=CORRUPT)
    kept = rows.where((F.size(RESCUED) > 0) | F.col(CORRUPT).isNotNull()).select(
        F.col(KEY_RECORD), F.col(RESCUED).alias("rescued"), F.col(CORRUPT).alias("line"),
        F.col(SOURCE_FILE).alias("source_file"), "batch_id", "process_date")
    write_curated(kept, rescued_path(cfg.target), fmt=cfg.fmt, replay_safe=cfg.replay_safe)


def plan_batch(spark: SparkSession, cfg: IngestConfig, cutoff: datetime | None = None) -> dict:
    """Step one (find the files): returns the batch to process as a dict, with its paths
    under ``files``.

    A batch that never finished is returned again (same id, files and cutoff)
    instead of planning a new one. Otherwise the landing folder is listed, and
    the batch is recorded, or, with no new files, a ``NO_FILES`` row is appended
    and the watermark moves to the cutoff."""
    cutoff = cutoff or run_cutoff()
    while True:
        number = C.next_claim(spark, cfg.control)       # before anything is read that a claim could change
        open_, low = L.open_batches(spark, cfg.control)
        for pending in open_:
            if pending["status"] != L.FAILED and C.held_by_other(spark, cfg.control, pending["batch_id"], _owner(spark, cfg)):
                continue
            return dict(batch_id=pending["batch_id"], process_date=pending["process_date"],
                        low_watermark=L.as_utc(pending["low_watermark"]),
                        watermark_ts=L.as_utc(pending["watermark_ts"]), full_listing=pending["full_listing"],
                        n_files=pending["n_files"], hidden_files=pending["hidden_files"],
                        files=[p for p, _, _ in L.batch_files(spark, cfg.control, pending["batch_id"])],
                        status=pending["status"])
        batch = _new_batch(spark, cfg, number, low, cutoff)
        if batch is not None:
            return batch


def _owner(spark: SparkSession, cfg: IngestConfig) -> str:
    return cfg.owner or spark.sparkContext.applicationId


def _new_batch(spark: SparkSession, cfg: IngestConfig, number: int, low, cutoff: datetime) -> dict | None:
    """A batch of files nobody has, claimed under ``number``; ``None`` if another run was faster."""
    where, full = cfg.landing, True
    if cfg.day_folders and low and L.runs_since_full_listing(spark, cfg.control) + 1 < cfg.full_listing_every:
        where, full = day_folders_glob(cfg.landing, cfg.day_folders, low, cutoff, cfg.margin_days), False
    taken = L.taken_files(spark, cfg.control)
    hidden, seen = None, None
    if full and can_list(spark, where):
        # One listing, made in executors; it also counts the names that Spark's readers skip.
        seen = Observation("listing")
        listed = list_everything(spark, where, cfg.glob).observe(seen, F.count_if("hidden").alias("hidden"))
        listed = listed.where(~F.col("hidden")).drop("hidden")
    else:
        listed = list_files(spark, where, cfg.glob)
    new = (select_new_files(listed, None, cutoff)
           .join(taken, ["path", "modificationTime"], "left_anti"))
    cutoff, files = _bounded(new, cutoff, cfg)
    if seen is not None and seen.get["hidden"]:
        hidden = list_everything(spark, where).where("hidden").drop("hidden")
    elif full and seen is None:
        hidden = spark.createDataFrame(hidden_files(spark, cfg.landing), MANIFEST_SCHEMA)
    batch_id, process_date = batch_identity(cutoff)
    batch_id = L.unused_batch_id(spark, cfg.control, batch_id)
    attempt = uuid.uuid4().hex if files else None
    n_hidden = 0
    if hidden is not None:
        left = select_new_files(hidden, None, cutoff).join(taken, ["path", "modificationTime"], "left_anti")
        n_hidden = L.record_listing(left, cfg.control, batch_id, L.HIDDEN, "a name Spark's readers skip", attempt)
    base = dict(batch_id=batch_id, process_date=process_date, low_watermark=low, watermark_ts=cutoff,
                n_files=len(files), hidden_files=n_hidden, full_listing=full)
    L.record_files(spark, cfg.control, batch_id, [(*f, None) for f in files], L.PLANNED, attempt)
    _told(cfg, "files")
    if not files:
        # A batch without files is finished: it also moves the watermark to the cutoff.
        row = L.record_batch(spark, cfg.control, **base, status=L.NO_FILES, records_processed=0, bad_records=0,
                             rejected_files=0)
        return {**row, "files": []}
    if not C.claim(spark, cfg.control, number, **base, attempt=attempt, event_time=L.now()):
        return None
    _told(cfg, "claimed")
    row = L.record_batch(spark, cfg.control, **base, status=L.PLANNED)
    _told(cfg, "planned")
    return {**row, "files": [p for p, _, _ in files]}


def _bounded(new, cutoff: datetime, cfg: IngestConfig) -> tuple[datetime, list]:
    """The oldest files of the listing within the bounds of a batch (one at least), and the
    cutoff, lowered to before the first file that is left for the next batch."""
    oldest = (new.orderBy("modificationTime", "path").limit(cfg.max_files + 1)
              .select("path", "modificationTime", "length").collect())
    files, size = [], 0
    for r in oldest:
        size += r["length"]
        if files and (len(files) == cfg.max_files or size > cfg.max_bytes):
            return min(cutoff, L.as_utc(r["modificationTime"]) - timedelta(microseconds=1)), files
        files.append((r["path"], L.as_utc(r["modificationTime"]), r["length"]))
    return cutoff, files


def process_batch(spark: SparkSession, cfg: IngestConfig, batch: dict | None = None) -> dict:
    """Step two (process the files): read, standardize, split, write; then
    ``SUCCESS`` and the watermark, or ``FAILED`` and re-raise. Without
    ``batch`` the newest unfinished batch of the ledger is processed."""
    if batch is None:
        if L.pending_batch(spark, cfg.control) is None:   # nothing to do: latest state
            latest = L.latest_batch(spark, cfg.control).first()
            return latest.asDict() if latest is not None else {"status": L.NO_FILES}
        batch = plan_batch(spark, cfg)
    if batch.get("status") in L.TERMINAL:
        return batch
    held = C.lease(spark, cfg.control, batch["batch_id"], _owner(spark, cfg), cfg.lease_seconds,
                   failed=batch.get("status") == L.FAILED)
    if not held:
        raise Overtaken(f"another run holds {batch['batch_id']}")
    base = {k: batch[k] for k in ("batch_id", "process_date", "low_watermark", "watermark_ts",
                                  "n_files", "hidden_files", "full_listing")}
    return {**finish(spark, cfg, base, batch["files"], held), "files": batch["files"]}


def finish(spark: SparkSession, cfg: IngestConfig, base: dict, files: list, lease: int | None = None) -> dict:
    """Load the files of a recorded batch and write its outcome to the control tables."""
    def check() -> None:
        if lease and not C.holds(spark, cfg.control, base["batch_id"], lease):
            raise Overtaken(f"another run took over {base['batch_id']}")
    try:
        counts = ingest_files(spark, files, base["batch_id"], base["process_date"], cfg)
        rejected = counts.pop("rejected")
        check()
        L.record_files(spark, cfg.control, base["batch_id"], [(p, None, None, e) for p, e in rejected], L.REJECTED)
        _told(cfg, "outcomes")
    except Overtaken:
        raise                       # the other run records the outcome
    except Exception as e:
        L.record_batch(spark, cfg.control, **base, status=L.FAILED, error_message=f"{type(e).__name__}: {e}")
        raise
    # The commit point: batch done and watermark moved in one append.
    row = L.record_batch(spark, cfg.control, **base, status=L.SUCCESS, rejected_files=len(rejected), **counts)
    _told(cfg, "finished")
    return row


def run_batch(spark: SparkSession, cfg: IngestConfig, cutoff: datetime | None = None) -> dict:
    """One incremental run (plan + process); returns the final ledger row, with ``files``. A
    batch that another run takes up meanwhile is left to it."""
    while True:
        try:
            return process_batch(spark, cfg, plan_batch(spark, cfg, cutoff))
        except Overtaken:
            continue


def run_until_drained(spark: SparkSession, cfg: IngestConfig, cutoff: datetime | None = None) -> list:
    """Bounded batches, each committed on its own, until the landing holds nothing new
    as of one cutoff; returns their final ledger rows."""
    cutoff, done = cutoff or run_cutoff(), []
    while not done or done[-1]["status"] != L.NO_FILES:
        done.append(run_batch(spark, cfg, cutoff))
    return done
