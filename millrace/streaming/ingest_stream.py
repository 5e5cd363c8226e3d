"""Structured Streaming front end for the ingest job.

A file stream over the landing folder (``binaryFile`` with contents pruned)
delivers each new path exactly once, tracked in the query's checkpoint
instead of an mtime watermark. Each micro-batch runs the same
read-by-header / standardize / split / write step as the batch job, under a
batch id derived from the epoch, so a re-executed epoch (after a failure)
writes the same batch id again; with ``replay_safe`` it replaces its own
partitions.

A difference from the batch job, by design of the file source: a file rewritten
under the same path is not picked up again. Late files are: the age limit of
the source is set so that it drops none (see ``stream_files``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..plans.ingest import IngestConfig, finish
from ..sinks import ledger as L
from ..sources.manifest import stream_files


MAX_FILES_PER_TRIGGER = 10_000


def start_stream_ingest(spark: SparkSession, cfg: IngestConfig, checkpoint: str | None = None,
                        available_now: bool = True,
                        max_files_per_trigger: int | None = MAX_FILES_PER_TRIGGER,
                        processing_time: str | None = None) -> StreamingQuery:
    """Start the stream; ``available_now`` drains what is there and stops.

    Each micro-batch takes at most ``max_files_per_trigger`` files, so a
    backlog of millions of files becomes many bounded batches (bounded path
    lists on the driver), not one huge one."""
    checkpoint = checkpoint or cfg.control.rstrip("/") + "/stream_checkpoint"
    files = stream_files(spark, cfg.landing, cfg.glob, max_files_per_trigger)

    def per_batch(batch: DataFrame, epoch_id: int) -> None:
        rows = batch.select("path", "modificationTime", "length").collect()   # this epoch's files
        if not rows:
            return
        files_ = sorted((r["path"], L.as_utc(r["modificationTime"]), r["length"]) for r in rows)
        # Everything about the batch derives from its files, so a re-executed
        # epoch (same files) gets the same id, date and partitions.
        newest = max(m for _, m, _ in files_)
        base = dict(batch_id=f"stream_{epoch_id:010d}", process_date=f"{newest:%Y-%m-%d}",
                    watermark_ts=newest, n_files=len(files_))
        L.record_files(spark, cfg.control, base["batch_id"], [(*f, None) for f in files_], L.PLANNED)
        finish(spark, cfg, base, [p for p, _, _ in files_])

    w = files.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint)
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.start()


def drain(spark: SparkSession, cfg: IngestConfig, checkpoint: str | None = None) -> None:
    """Process every file available now, then return."""
    q = start_stream_ingest(spark, cfg, checkpoint, available_now=True)
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
