"""Command line: the ingest job as one step or as two jobs, or as a stream.

    spark-submit --py-files millrace.zip millrace_job.py ingest --landing L --target T --control C
    python -m millrace plan    --landing L --target T --control C   # step one: find files
    python -m millrace process --landing L --target T --control C   # step two: load them
    python -m millrace drain   --landing L --target T --control C   # batches until nothing is left
    python -m millrace abandon --landing L --target T --control C --batch ID   # give a batch up
    python -m millrace stream  --landing L --target T --control C   # drain with a file stream

Prints the resulting ledger row as one JSON line.
"""

from __future__ import annotations

import argparse
import json
import sys

from .plans.ingest import IngestConfig, plan_batch, process_batch, run_batch, run_until_drained
from .session import build_session
from .sinks import abandon_batch


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="millrace")
    p.add_argument("command", choices=["ingest", "drain", "plan", "process", "stream", "abandon", "release"])
    p.add_argument("--landing", required=True)
    p.add_argument("--target", required=True)
    p.add_argument("--control", required=True)
    p.add_argument("--version", choices=["v1", "v2"], default="v2")
    p.add_argument("--glob", default=None, help="only names of this pattern (default: every file)")
    p.add_argument("--day-folders", default=None, help='e.g. "%%Y/%%m/%%d"')
    p.add_argument("--append", action="store_true",
                   help="plain append by process_date (default: replay-safe partitions)")
    p.add_argument("--format", default="parquet", choices=["parquet", "delta"])
    p.add_argument("--margin-days", type=int, default=IngestConfig.margin_days)
    p.add_argument("--full-listing-every", type=int, default=IngestConfig.full_listing_every)
    p.add_argument("--max-files", type=int, default=IngestConfig.max_files,
                   help="bound one batch to the oldest N files (the rest wait)")
    p.add_argument("--max-bytes", type=int, default=IngestConfig.max_bytes)
    p.add_argument("--rescue", action="store_true", help="keep raw values that do not convert, beside the table")
    p.add_argument("--batch", default=None, help="abandon, release: the batch to give up")
    p.add_argument("--master", default=None)
    return p


def main(argv=None) -> int:
    a = _parser().parse_args(argv)
    spark = build_session(a.master)
    cfg = IngestConfig(landing=a.landing, target=a.target, control=a.control, version=a.version,
                       glob=a.glob, day_folders=a.day_folders, replay_safe=not a.append,
                       fmt=a.format, max_files=a.max_files, max_bytes=a.max_bytes,
                       rescue=a.rescue, margin_days=a.margin_days, full_listing_every=a.full_listing_every)
    if a.command == "stream":
        from .streaming.ingest_stream import drain
        drain(spark, cfg)
        result = {"status": "DRAINED"}
    elif a.command in ("abandon", "release"):
        abandon_batch(spark, a.control, a.batch, release=a.command == "release")
        result = {"batch_id": a.batch, "status": "ABANDONED" if a.command == "abandon" else "RELEASED"}
    elif a.command == "drain":
        result = run_until_drained(spark, cfg)[-1]
    else:
        step = {"ingest": run_batch, "plan": plan_batch, "process": process_batch}[a.command]
        result = step(spark, cfg)
    print(json.dumps(result, default=str))
    return 0


if __name__ == "__main__":
    sys.exit(main())
