"""Choosing the files of one incremental batch from a file manifest.

A manifest is a DataFrame ``(path, modificationTime, length)``. The batch is
every file with ``low < modificationTime <= cutoff``: exclusive low bound (the
previous run's cutoff), inclusive high bound (this run's cutoff, captured
before listing so files landing mid-run wait for the next run). Bounds are
instants, never strings.
"""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Watermark of a first run: the epoch.
EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)


def _ts(v) -> Column:
    if isinstance(v, Column):
        return v
    if isinstance(v, str):
        v = datetime.fromisoformat(v.replace("Z", "+00:00"))
    if v.tzinfo is None:
        v = v.replace(tzinfo=timezone.utc)
    return F.lit(v.astimezone(timezone.utc)).cast("timestamp")


def in_window(ts, low, cutoff) -> Column:
    """``low < ts <= cutoff``; a missing (None or NULL) ``low`` means the epoch."""
    t = F.col(ts) if isinstance(ts, str) else ts
    lo = F.coalesce(_ts(low), _ts(EPOCH)) if low is not None else _ts(EPOCH)
    return (t > lo) & (t <= _ts(cutoff))


def select_new_files(manifest: DataFrame, low, cutoff, ts: str = "modificationTime") -> DataFrame:
    """Manifest rows inside the ``(low, cutoff]`` window."""
    return manifest.where(in_window(ts, low, cutoff))


def run_cutoff(now: datetime | None = None) -> datetime:
    """This run's cutoff: the last *completed* second before ``now`` (UTC).

    Stores stamp whole seconds; a file landing later in the current second
    would get a stamp equal to a cutoff taken now and be skipped forever, so
    the current second is left to the next run."""
    now = (now or datetime.now(timezone.utc)).astimezone(timezone.utc)
    return now.replace(microsecond=0) - timedelta(seconds=1)


def batch_identity(cutoff: datetime) -> tuple[str, str]:
    """``(batch_id, process_date)`` minted from the cutoff (UTC):
    ``batch_%Y%m%d_%H%M%S``, with ``_%f`` appended when the cutoff is not a whole
    second (a cutoff lowered to a file's mtime), so ids never collide."""
    c = cutoff.astimezone(timezone.utc)
    suffix = f"_{c:%f}" if c.microsecond else ""
    return f"batch_{c:%Y%m%d_%H%M%S}{suffix}", f"{c:%Y-%m-%d}"


def day_folders_glob(landing: str, day_format: str, low: datetime | None, cutoff: datetime,
                     margin_days: int = 1) -> str:
    """A glob over the day folders that can hold files of the ``(low, cutoff]``
    window, for landings laid out by arrival day (e.g. ``%Y/%m/%d``).

    Listing then touches only those folders instead of the whole, ever-growing
    landing. ``margin_days`` extra days before ``low`` cover producers whose
    clock or folder choice lags the store's mtime. A first run (no ``low``)
    lists the whole landing."""
    if low is None:
        return landing
    lo = (low.astimezone(timezone.utc) - timedelta(days=margin_days)).date()
    hi = cutoff.astimezone(timezone.utc).date()
    days, d = [], lo
    while d <= hi:
        days.append(d.strftime(day_format))
        d += timedelta(days=1)
    return f"{landing.rstrip('/')}/{{{','.join(days)}}}"
