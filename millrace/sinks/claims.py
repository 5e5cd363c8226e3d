"""Exclusively created control objects: batch claims and batch leases.

Two kinds of small JSON objects stand beside the ledger. Each is created once,
whole, and by one run only; none is ever changed.

``claims/<n>`` are numbered 1, 2, 3, ... and are the commit point of planning. A
run that wants to take files reads the claims, chooses files that no claimed
batch has, writes them to ``files`` under an attempt of its own, and creates the
next number. If another run was faster, that creation fails, and the run plans
again with the other's files known. Rows of ``files`` whose attempt no claim names
belong to nobody: they are what a crashed or beaten run left, and their files are
free. So two runs never hold the same file, and no crash loses one.

``leases/<batch>-<k>`` say which run may load a batch. A run creates the next ``k``
if there is none, or the last one has ended, or was its own, or the batch has
failed. Before the commit it checks that no later lease was given; with
replay-safe tables a run that was overtaken only rewrote what the other writes.

Creation is exclusive by the file system: a hard link to a finished file (local), a
rename that fails where the target exists (HDFS and alike), or a conditional put
that shows the object when it is whole (object stores).
"""

from __future__ import annotations

import json
import uuid
from datetime import datetime, timedelta, timezone

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

#: File systems whose create(overwrite=false) shows an object only when it is whole, and once.
PUT_ONCE = ("s3a", "s3", "gs", "abfs", "abfss")

CLAIM_SCHEMA = ("batch_id string, attempt string, process_date date, low_watermark timestamp, "
                "watermark_ts timestamp, n_files bigint, hidden_files bigint, full_listing boolean, "
                "event_time timestamp")


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _exists_already(e: Py4JJavaError) -> bool:
    return "AlreadyExists" in e.java_exception.getClass().getName()


def create_exclusive(spark: SparkSession, path: str, text: str) -> bool:
    """Create ``path`` with ``text``, whole and only if it does not exist; whether it did."""
    jvm, target, fs = _fs(spark, path)
    scheme = fs.getUri().getScheme()
    fs.mkdirs(target.getParent())

    def write(p):
        out = fs.create(p, False)
        out.write(text.encode("utf-8"))
        out.close()

    if scheme in PUT_ONCE:
        try:
            write(target)
            return True
        except Py4JJavaError as e:
            if _exists_already(e) or fs.exists(target):
                return False
            raise
    whole = jvm.org.apache.hadoop.fs.Path(target.getParent(), f".new-{uuid.uuid4().hex}")
    write(whole)
    try:
        if scheme != "file":
            return bool(fs.rename(whole, target))
        at = [jvm.java.io.File(p.toUri().getPath()).toPath() for p in (target, whole)]
        jvm.java.nio.file.Files.createLink(*at)
        return True
    except Py4JJavaError as e:
        if _exists_already(e):
            return False
        raise
    finally:
        fs.delete(whole, False)


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names of the objects of a control folder."""
    _, p, fs = _fs(spark, folder)
    if not fs.exists(p):
        return []
    return sorted(n for s in fs.listStatus(p) if (n := s.getPath().getName())[0] not in "._")


def _text(spark: SparkSession, path: str) -> str:
    jvm, p, fs = _fs(spark, path)
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode("utf-8")
    finally:
        stream.close()


# -- claims ---------------------------------------------------------------------------------------

def claims_path(control: str) -> str:
    return control.rstrip("/") + "/claims"


def next_claim(spark: SparkSession, control: str) -> int:
    """The number the next claim would have. Read it before reading the claims themselves."""
    found = names(spark, claims_path(control))
    return int(found[-1]) + 1 if found else 1


def claim(spark: SparkSession, control: str, number: int, **fields) -> bool:
    """Claim a batch under ``number``; false if another run has that number."""
    return create_exclusive(spark, f"{claims_path(control)}/{number:012d}",
                            json.dumps(fields, default=lambda v: v.isoformat()))


def claim_rows(spark: SparkSession, control: str) -> DataFrame:
    """Every claim (empty before the first)."""
    from ..sources.tables import path_exists
    path = claims_path(control)
    if path_exists(path) is False or not names(spark, path):
        return spark.createDataFrame([], CLAIM_SCHEMA)
    return spark.read.schema(CLAIM_SCHEMA).json(path)


# -- leases ---------------------------------------------------------------------------------------

def _leases(spark: SparkSession, control: str, batch_id: str) -> list[int]:
    folder = f"{control.rstrip('/')}/leases/{batch_id}"
    return sorted(int(n) for n in names(spark, folder))


def _held_by_other(spark: SparkSession, control: str, batch_id: str, given: list[int], owner: str) -> bool:
    if not given:
        return False
    last = json.loads(_text(spark, f"{control.rstrip('/')}/leases/{batch_id}/{given[-1]:06d}"))
    return last["owner"] != owner and datetime.fromisoformat(last["until"]) > datetime.now(timezone.utc)


def held_by_other(spark: SparkSession, control: str, batch_id: str, owner: str) -> bool:
    """Whether another run's lease on a batch has not ended."""
    return _held_by_other(spark, control, batch_id, _leases(spark, control, batch_id), owner)


def lease(spark: SparkSession, control: str, batch_id: str, owner: str, seconds: int,
          failed: bool = False) -> int | None:
    """The number of this run's lease on a batch, or ``None`` while another run holds it."""
    given = _leases(spark, control, batch_id)
    if not failed and _held_by_other(spark, control, batch_id, given, owner):
        return None
    k = given[-1] + 1 if given else 1
    until = datetime.now(timezone.utc) + timedelta(seconds=seconds)
    text = json.dumps({"owner": owner, "until": until.isoformat()})
    path = f"{control.rstrip('/')}/leases/{batch_id}/{k:06d}"
    return k if create_exclusive(spark, path, text) else None


def holds(spark: SparkSession, control: str, batch_id: str, number: int) -> bool:
    """Whether no later lease on the batch was given."""
    return _leases(spark, control, batch_id)[-1:] == [number]
