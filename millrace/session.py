"""Session construction and the shared work folder.

Everything in the library takes a ``SparkSession`` from the caller. These
helpers only build one for tests/benchmarks and locate the shared folder that
derived tables and streaming checkpoints are written to.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every session we build gets. AQE re-plans joins/shuffles at runtime
# (broadcast only when the measured side is under the threshold, coalescing,
# skew-join splitting), and the session zone is pinned so instants parse and
# print the same on every machine.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app: str = "millrace",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the library defaults."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_root(spark: SparkSession) -> str:
    """The cluster-wide folder for derived tables: ``spark.checkpoint.dir``.

    It is read from the session. Only a local-mode session without the setting
    (a test) gets a fresh temporary folder; a cluster session without it is an
    error, because a machine-local folder is invisible to other executors.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        master = spark.sparkContext.master or ""
        if not master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder")
        root = tempfile.mkdtemp(prefix="millrace-")
        spark.conf.set("spark.checkpoint.dir", root)
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A new, unique sub-folder of the shared root (never reused, never wiped)."""
    path = f"{shared_root(spark)}/millrace/{label}-{uuid.uuid4().hex[:12]}"
    if path.startswith("/") or path.startswith("file:"):
        os.makedirs(path.replace("file:", "", 1), exist_ok=True)
    return path
