"""File manifests: which files exist under a landing folder, and when they landed.

The listing is Spark's own (``binaryFile`` source, parallel listing, any
Hadoop file system, no 1,000-key page limit). Only ``path``,
``modificationTime`` and ``length`` are selected, so file contents are never
read (the scan's ReadSchema has no ``content``). Spark's readers cannot see
names starting with ``_`` or ``.``; ``hidden_files`` names those, so that a run
can record what it had to leave.
"""

from __future__ import annotations

import re
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.errors import AnalysisException

from .tables import path_exists

MANIFEST_SCHEMA = "path string, modificationTime timestamp, length bigint"
BINARY_FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def list_files(spark: SparkSession, folder: str, glob: str | None = None,
               recursive: bool = True) -> DataFrame:
    """Manifest ``(path, modificationTime, length)`` of the files under ``folder``.

    A folder that does not exist gives an empty manifest, not an error.
    """
    if not any(ch in folder for ch in "*?[{") and path_exists(folder) is False:
        return spark.createDataFrame([], MANIFEST_SCHEMA)
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    try:
        return reader.load(folder).select("path", "modificationTime", "length")
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
            return spark.createDataFrame([], MANIFEST_SCHEMA)
        raise


# Names that writers leave beside data; never data themselves.
_MARKERS = re.compile(r"_SUCCESS|_temporary|_committed_.*|_started_.*|\..*\.crc|\.DS_Store")


def hidden_files(spark: SparkSession, folder: str) -> list:
    """``(path, modificationTime, length)`` of files that Spark's readers skip for their
    name (their own or a folder's), but for the markers of writers. Walks the file
    system's listing entry by entry and keeps only such files."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(folder)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found, base = [], len(str(fs.makeQualified(root).toString()))
    walk = [root] if fs.exists(root) else []
    while walk:
        for s in fs.listStatus(walk.pop()):
            if s.isDirectory():
                walk.append(s.getPath())
                continue
            path = s.getPath().toString()
            names = path[base:].strip("/").split("/")
            odd = [n for n in names if n[0] in "_." and not ("=" in n and n[0] == "_")]
            if odd and not any(_MARKERS.fullmatch(n) for n in names):
                found.append((path, datetime.fromtimestamp(s.getModificationTime() / 1000, timezone.utc), s.getLen()))
    return sorted(found)


#: Age, against the newest file seen, from which a file stream drops late files. Spark's
#: own default is seven days; this one drops nothing.
MAX_FILE_AGE = "36500d"


def stream_files(spark: SparkSession, folder: str, glob: str | None = None,
                 max_files_per_trigger: int | None = None, recursive: bool = True,
                 max_file_age: str = MAX_FILE_AGE) -> DataFrame:
    """Streaming manifest: each new file under ``folder`` arrives once, tracked by
    the query's checkpoint. Contents are not read (pruned). A shorter
    ``max_file_age`` bounds what the checkpoint remembers, at the price of
    ignoring files older than that against the newest one."""
    reader = (spark.readStream.format("binaryFile").schema(BINARY_FILE_SCHEMA)
              .option("recursiveFileLookup", str(recursive).lower()).option("maxFileAge", max_file_age))
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(folder).select("path", "modificationTime", "length")
