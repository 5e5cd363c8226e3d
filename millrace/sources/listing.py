"""A file listing as a data source: folders are listed in executors, hidden names included.

Spark's own file readers list in parallel but never show names that start with ``_``
or ``.``, and asking the file system for those from the driver walks every folder
there. This source gives one table of all files. The driver opens the first levels
of folders only, breadth first, until there are enough to share out; every folder
is then one partition, listed to its end by the executor that reads it.

Local paths are read with ``os.scandir``; ``s3``, ``s3a``, ``gs`` and ``hdfs`` with
``pyarrow.fs`` where the workers are set up for it. ``can_list`` says whether a path
can be listed so; callers fall back to Spark's listing where it cannot.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import datetime, timezone
from fnmatch import fnmatchcase

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = "path string, modificationTime timestamp, length bigint, hidden boolean"
#: Folders that the driver shares out; it opens a level more only while there are fewer.
ENOUGH = 256
LEVELS = 3
_REMOTE = {"s3": "s3", "s3a": "s3", "gs": "gs", "hdfs": "hdfs"}
# Names that writers leave beside data; never data themselves.
_MARKERS = re.compile(r"_SUCCESS|_temporary|_committed_.*|_started_.*|\..*\.crc|\.DS_Store")


def _scheme(path: str) -> tuple[str, str]:
    """(scheme, rest after the colon) of a path; plain paths are ``file``."""
    m = re.match(r"([A-Za-z][A-Za-z0-9+.-]*):(.*)", path, re.S)
    return (m.group(1), m.group(2)) if m else ("file", path)


class Folder:
    """One folder of a file system, opened where it is listed."""

    def __init__(self, path: str):
        self.path = path.rstrip("/") or "/"

    def entries(self) -> Iterator[tuple[str, bool, int, int]]:
        """(path, is folder, modification time in ms, length) of what lies directly in it."""
        scheme, rest = _scheme(self.path)
        if scheme == "file":
            local = "/" + rest.lstrip("/") if rest.startswith("/") else rest
            with os.scandir(local) as found:
                for e in found:
                    try:
                        st = e.stat()
                    except FileNotFoundError:       # gone meanwhile, or a dangling link
                        continue
                    yield f"{self.path}/{e.name}", e.is_dir(), st.st_mtime_ns // 1_000_000, st.st_size
            return
        from pyarrow import fs
        system, root = fs.FileSystem.from_uri(f"{_REMOTE[scheme]}:{rest}")
        for i in system.get_file_info(fs.FileSelector(root, allow_not_found=True)):
            yield (f"{self.path}/{i.base_name}", i.type == fs.FileType.Directory,
                   (i.mtime_ns or 0) // 1_000_000, i.size or 0)


def _hidden(names: list[str]) -> bool:
    """Whether Spark's readers skip a file for its name or a folder's."""
    return any(n[0] in "_." and not ("=" in n and n[0] == "_") for n in names)


@dataclass
class Share(InputPartition):
    """A folder to list to its end, or (``deep`` false) only its own files."""

    path: str
    deep: bool


class ListingReader(DataSourceReader):
    def __init__(self, options):
        self.root = options["path"].rstrip("/") or "/"
        self.glob = options.get("glob")

    def partitions(self) -> list[Share]:
        shares, level = [], [self.root]
        for _ in range(LEVELS):
            if not level or len(shares) + len(level) >= ENOUGH:
                break
            shares += [Share(p, False) for p in level]
            level = sorted(c for p in level for c, folder, _, _ in _entries(p) if folder)
        return shares + [Share(p, True) for p in level]

    def read(self, share: Share) -> Iterator[tuple]:
        todo, base = [share.path], len(self.root)
        while todo:
            for path, folder, at, size in _entries(todo.pop()):
                if folder:
                    if share.deep:
                        todo.append(path)
                    continue
                names = path[base:].strip("/").split("/")
                if any(_MARKERS.fullmatch(n) for n in names):
                    continue
                if self.glob and not fnmatchcase(names[-1], self.glob):
                    continue
                yield path, datetime.fromtimestamp(at / 1000, timezone.utc), size, _hidden(names)


def _entries(path: str) -> Iterator[tuple[str, bool, int, int]]:
    try:
        yield from Folder(path).entries()
    except (FileNotFoundError, NotADirectoryError):     # gone meanwhile
        return


class Listing(DataSource):
    """``spark.read.format("millrace_listing").load(folder)``."""

    @classmethod
    def name(cls) -> str:
        return "millrace_listing"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return ListingReader(self.options)


def can_list(spark: SparkSession, folder: str) -> bool:
    """Whether this source can list a folder: no glob in it, and a file system Python can open."""
    if any(ch in folder for ch in "*?[{"):
        return False
    scheme, _ = _scheme(folder)
    if scheme == "file":
        return True
    if scheme not in _REMOTE:
        return False
    try:
        next(iter(Folder(folder).entries()), None)
        return True
    except Exception:       # no credentials, no driver of that file system: Spark lists it
        return False


def list_everything(spark: SparkSession, folder: str, glob: str | None = None) -> DataFrame:
    """All files under a folder (``SCHEMA``), hidden ones flagged; a missing folder has none."""
    spark.dataSource.register(Listing)
    scheme, rest = _scheme(folder)
    full = "file:" + os.path.abspath("/" + rest.lstrip("/") if rest.startswith("/") else rest) \
        if scheme == "file" else folder
    reader = spark.read.format(Listing.name())
    if glob:
        reader = reader.option("glob", glob)
    return reader.load(full)
