"""CSV batches whose files may carry different headers.

``spark.read.csv(paths, header=True)`` takes the column names from one file
and applies them to every file *by position*: a file with another column order
or other names silently lands in the wrong columns. Here each file's first
line is read first (a distributed read of the first bytes of each file), files are
grouped by identical header, each group is read with its own header and
conformed on its own, and the groups are unioned by name.
"""

from __future__ import annotations

import csv
import os
import re
import sys
from collections.abc import Callable
from functools import reduce

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

# The header sniff runs Python in the executors; ship this module's functions
# by value so executors need no installed copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

CSV_OPTIONS = {"header": "true", "mode": "PERMISSIVE"}


HEAD_CHUNK = 64 * 1024          # bytes read per step while looking for the first line
FILES_PER_TASK = 64
GONE = "file not found"
HEADS = "path string, header string, error string"


def canonical(path: str) -> str:
    """One spelling of a path everywhere: as the file system names it, with its
    scheme (``file:`` for a bare local path) and without percent-encoding."""
    return path if re.match(r"[A-Za-z][A-Za-z0-9+.-]*:", path) else "file:" + os.path.abspath(path)


def file_of_row():
    """The canonical path of the file a scanned row came from. Spark's metadata column
    holds it percent-encoded (a plus sign is itself there)."""
    return F.regexp_replace(F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))),
                            "^file:/+", "file:/")


def _literal(path: str) -> str:
    """A path for Spark's readers, which treat paths as patterns: escape those characters."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)


def _first_line(path: str) -> str | None:
    """First non-empty line of a file, reading only as far as its end. Compressed
    files (``.gz``, ``.bz2``, ...) are decompressed by extension, as Spark's CSV
    reader does. ``None`` for a file without such a line; raises if the file is
    gone or its file system is not reachable from Python."""
    from pyarrow import fs
    scheme, host, inner = re.fullmatch(r"([^:/]+):(//[^/]*)?(/.*)", canonical(path), re.S).groups()
    if scheme == "file":
        filesystem = fs.LocalFileSystem()
    else:
        filesystem, base = fs.FileSystem.from_uri(f"{scheme.replace('s3a', 's3').replace('s3n', 's3')}:{host or '//'}/")
        inner = base.rstrip("/") + inner
    ready, rest = b"", b""
    with filesystem.open_input_stream(inner) as f:
        while not ready:
            chunk = f.read(HEAD_CHUNK)
            if not chunk:
                ready = rest
                break
            *lines, rest = (rest + chunk).split(b"\n")
            ready = next((x for x in lines if x.strip(b" \t\r\xef\xbb\xbf")), b"")
    line = ready.rstrip(b"\r").decode("utf-8-sig", errors="replace")
    return line if line.strip() else None


def _head_batches(batches):
    import pandas as pd
    for pdf in batches:
        heads, errors = [], []
        for p in pdf["path"]:
            header, error = None, None
            try:
                header = _first_line(p)
            except FileNotFoundError:
                error = GONE
            except Exception as e:   # a scheme or credentials only Hadoop has: asked of Spark next
                error = f"{type(e).__name__}: {e}"
            heads.append(header)
            errors.append(error)
        yield pd.DataFrame({"path": pdf["path"], "header": heads, "error": errors})


def _headers_by_spark(spark: SparkSession, paths: list) -> dict:
    """Headers through Spark's text source, from the rows that start in a file's first block."""
    lines = (spark.read.text([_literal(p) for p in paths])
             .select("value", file_of_row().alias("path"), F.col("_metadata.file_block_start").alias("at"))
             .where((F.col("at") == 0) & (F.trim(F.regexp_replace("value", "^\ufeff", "")) != ""))
             .withColumn("row_id", F.monotonically_increasing_id()))
    rows = lines.groupBy("path").agg(F.min_by("value", "row_id").alias("header")).collect()
    return {r["path"]: r["header"].lstrip("\ufeff").rstrip("\r") for r in rows}


def sniff_files(spark: SparkSession, paths: list) -> list:
    """``(path, header, error)`` of each file of one batch, read in executors,
    ``FILES_PER_TASK`` files a task, whatever the size of the batch; of each
    file only as much as its header needs. A file on a file system Python
    cannot open is asked of Spark. Files without a header line have neither; a
    file that is gone has the error ``GONE``; any other failure raises."""
    if not paths:
        return []
    n = -(-len(paths) // FILES_PER_TASK)
    listing = spark.createDataFrame([(canonical(p),) for p in paths], "path string").repartition(n)
    rows = [tuple(r) for r in listing.mapInPandas(_head_batches, HEADS).collect()]
    hidden = [p for p, _, e in rows if e not in (None, GONE)]
    if hidden:
        by_spark = _headers_by_spark(spark, hidden)
        rows = [(p, by_spark.get(p), None) if e not in (None, GONE) else (p, h, e) for p, h, e in rows]
    return sorted(rows)


def sniff_headers(spark: SparkSession, paths: list) -> dict:
    """``{path: first non-empty line}``; files without one, or gone, are left out."""
    asked = {canonical(p): p for p in paths}
    return {asked[p]: h for p, h, _ in sniff_files(spark, paths) if h is not None}


def group_by_header(spark: SparkSession, paths: list) -> dict:
    """``{header line: [file paths]}`` for the files of one batch."""
    groups: dict = {}
    for path, header in sniff_headers(spark, paths).items():
        groups.setdefault(header, []).append(path)
    return {h: sorted(ps) for h, ps in sorted(groups.items())}


def header_schema(header: str, options: dict) -> StructType | None:
    """All-string schema named by a sniffed header line, so Spark does not run
    a job to infer it again. ``None`` (let Spark infer) for anything unusual:
    non-default parsing options, empty or duplicate (case-insensitive) names."""
    if set(options) - {"header", "mode", "sep", "delimiter", "quote", "escape"}:
        return None
    sep = options.get("sep", options.get("delimiter", ","))
    if len(sep) != 1:
        return None
    names = next(csv.reader([header], delimiter=sep, quotechar=options.get("quote", '"'),
                            escapechar=options.get("escape", "\\")), [])
    lowered = [n.lower() for n in names]
    if not names or any(n == "" for n in names) or len(set(lowered)) != len(lowered):
        return None
    return StructType([StructField(n, StringType(), True) for n in names])


def read_csv_batch(spark: SparkSession, paths: list,
                   per_header: Callable[[DataFrame], DataFrame] | None = None,
                   options: dict | None = None, file_column: str | None = None,
                   rejected: list | None = None, corrupt_column: str | None = None) -> DataFrame | None:
    """Read CSV files (all columns as strings) with each file's own header.

    ``per_header`` (e.g. a conform step) runs on each header group before the
    union, so name mapping happens per header, not per batch. ``file_column``
    adds each row's source file (from the scan's file metadata). Returns
    ``None`` when there is nothing to read (no files, or only empty files).

    ``corrupt_column`` adds the whole line of rows whose number of fields is not the header's
    (NULL for others); without it surplus fields are lost and missing ones NULL.

    With a list for ``rejected``, a file that is gone or whose header cannot be
    mapped is added to it as ``(path, error)`` and left out; without one it
    raises. One scan branch is planned for each distinct header of the batch.
    """
    opts = {**CSV_OPTIONS, **(options or {})}
    groups: dict = {}
    for path, header, error in sniff_files(spark, paths):
        if error is not None:
            if rejected is None:
                raise FileNotFoundError(path)
            rejected.append((path, error))
        elif header is not None:
            groups.setdefault(header, []).append(path)
    parts = []
    for header, group in sorted(groups.items()):
        reader = spark.read.options(**opts)
        schema = header_schema(header, opts)
        if schema is not None:          # the header line is skipped, names are ours
            if corrupt_column:
                schema = StructType([*schema.fields, StructField(corrupt_column, StringType(), True)])
                # With columns pruned, the parser would not count a line's fields.
                reader = reader.option("columnNameOfCorruptRecord", corrupt_column).option("columnPruning", "false")
            reader = reader.schema(schema)
        try:
            df = reader.csv([_literal(p) for p in group])
            if corrupt_column and schema is None:
                df = df.withColumn(corrupt_column, F.lit(None).cast("string"))
            if file_column:
                df = df.withColumn(file_column, file_of_row())
            parts.append(per_header(df) if per_header else df)
        except ValueError as e:         # names that cannot be mapped
            if rejected is None:
                raise
            rejected += [(p, f"{type(e).__name__}: {e}") for p in group]
    if not parts:
        return None
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
