"""Plumbing shared by the text operators: column picking and Arrow batch maps.

Every operator reads only the id and text columns it was asked for, picked by
position, so extra columns (also ones that clash with output names, or differ
from another only by case) can never reach the result. A null text is read as
the empty text; invalid UTF-8 is repaired with U+FFFD before Python sees it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

Span = tuple[int, int, str]          # start, end (exclusive), kind


def pick(df: DataFrame, *names: str) -> DataFrame:
    """Just the named columns, found by exact name first and then ignoring case."""
    flat = df.toDF(*[f"_c{i}" for i in range(len(df.columns))])
    cols = []
    for name in names:
        hits = [i for i, c in enumerate(df.columns) if c == name] or \
               [i for i, c in enumerate(df.columns) if c.lower() == name.lower()]
        if not hits:
            raise ValueError(f"no column {name!r} in {df.columns}")
        cols.append(F.col(f"_c{hits[0]}").alias(name))
    return flat.select(*cols)


def id_and_text(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Columns ``doc_id`` (long) and ``text`` (valid UTF-8, null read as empty)."""
    d = pick(df, id_col, text_col).toDF("doc_id", "text")
    text = F.make_valid_utf8(F.coalesce(F.col("text").cast("string"), F.lit("")))
    return d.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))


#: Bytes of a batch that one step of Python works on.
SLICE_BYTES = 4 << 20


def small_batches(spark: SparkSession) -> None:
    """Limit the bytes of the session's Arrow batches to ``SLICE_BYTES``, unless the caller has set a
    limit: a partition of long texts would else be one batch, held several times over in the
    executor and its workers."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if name not in spark.conf.getAll:
        spark.conf.set(name, SLICE_BYTES)


def slices(batches: Iterable[pa.RecordBatch], most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of Arrow batches in pieces of about ``most`` bytes (one row at least)."""
    for b in batches:
        if not b.num_rows:
            continue
        step = max(1, b.num_rows * most // max(1, b.nbytes))
        for at in range(0, b.num_rows, step):
            yield b.slice(at, step)


def map_batches(df: DataFrame, ddl: str,
                work: Callable[..., Iterable[Sequence]]) -> DataFrame:
    """One narrow Arrow pass. ``work(*columns as lists)`` returns output columns."""
    schema = StructType.fromDDL(ddl)
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            out = work(*[c.to_pylist() for c in b.columns])
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, type=f.type) for c, f in zip(out, arrow, strict=True)], schema=arrow)

    return df.mapInArrow(run, schema)


def span_list(spans: Iterable[Span], order: dict[str, int]) -> str:
    """``kind:start:end`` by start, then kind in the listed order, comma-joined."""
    return ",".join(f"{k}:{s}:{e}" for s, e, k in
                    sorted(spans, key=lambda x: (x[0], order[x[2]], x[1])))


def sha256_hex(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8")).hexdigest()


class Cover:
    """Which characters of a text some span covers. Adding and asking cost the span's length."""

    def __init__(self, size: int, spans: Iterable[Sequence] = ()):
        self.size, self.mask = size, b""
        for x in spans:
            self.add(x[0], x[1])

    def add(self, s: int, e: int) -> None:
        if not self.mask:
            self.mask = bytearray(self.size)
        self.mask[s:e] = b"\x01" * (e - s)

    def hits(self, s: int, e: int) -> bool:
        """Whether s..e overlaps a span."""
        return bool(self.mask) and self.mask.find(b"\x01", s, e) >= 0
