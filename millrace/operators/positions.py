"""Positions in one global order, without a single-partition window.

``row_number() over (order by k)`` and ``lag(x) over (order by k)`` with no
partition move the whole input to one task. Here the rows are dealt by ranges
of the order once and sorted there; the number of rows of each range, summed up
over the ranges before it, turns a row's index inside its range into its global
position, and the last row of a range is carried over to the first of the next.
What meets in one place is one row a range.

The sorted rows are written to the shared folder: both the counts and the rows
are then read from the same ranges, also after an executor was lost. Ranges are
cut by the order and then by a hash of the whole row, so rows that tie (a third of
them, say) still spread over ranges; their order among each other is arbitrary but
fixed for one call.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructType

from ..functions._util import as_col
from ..session import fresh_dir

_INDEX_BITS = 33        # of monotonically_increasing_id


def _dealt(df: DataFrame, order: Sequence) -> DataFrame:
    keys = [as_col(c) for c in order]
    kinds = {f.name: f.dataType.typeName() for f in df.schema.fields}
    tie = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns if kinds[c] not in ("map", "variant")])
    return df.repartitionByRange(*keys, tie).sortWithinPartitions(*keys, tie)


def _stored(df: DataFrame) -> DataFrame:
    spark = df.sparkSession
    path = f"{fresh_dir(spark, 'positions')}/rows"
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _before(rows: DataFrame, part: str, index: str) -> dict[int, int]:
    """Rows in the ranges before each range (one entry a range)."""
    sizes = sorted((r["part"], r["n"]) for r in
                   rows.groupBy(F.col(part).alias("part")).agg((F.max(index) + 1).alias("n")).collect())
    return dict(zip([p for p, _ in sizes], accumulate([n for _, n in sizes], initial=0)))


def _with_position(rows: DataFrame, before: dict[int, int], name: str, first: int) -> DataFrame:
    table = rows.sparkSession.createDataFrame(sorted(before.items()) or [(0, 0)], "__p long, __before long")
    # One row a range.
    return (rows.join(F.broadcast(table), F.col("__part") == F.col("__p"))
            .withColumn(name, F.col("__before") + F.col("__index") + first).drop("__p", "__before"))


def global_row_number(df: DataFrame, order: Sequence[str | Column], name: str = "row_number") -> DataFrame:
    """``df`` with ``name``: 1, 2, 3, ... in the global ``order``. Runs the sort at once."""
    rows = _stored(_dealt(df, order).withColumn("__id", F.monotonically_increasing_id()))
    rows = rows.select("*", F.shiftright("__id", _INDEX_BITS).alias("__part"),
                       F.col("__id").bitwiseAND((1 << _INDEX_BITS) - 1).alias("__index"))
    return _with_position(rows, _before(rows, "__part", "__index"), name, 1).drop("__id", "__part", "__index")


def global_lag(df: DataFrame, order: Sequence[str | Column], values: dict[str, str], by: Sequence[str] = (),
               position: str | None = None) -> DataFrame:
    """``df`` with, for each ``values`` item (new name: column), the column's value in the previous
    row of the global ``order`` (NULL in the first row); with ``by``, in the previous row of the same
    series, the order then being (``by``, ``order``). ``position`` also appends the row number."""
    by = list(by)
    carried = list(dict.fromkeys([*values.values(), *by]))
    schema = StructType(list(df.schema.fields))
    for i, c in enumerate(carried):
        schema = schema.add(f"__prev{i}", df.schema[c].dataType, True)
    schema = schema.add("__part", IntegerType()).add("__index", LongType())
    at = [df.columns.index(c) for c in carried]

    def run(batches):
        part, index, last = TaskContext.get().partitionId(), 0, None
        for b in batches:
            n = b.num_rows
            if not n:
                continue
            before = [pa.concat_arrays([last[i] if last else pa.nulls(1, b.column(c).type), b.column(c)[:n - 1]])
                      for i, c in enumerate(at)]
            last = [b.column(c)[n - 1:] for c in at]
            yield pa.RecordBatch.from_arrays(
                [*b.columns, *before, pa.array([part] * n, pa.int32()), pa.array(range(index, index + n), pa.int64())],
                names=schema.names)
            index += n

    rows = _stored(_dealt(df, [*by, *order]).mapInArrow(run, schema))
    before = _before(rows, "__part", "__index")
    # The last row of each range, for the first row of the next (one row a range).
    ends = {p: n for p, n in zip(sorted(before), [before[p] for p in sorted(before)][1:])}
    parts = sorted(before)
    follow = rows.sparkSession.createDataFrame(
        [(p, q, ends[p] - before[p] - 1) for p, q in zip(parts, parts[1:])] or [(-1, -1, -1)],
        "__from int, __to int, __end long")
    carry = rows.join(F.broadcast(follow), (F.col("__part") == F.col("__from")) & (F.col("__index") == F.col("__end"))).select(
        "__to", *[F.col(f"`{c}`").alias(f"__carry{i}") for i, c in enumerate(carried)])
    out = rows.join(F.broadcast(carry), (F.col("__part") == F.col("__to")) & (F.col("__index") == 0), "left")
    if position:
        out = _with_position(out, before, position, 1)
    prev = {c: F.when(F.col("__index") == 0, F.col(f"__carry{i}")).otherwise(F.col(f"__prev{i}"))
            for i, c in enumerate(carried)}
    same = F.lit(True)
    for c in by:
        same = same & prev[c].eqNullSafe(F.col(f"`{c}`"))
    same = same & F.when(F.col("__index") == 0, F.col("__to").isNotNull()).otherwise(F.lit(True))
    return out.select(*[F.col(f"`{c}`") for c in df.columns], *([position] if position else []),
                      *[F.when(same, prev[c]).alias(new) for new, c in values.items()])
