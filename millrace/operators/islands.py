"""Gaps and islands over an integer sequence, without a single-partition window.

An island is a maximal run of consecutive integers of ``seq`` (per group
``by``); duplicates count once (1,2,2,3 is one island 1..3).

The textbook form ranks the whole group in one window. For a global sequence
that is one task for the whole table, and for a hot group one task for a third
of it. Here keys are de-duplicated (partially, before the shuffle) and numbered
in one global order of (group, value) by prefix sums over ranges (see
``positions``): inside a group ``seq - row_number`` is the same along an island
and larger behind every gap, so islands are one partially aggregated grouping.

With a ``width`` (for sequences in a known, dense domain, such as day numbers)
nothing is sorted globally: the sequence is cut into buckets ``floor(seq / width)``;
``seq - row_number()`` inside each (group, bucket) labels run pieces; pieces touching
a bucket limit (at most two a bucket) are chained across buckets.

Rows whose sequence is NULL belong to no island or run and are left out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.values import integral_bucket
from .positions import global_row_number

def _keys(df: DataFrame, seq: str, by: list) -> DataFrame:
    """Distinct ``(by, __v)``: islands depend only on distinct values, and ``distinct``
    aggregates partially before its shuffle, so a value repeated in a third of the
    rows leaves each map task as one row."""
    return df.where(F.col(seq).isNotNull()).select(*by, F.col(seq).cast("bigint").alias("__v")).distinct()


def _numbered(df: DataFrame, seq: str, by: list) -> DataFrame:
    """Keys with the label ``__g`` of their island inside the group."""
    keys = global_row_number(_keys(df, seq, by), [*by, "__v"], "__rn")
    return keys.withColumn("__g", F.col("__v") - F.col("__rn")).drop("__rn")


def _labelled(df: DataFrame, seq: str, by: list, width: int) -> DataFrame:
    """Keys with bucket ``__b``, its limits ``__from <= __v < __to``, and in-bucket piece label
    ``__g``. Every ranking window sees one bucket's keys."""
    w = Window.partitionBy(*by, "__b").orderBy("__v")
    return (_keys(df, seq, by).withColumn("__b", integral_bucket("__v", width))
            .withColumn("__from", F.col("__b") * F.lit(width).cast("bigint"))
            .withColumn("__to", F.col("__from") + F.lit(width).cast("bigint"))
            .withColumn("__g", F.col("__v") - F.row_number().over(w)))


def _is_edge(lo, hi):
    """Whether a piece reaches a limit of its bucket."""
    return (F.coalesce(lo == F.col("__from"), F.lit(False))
            | F.coalesce(hi + 1 == F.col("__to"), F.lit(False)))


def _chain(edges: DataFrame, by: list) -> DataFrame:
    """Give edge pieces (columns by, lo, hi, ...) a ``__chain`` id; pieces in
    one chain form one island. Partitioned by group; ordered by ``lo``."""
    w = Window.partitionBy(*by).orderBy("lo")
    starts = F.coalesce(F.lag("hi").over(w) + 1 != F.col("lo"), F.lit(True))
    return (edges.withColumn("__new", starts.cast("int"))
                 .withColumn("__chain", F.sum("__new").over(
                     w.rowsBetween(Window.unboundedPreceding, Window.currentRow))))


def islands(df: DataFrame, seq: str, by=(), width: int | None = None,
            start: str = "min_sequence", end: str = "max_sequence") -> DataFrame:
    """One row per island: ``by..., start, end`` (bigint)."""
    by = [by] if isinstance(by, str) else list(by)
    if width is None:
        return (_numbered(df.select(*by, seq), seq, by).groupBy(*by, "__g")
                .agg(F.min("__v").alias(start), F.max("__v").alias(end)).drop("__g"))
    pieces = (_labelled(df.select(*by, seq), seq, by, width)
              .groupBy(*by, "__b", "__g", "__from", "__to")
              .agg(F.min("__v").alias("lo"), F.max("__v").alias("hi")))
    edge = _is_edge(F.col("lo"), F.col("hi"))
    whole = pieces.where(~edge).select(*by, "lo", "hi")
    merged = (_chain(pieces.where(edge), by)
              .groupBy(*by, "__chain")
              .agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
              .select(*by, "lo", "hi"))
    return (whole.unionByName(merged)
                 .select(*by, F.col("lo").alias(start), F.col("hi").alias(end)))


def runs(df: DataFrame, seq: str, by=(), min_length: int = 1, width: int | None = None,
         start: str = "run_start", length: str = "run_length") -> DataFrame:
    """Input rows whose island has at least ``min_length`` distinct values,
    with the island's first value and length appended.

    Run boundaries are found on the distinct keys (as in ``islands``), then
    joined back to the rows on (group, value): broadcast when the qualifying
    keys are few, otherwise a shuffled join whose hot keys AQE splits."""
    by = [by] if isinstance(by, str) else list(by)
    pkeys = [(c, f"__pk{i}") for i, c in enumerate(by)]
    renamed = [F.col(c).alias(a) for c, a in pkeys]
    # NULL group keys form a group too: null-safe equality on them.
    same_group = [F.col(c).eqNullSafe(F.col(a)) for c, a in pkeys]
    info = (_numbered_info(df, seq, by, renamed, same_group, min_length) if width is None
            else _bucketed_info(df, seq, by, renamed, same_group, min_length, width))
    back = [*same_group, F.col(seq).cast("bigint") == F.col("__v")]
    return (df.join(info, on=back, how="inner")
              .withColumn(start, F.col("__start")).withColumn(length, F.col("__len"))
              .drop(*[a for _, a in pkeys], "__v", "__start", "__len"))


def _numbered_info(df, seq, by, renamed, same_group, min_length) -> DataFrame:
    """Keys of long enough islands with the island's first value and length."""
    x = _numbered(df.select(*by, seq), seq, by)
    long = (x.groupBy(*by, "__g").agg(F.min("__v").alias("__start"), F.max("__v").alias("__hi"))
            .withColumn("__len", F.col("__hi") - F.col("__start") + 1).where(F.col("__len") >= min_length)
            .select(*renamed, F.col("__g").alias("__pg"), "__start", "__len"))
    return (x.join(long, [*same_group, F.col("__g") == F.col("__pg")])
            .drop(*by).select(*[f"__pk{i}" for i in range(len(by))], "__v", "__start", "__len"))


def _bucketed_info(df, seq, by, renamed, same_group, min_length, width) -> DataFrame:
    """The same from bucketed pieces."""
    x = _labelled(df, seq, by, width)
    wp = Window.partitionBy(*by, "__b", "__g")
    x = x.withColumn("__lo", F.min("__v").over(wp)).withColumn("__hi", F.max("__v").over(wp))
    edge = _is_edge(F.col("__lo"), F.col("__hi"))
    # Edge pieces (<= 2 per bucket) and the island each belongs to.
    edge_pieces = (x.where(edge)
                    .groupBy(*by, "__b", "__g")
                    .agg(F.min("__lo").alias("lo"), F.max("__hi").alias("hi")))
    chained = _chain(edge_pieces, by)
    wc = Window.partitionBy(*by, "__chain")
    piece_map = chained.select(*renamed, F.col("__b").alias("__pb"), F.col("__g").alias("__pg"),
                               F.min("lo").over(wc).alias("__rlo"),
                               F.max("hi").over(wc).alias("__rhi"))
    cond = [*same_group, F.col("__b") == F.col("__pb"), F.col("__g") == F.col("__pg")]
    return (x.join(piece_map, on=cond, how="left")
             .withColumn("__start", F.coalesce("__rlo", "__lo"))
             .withColumn("__len", F.coalesce("__rhi", "__hi") - F.col("__start") + 1)
             .where(F.col("__len") >= min_length)
             .select(*renamed, "__v", "__start", "__len"))
