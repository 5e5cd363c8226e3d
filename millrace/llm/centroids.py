"""Centroid clustering sharded by dimension (operator 12).

Lloyd's rounds in exact integer arithmetic. Vectors are cut by columns: a shard
holds a block of components of every vector, as one small matrix per *chunk* of
``CHUNK`` vectors, in a table partitioned by block in the shared folder.

A round is two passes over the shards, each task seeing only its block:

1. *Distances.* A task computes the exact partial squared distances of its rows
   to its slice of every centroid. The partial matrices of a chunk are added
   over the blocks (a sum by key, one matrix a block), and the argmin gives each
   vector's cluster.
2. *Update.* The clusters of each chunk go back to its shards; every shard adds
   up its rows by cluster, sums meet by block, and the block's slice of each
   non-empty centroid becomes the floor of sum / count.

Only centroids travel whole (clusters x dimensions, fixed); no task sees a
column it does not own or a group larger than a chunk, and a cluster that holds
a third of all vectors is one sum a task. Each round's clusters are written to the
shared folder, so a lost executor costs one round at most.

Defined results: vectors of another size, or with null or non-finite components,
are not kept; null vectors neither. Repeated rows (equal ids too) are vectors of
their own; a null id is hashed as the empty string and comes back as null. Equal
hashes are ordered by their components. With fewer vectors than clusters every
vector starts a cluster; no vector gives no rows. Components beyond 2**27 after
scaling stop the job, as their distances do not fit the result's type.
"""

from __future__ import annotations

import hashlib
import os

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import fresh_dir
from ._batches import pick

DIMENSIONS = 64
SCALE = 256
CLUSTERS = 40
ROUNDS = 5
BLOCK = 16
CHUNK = 1024
LARGEST = 1 << 27
#: The pseudo block that holds the ids of a chunk.
IDS = -1


def kept_vectors(df: DataFrame, dimensions: int = DIMENSIONS, scale: int = SCALE) -> DataFrame:
    """vec_id, v array<long>: floor(scale * x) of the vectors that count."""
    d = pick(df, "vec_id", "embedding").toDF("vec_id", "e").select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("e").cast("array<double>").alias("e"))
    fine = F.forall("e", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    whole = F.transform("e", lambda x: F.floor(x * F.lit(float(scale))))
    small = F.forall("e", lambda x: F.abs(x * F.lit(float(scale))) < F.lit(float(LARGEST)))
    return d.filter(F.size("e") == dimensions).filter(fine).select("vec_id", F.when(small, whole).otherwise(
        F.raise_error(F.lit("a component is too large for exact distances"))).alias("v"))


def first_centroids(kept: DataFrame, clusters: int = CLUSTERS) -> np.ndarray:
    """The vectors with the smallest SHA-256 of ``2:<vec_id>``, one row each."""
    name = F.concat(F.lit("2:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    first = kept.select(F.sha2(name, 256).alias("h"), "v").orderBy("h", "v").limit(clusters).collect()
    return np.array([r["v"] for r in first], np.int64).reshape(len(first), len(first[0]["v"]) if first else 0)


def shards(kept: DataFrame, dimensions: int = DIMENSIONS, block: int = BLOCK) -> DataFrame:
    """Rows (chunk, block, data): a chunk's columns of one block as a matrix of 64-bit integers."""
    def run(batches):
        part, at = TaskContext.get().partitionId(), 0
        for b in batches:
            for a in range(0, b.num_rows, CHUNK):
                s = b.slice(a, CHUNK)
                m = s.column(1).flatten().to_numpy().reshape(s.num_rows, dimensions)
                rows = [(IDS, _pack_ids(s.column(0)))]
                rows += [(c // block, np.ascontiguousarray(m[:, c:c + block]).tobytes())
                         for c in range(0, dimensions, block)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part << 33 | at] * len(rows), pa.int64()), pa.array([r[0] for r in rows], pa.int32()),
                     pa.array([r[1] for r in rows], pa.binary())], names=["chunk", "block", "data"])
                at += 1
    return kept.mapInArrow(run, "chunk long, block int, data binary")


def _pack_ids(ids: pa.Array) -> bytes:
    """Ids and which of them are null."""
    null = ids.is_null().to_numpy(zero_copy_only=False)
    return np.packbits(null).tobytes() + ids.fill_null(0).to_numpy().astype("<i8").tobytes()


def _unpack_ids(data: bytes, n: int) -> pa.Array:
    head = (n + 7) // 8
    null = np.unpackbits(np.frombuffer(data, np.uint8, head), count=n).astype(bool)
    return pa.array(np.frombuffer(data, "<i8", n, head), mask=null)


def partial_distances(rows: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances over one block of columns: a row each vector, a column each centroid."""
    return np.stack([((rows - c) ** 2).sum(axis=1) for c in centroids], axis=1)


def assign(table: DataFrame, centroids: np.ndarray, block: int = BLOCK) -> DataFrame:
    """Rows (chunk, cluster, distance): the nearest centroid of every vector of a chunk (ties: the
    smaller number), as 32- and 64-bit integers."""
    k, dimensions = centroids.shape

    def partial(batches):
        for b in batches:
            out = []
            for j, data in zip(b.column(1).to_pylist(), b.column(2)):
                own = centroids[:, j * block:(j + 1) * block]
                rows = np.frombuffer(data.as_buffer(), np.int64).reshape(-1, own.shape[1])
                out.append(partial_distances(rows, own).tobytes())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.binary())], names=["chunk", "d"])

    def nearest(chunk: pa.Table) -> pa.Table:
        total = 0
        for d in chunk.column(1):
            total = total + np.frombuffer(d.as_buffer(), np.int64).reshape(-1, k)
        cluster = total.argmin(axis=1)
        far = np.ascontiguousarray(total[np.arange(len(total)), cluster])
        return pa.table({"chunk": chunk.column(0)[:1], "cluster": pa.array([cluster.astype(np.int32).tobytes()]),
                         "distance": pa.array([far.tobytes()])})

    return (table.filter(F.col("block") != IDS).mapInArrow(partial, "chunk long, d binary")
            .groupBy("chunk").applyInArrow(nearest, "chunk long, cluster binary, distance binary"))


def updated(table: DataFrame, clusters: DataFrame, centroids: np.ndarray, block: int = BLOCK) -> np.ndarray:
    """The centroids after one update, each block's slice from its own shards."""
    k, dimensions = centroids.shape

    def sums(batches):
        total: dict[int, np.ndarray] = {}
        count: dict[int, np.ndarray] = {}
        for b in batches:
            for j, data, own in zip(b.column(0).to_pylist(), b.column(1), b.column(2)):
                width = min(block, dimensions - j * block)
                rows = np.frombuffer(data.as_buffer(), np.int64).reshape(-1, width)
                label = np.frombuffer(own.as_buffer(), np.int32)
                order = np.argsort(label, kind="stable")
                n = np.bincount(label, minlength=k)
                some = np.flatnonzero(n)
                t = total.setdefault(j, np.zeros((k, width), np.int64))
                t[some] += np.add.reduceat(rows[order], (np.cumsum(n) - n)[some], axis=0)
                count[j] = count.get(j, 0) + n
        out = [(j, c, int(count[j][c]), t[c].tolist()) for j, t in total.items() for c in np.flatnonzero(count[j])]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in out], pa.int32()), pa.array([r[1] for r in out], pa.int32()),
             pa.array([r[2] for r in out], pa.int64()), pa.array([r[3] for r in out], pa.list_(pa.int64()))],
            names=["block", "cluster", "n", "sums"])

    parts = (table.filter(F.col("block") != IDS).join(clusters.select("chunk", "cluster"), "chunk")
             .select("block", "data", "cluster").mapInArrow(sums, "block int, cluster int, n long, sums array<long>"))
    width = min(block, dimensions)
    met = parts.groupBy("block", "cluster").agg(F.sum("n").alias("n"), *[
        F.sum(F.get("sums", F.lit(i))).alias(f"s{i}") for i in range(width)])
    out = centroids.copy()
    for r in met.collect():                         # one row a block and cluster
        own = slice(r["block"] * block, min((r["block"] + 1) * block, dimensions))
        out[r["cluster"], own] = [r[f"s{i}"] // r["n"] for i in range(own.stop - own.start)]
    return out


def cluster(spark: SparkSession, df: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS,
            dimensions: int = DIMENSIONS, scale: int = SCALE,
            block: int = BLOCK) -> tuple[DataFrame, np.ndarray]:
    """(rows vec_id, cluster, distance; centroids) after ``rounds`` rounds and a last assignment."""
    kept, root = kept_vectors(df, dimensions, scale), fresh_dir(spark, "centroids")
    centroids = first_centroids(kept, clusters)
    if not len(centroids):
        return spark.createDataFrame([], "vec_id long, cluster int, distance long"), centroids
    shards(kept, dimensions, block).write.partitionBy("block").parquet(f"{root}/shards")
    table = spark.read.schema("chunk long, data binary, block int").parquet(f"{root}/shards").select(
        "chunk", "block", "data")
    for i in range(rounds + 1):
        assign(table, centroids, block).write.parquet(f"{root}/round-{i}")
        found = spark.read.parquet(f"{root}/round-{i}")
        if i < rounds:
            centroids = updated(table, found, centroids, block)

    def rows(batches):
        for b in batches:
            for ids, own, far in zip(b.column(0), b.column(1), b.column(2)):
                label = np.frombuffer(own.as_buffer(), np.int32)
                yield pa.RecordBatch.from_arrays(
                    [_unpack_ids(ids.as_py(), len(label)), pa.array(label),
                     pa.array(np.frombuffer(far.as_buffer(), np.int64))], names=["vec_id", "cluster", "distance"])
    named = found.join(table.filter(F.col("block") == IDS).select("chunk", "data"), "chunk")
    return named.select("data", "cluster", "distance").mapInArrow(
        rows, "vec_id long, cluster int, distance long"), centroids


def cluster_report(spark: SparkSession, df: DataFrame, **how) -> DataFrame:
    """The digest of operator 12: each vector with its cluster's and the whole inertia and centroid hash."""
    found, centroids = cluster(spark, df, **how)
    path = os.path.join(fresh_dir(spark, "clusters"), "rows")
    found.write.parquet(path)
    found = spark.read.parquet(path)
    spread = {r["cluster"]: int(r["s"]) for r in found.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    # One row a cluster.
    about = spark.createDataFrame(
        [(c, s, sum(spread.values()), hashlib.sha256(",".join(map(str, centroids[c].tolist())).encode()).hexdigest())
         for c, s in spread.items()], "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(about), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _sql(clusters: int, rounds: int, dimensions: int, scale: int) -> str:
    """The same in SQL: one relation a component, a round two of them."""
    first = f"""WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, vec_id, [floor({scale} * x::DOUBLE)::BIGINT FOR x IN embedding] AS v
  FROM embeddings WHERE len(embedding) = {dimensions}
    AND len([x FOR x IN embedding IF x IS NOT NULL AND isfinite(x)]) = {dimensions}),
long AS MATERIALIZED (SELECT rid, unnest(range({dimensions})) AS d, unnest(v) AS x FROM kept),
first_rows AS (SELECT v, row_number() OVER (ORDER BY sha256('2:' || coalesce(vec_id::VARCHAR, '')), v) - 1 AS c
  FROM kept QUALIFY c < {clusters}),
c0 AS MATERIALIZED (SELECT c, unnest(range({dimensions})) AS d, unnest(v) AS x FROM first_rows)"""
    parts = [first]
    for i in range(rounds + 1):
        parts.append(f"""d{i} AS (SELECT l.rid, k.c, sum((l.x - k.x) * (l.x - k.x))::BIGINT AS dist
  FROM long l JOIN c{i} k USING (d) GROUP BY l.rid, k.c),
a{i} AS MATERIALIZED (SELECT rid, arg_min(c, (dist, c)) AS c, min(dist) AS dist FROM d{i} GROUP BY rid)""")
        if i < rounds:
            parts.append(f"""u{i} AS (SELECT a.c, l.d, sum(l.x)::BIGINT AS s, count(*) AS n
  FROM a{i} a JOIN long l USING (rid) GROUP BY a.c, l.d),
c{i + 1} AS MATERIALIZED (SELECT k.c, k.d, CASE WHEN u.n IS NULL THEN k.x
    ELSE (u.s - ((u.s % u.n) + u.n) % u.n) // u.n END AS x
  FROM c{i} k LEFT JOIN u{i} u ON k.c = u.c AND k.d = u.d)""")
    return ",\n".join(parts) + f"""
SELECT k.vec_id, a.c::INTEGER AS cluster, a.dist AS distance,
  (sum(a.dist) OVER (PARTITION BY a.c))::BIGINT AS cluster_inertia, (sum(a.dist) OVER ())::BIGINT AS inertia,
  h.sha AS centroid_sha256
FROM a{rounds} a JOIN kept k USING (rid)
JOIN (SELECT c, sha256(string_agg(x::VARCHAR, ',' ORDER BY d)) AS sha FROM c{rounds} GROUP BY c) h ON h.c = a.c"""


SQL = _sql(CLUSTERS, ROUNDS, DIMENSIONS, SCALE)
