"""N-gram Jaccard join by T-occurrence search (operator 3).

A document's set holds its distinct five-word shingles as 64-bit hashes; two
documents link when the sets' Jaccard similarity is 0.8 or more. Nothing is
sampled, capped or estimated: every link between different sets that could
change a component is found (up to a 64-bit hash collision).

1. *Nodes.* One pass reads every text, hashes its set, and names the set by a
   64-bit fingerprint. Exact copies share a node from here on. The pass also
   counts shingles inside each batch; those of at least ``HOT`` of the sets are
   a small table (at most average set size / HOT entries).
2. *Signatures.* Similar sets differ in at most (|A| + |B|) / 9 shingles. A
   second pass cuts the hash range into more segments than that, by size band,
   so that linked sets agree on at least one whole non-empty segment, whose hash
   is the signature. Shared passages do not make whole segments equal; segments
   leave out hot shingles first, and use all shingles where the rest is too
   little (then both sets of a pair do). Signatures travel packed by bucket. A set
   with K segments and H differing shingles at most agrees with a linked set on K - H
   of them, so it may leave the K - H - 1 signatures that most sets share: texts that have
   a passage in common do not meet by it.
3. *Star search.* In each group of nodes with a common signature the smallest
   node is the pivot. A node's sketch, one bit for each shingle's hash modulo a
   power of two, bounds from below how many shingles two sets differ in; pivot
   and node go on only if that leaves a link possible. Then a pivot's shingles
   are the query of a T-occurrence search over the nodes it met: DivideSkip merges the
   short inverted lists with a heap, binary-probes the long ones, and retains
   nodes that reach the overlap. Pivots with many nodes are split into blocks.
4. *Components* by union-find in one task up to ``ONE_TASK`` links, beyond that by
   alternating large and small stars, in rounds written to the shared folder.
5. *Rest.* Groups whose nodes are still in different components take another
   pivot, held against the nodes of other components, and components are formed
   anew. Then each node outside its group's largest component is held
   against the nearest nodes by finer sketches, and where it had more of them that
   may link, against all. The T-occurrence search decides each time.

``all_links`` and ``link_counts`` give the links themselves and their number for each
document: the same nodes, signatures and T-occurrence search, with every pair of a
group that the sketches allow. Their cost grows with the number of such pairs.

Only sets that may still link are fetched, from one document of each node. No
step of the components forms the pairs of a group of near copies. Step 5 compares the
sketches of the nodes that are left outside with those of their group, so a group
of m nodes of which none link costs m * m sketch comparisons in blocks, and rows only
where sketches allow a link. A signature that many sets share is combined where it
is made, so its bucket holds a few numbers a slice of the input. Intermediate tables are Parquet in the
shared folder, so lost executors only repeat their own tasks.

Defined results: null or empty texts have an empty set and are their own
component; fewer than five words are one shingle of the whole sequence; null
ids can link others but never name a component that has an id; repeated rows
and repeated ids give a row each.
"""

from __future__ import annotations

import bisect
import heapq
import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import fresh_dir
from ._batches import id_and_text, map_batches, slices

WORDS = 5
HOT = 0.005
BAND = 1.6
BLOCK = 512                     # nodes searched at once
PIVOTS = 1                      # further pivots of a group before its outer nodes are searched one by one
NEAREST = 2                     # nodes by sketch that an outer node is held against first
FINE = 2                        # times the bits of the sketches of that search
BUCKET_ENTRIES = 1 << 20        # signatures in one bucket, about
SORTED = 1 << 18                # of them sorted at once, about

_U = np.uint64
_COEFFICIENTS = [_U(0x9E3779B97F4A7C15), _U(0xC2B2AE3D27D4EB4F), _U(0x165667B19E3779F9),
                 _U(0xD6E8FEB86659FD93), _U(0xA0761D6478BD642F)]
#: Least sizes of the bands; a set meets only sets of its own and the next lower band.
BOUNDS = np.array(sorted({math.ceil(BAND ** i) for i in range(70)}), np.int64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> _U(33))
    x = x * _U(0xFF51AFD7ED558CCD)
    x = x ^ (x >> _U(29))
    x = x * _U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> _U(32))


#: Random 64-bit values of the bytes, and an odd base with its powers and their inverses.
_BYTE = _mix(np.arange(1, 257, dtype=np.uint64) * _COEFFICIENTS[0])
_BASE = 0x2545F4914F6CDD1D
_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        size = max(n, 1 << 16)
        for k, r in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            x = np.full(size, r, np.uint64)
            x[0] = 1
            _powers[k] = np.multiply.accumulate(x)
    return _powers[0], _powers[1]


SEGMENT = 1 << 20               # bytes hashed at once; segments end between words


def word_hashes(data: bytes) -> np.ndarray:
    """64-bit hashes of the words of a text, in order. A word's hash is a polynomial over
    its bytes, taken for all words at once from one running sum."""
    out, at = [], 0
    while at < len(data):
        end = at + SEGMENT
        if end < len(data):
            spaces = [i for i in (data.find(c, end) for c in b" \t\n\x0b\x0c\r") if i >= 0]
            end = min(spaces, default=len(data))
        x = np.frombuffer(data, np.uint8, min(end, len(data)) - at, at)
        at += len(x)
        edge = np.flatnonzero(np.diff(_SPACE[x], prepend=True, append=True))
        first, last = edge[::2], edge[1::2]
        power, inverse = _power(len(x) + 1)
        total = np.zeros(len(x) + 1, np.uint64)
        np.cumsum(_BYTE[x] * power[:len(x)], out=total[1:])
        out.append((total[last] - total[first]) * inverse[first])
    return _mix(np.concatenate(out)) if out else np.zeros(0, _U)


def shingle_set(text: str) -> np.ndarray:
    """Sorted distinct hashes of a text's shingles. Words split on ASCII white space,
    and only A-Z are lowered, which is what bytes.lower does."""
    h = word_hashes(text.encode("utf-8").lower())
    if not len(h):
        return h
    n = max(1, len(h) - WORDS + 1)
    total = np.full(n, min(len(h), WORDS), np.uint64)
    for j in range(min(len(h), WORDS)):
        total += h[j:j + n] * _COEFFICIENTS[j]
    return np.unique(_mix(total))


def fingerprint(shingles: np.ndarray) -> int:
    """Signed 64-bit name of a set."""
    return int(np.int64(xxhash.xxh3_64_intdigest(shingles.tobytes()) - (1 << 63)))


def sketch(shingles: np.ndarray, fine: int = 1) -> bytes:
    """Bits at the shingles' hashes modulo the power of two above the set's size (64 at least), or
    ``fine`` times that."""
    size = fine * max(64, 1 << (len(shingles) - 1).bit_length()) if len(shingles) else 64 * fine
    bits = np.zeros(size, bool)
    bits[(_mix(shingles) & _U(size - 1)).astype(np.int64)] = True
    return np.packbits(bits, bitorder="little").tobytes()


def folded(sketch_: bytes, size: int) -> int:
    """A sketch as an integer of ``size`` bytes: as if its hashes were taken modulo that."""
    x, n = int.from_bytes(sketch_, "little"), len(sketch_)
    while n > size:
        n //= 2
        x = (x | (x >> (8 * n))) & ((1 << (8 * n)) - 1)
    return x


def may_link(n: int, a: bytes, m: int, b: bytes) -> bool:
    """False only if two sets of these sizes and sketches differ in too many shingles."""
    size = min(len(a), len(b))
    return (10 * min(n, m) >= 8 * max(n, m)
            and (folded(a, size) ^ folded(b, size)).bit_count() <= (n + m) // 9)


def overlap_needed(a, b):
    """Least intersection size for 100 * I >= 80 * U: I >= 4 (a + b) / 9."""
    return -(-4 * (a + b) // 9)


# -- signatures ------------------------------------------------------------------------------

def _segments(tag: int) -> int:
    upper = int(BOUNDS[tag + 1]) - 1
    return math.ceil(0.25 * upper * 1.12) + 3


def _tags(n: int) -> list[tuple[int, int]]:
    """(tag, most shingles in which a set of n and its partners under the tag differ)."""
    own = int(np.searchsorted(BOUNDS, n, "right")) - 1
    out = [(own, (n + 5 * n // 4) // 9)]
    lower = int(BOUNDS[own]) - 1
    if own and 10 * lower >= 8 * n:
        out.append((own - 1, (n + lower) // 9))
    return out


def _segment_hashes(h: np.ndarray, tag: int, universe: int) -> np.ndarray:
    """One hash per non-empty segment. Segments are ranges of the hash, so they are
    consecutive in the sorted set."""
    if not len(h):
        return h
    k = _U(_segments(tag))
    seg = ((h >> _U(32)) * k) >> _U(32)
    first = np.flatnonzero(np.concatenate([[True], seg[1:] != seg[:-1]]))
    total = np.add.reduceat(_mix(h ^ _U(0x5851F42D4C957F2D)), first)
    return _coded(_mix(total + _mix(seg[first] * _U(1024) + _U(tag * 4 + universe))), tag, universe)


def _code(tag: int, universe: int) -> int:
    """Number of a universe among those of one set, which has at most two neighbouring tags."""
    return (tag & 1) * 4 + universe


def _coded(x: np.ndarray, tag: int, universe: int) -> np.ndarray:
    """Signatures with their universe in the three upper bits."""
    return (x >> _U(3)) | _U(_code(tag, universe) << 61)


def signatures(h: np.ndarray, hot: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Signatures of one set, and how many of them it may leave: (code, number) by universe.
    Linked sets have at least one in common that neither leaves, if both leave the last ones
    in one order of all signatures.

    With more than H non-empty segments, H being the most shingles that differ,
    one of them must be whole in both sets. Universe 0 leaves out hot shingles;
    where it has too few segments, universe 1 (its shingles alone) is added; where it
    has no more than H shingles, universe 2 (segments of all shingles), and where that
    has too few, universe 3 (each shingle alone). If either set of a pair has enough
    in a universe, both emit it. Texts that share a template but hold more than H
    other shingles so never meet by the template.

    Of K > H segments at least K - H are whole in both sets, so the first of these in
    any order is among the set's first H + 1. Segments come all, to be put in order by the
    number of sets that share them; of single shingles the first H + 1 by value do.
    """
    rest = h
    if len(hot):
        at = np.searchsorted(hot, h)
        at[at == len(hot)] = 0
        rest = h[hot[at] != h]
    out, spare = [], []

    def add(segments: np.ndarray, tag: int, universe: int, differ: int) -> bool:
        out.append(segments)
        if len(segments) > differ + 1:
            spare.append((_code(tag, universe), len(segments) - differ - 1))
        return len(segments) > differ
    for tag, differ in _tags(len(h)):
        if add(_segment_hashes(rest, tag, 0), tag, 0, differ):
            continue
        out.append(_coded(_mix(rest[:differ + 1] + _U(tag * 4 + 1)), tag, 1))
        if len(rest) <= differ and not add(_segment_hashes(h, tag, 2), tag, 2, differ):
            out.append(_coded(_mix(h[:differ + 1] + _U(tag * 4 + 3)), tag, 3))
    return np.concatenate(out), spare


# -- T-occurrence search -----------------------------------------------------------------------

def divide_skip(query: np.ndarray, sets: list[np.ndarray], wanted: np.ndarray | None = None) -> list[tuple[int, int]]:
    """(index, overlap) of the sets that link with the query, by T-occurrence search.

    The inverted lists of the query's shingles over the sets are divided into the
    L longest and the rest. A set with T shingles in common must stand in at least
    T - L of the short lists: those are merged with a heap. Each set that does is
    looked up in the long lists by binary search, leaving off when it can no
    longer reach its own T. ``wanted`` restricts the sets searched.
    """
    index = range(len(sets)) if wanted is None else [int(i) for i in wanted]
    n = len(query)
    index = [i for i in index if 10 * min(n, len(sets[i])) >= 8 * max(n, len(sets[i]))]
    if not index or not n:
        return []
    lists: dict[int, list[int]] = {}
    for i in index:
        at = np.searchsorted(query, sets[i])
        at[at == n] = 0
        for t in at[query[at] == sets[i]].tolist():
            lists.setdefault(t, []).append(i)               # ascending: sets come in order
    least = overlap_needed(n, min(len(sets[i]) for i in index))
    if len(lists) < least:
        return []
    by_size = sorted(lists.values(), key=len, reverse=True)
    n_long = min(least - 1, int(least / (0.01 * math.log2(len(by_size[0]) + 1) + 1)))
    long, short = by_size[:n_long], by_size[n_long:]
    out = []

    def probe(i: int, count: int) -> None:
        need, left = overlap_needed(n, len(sets[i])), len(long)
        for x in long:
            if count + left < need:
                return
            left -= 1
            p = bisect.bisect_left(x, i)
            count += p < len(x) and x[p] == i
        if count >= need:
            out.append((i, count))

    current, count = -1, 0
    for i in heapq.merge(*short):
        if i == current:
            count += 1
            continue
        if count >= least - n_long and current >= 0:
            probe(current, count)
        current, count = i, 1
    if count >= least - n_long and current >= 0:
        probe(current, count)
    return out


# -- the distributed join ----------------------------------------------------------------------

def _stored(spark: SparkSession, df: DataFrame, root: str, name: str) -> DataFrame:
    """Cut the lineage: write to the shared folder and read again."""
    path = f"{root}/{name}"
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _nodes(docs: DataFrame) -> DataFrame:
    """doc_id, fp (null for an empty set), n, sketch, and on a batch's first row its
    frequent shingles."""
    def work(ids, texts):
        fps, ns, sketches, sets = [], [], [], {}
        for t in texts:
            s = shingle_set(t)
            ns.append(len(s))
            fps.append(fingerprint(s) if len(s) else None)
            sketches.append(sketch(s) if len(s) else None)
            if len(s):
                sets[fps[-1]] = s
        frequent: list[int] = []
        counts: list[int] = []
        if sets:
            values = np.concatenate(list(sets.values()))
            least = max(4, math.ceil(HOT / 2 * len(sets)))
            # Only hashes in often hit cells of a table can be frequent; count those.
            cell = (values >> _U(44)).astype(np.int64)
            often = values[np.bincount(cell, minlength=1 << 20)[cell] >= least]
            v, c = np.unique(often, return_counts=True)
            frequent = v[c >= least].astype(np.int64).tolist()
            counts = c[c >= least].tolist()
        pad = len(ids) - 1
        return [ids, fps, ns, sketches, [frequent] + [None] * pad, [counts] + [None] * pad]
    return map_batches(docs, "doc_id long, fp long, n long, sketch binary, frequent array<long>, counts array<long>", work)


def _hot_shingles(nodes: DataFrame) -> np.ndarray:
    """Sorted shingles of at least HOT of the sets, by the batches' counts. Their number is
    at most average set size / HOT, whatever the number of documents."""
    total = nodes.agg(F.approx_count_distinct("fp")).first()[0] or 0
    each = nodes.filter(F.size("frequent") > 0).select(F.explode(F.arrays_zip("frequent", "counts")).alias("x"))
    rows = (each.groupBy(F.col("x.frequent").alias("h")).agg(F.sum("x.counts").alias("c"))
            .filter(F.col("c") >= max(4, HOT * total)).select("h").collect())
    return np.sort(np.array([r.h for r in rows], np.int64).astype(_U))


#: A signature that so many sets of one slice share is combined there.
COMBINE = 16


def _packed_signatures(docs: DataFrame, hot: np.ndarray, buckets: int) -> DataFrame:
    """Rows deal, bucket, sig, who, fps, ns: a slice's signatures of one bucket as packed integers.

    Of a signature that many sets of the slice share, only the smallest set goes to
    the bucket, with the number of sets it stands for; the group itself leaves as a
    row of bucket -1 (sig, pivot, set of each other one), dealt anywhere. So a signature that a third
    of all sets share is a few numbers a slice where its bucket is put together. How many
    signatures a set may leave are rows of bucket -2 (code, set, number).
    """
    schema = pa.schema([("deal", pa.int32()), ("bucket", pa.int32())]
                       + [(c, pa.binary()) for c in ("sig", "who", "fps", "ns")])

    def row(deal, bucket, *arrays):
        return pa.RecordBatch.from_arrays(
            [pa.array([deal], pa.int32()), pa.array([bucket], pa.int32())]
            + [pa.array([x.tobytes()], pa.binary()) for x in arrays], schema=schema)

    def run(batches):
        for b in slices(batches):
            sets: dict[int, np.ndarray] = {}
            for t in b.column(1).to_pylist():
                s = shingle_set(t)
                if len(s):
                    sets.setdefault(fingerprint(s), s)
            if not sets:
                continue
            fps = np.sort(np.array(list(sets), np.int64))
            each, spare = zip(*(signatures(sets[f], hot) for f in fps.tolist()))
            left = np.array([(i, c, n) for i, x in enumerate(spare) for c, n in x], np.int64).reshape(-1, 3)
            yield row(int(fps[0] % buckets), -2, left[:, 1].astype(_U), left[:, 0].astype(np.uint32), fps,
                      left[:, 2].astype(np.uint32))
            who = np.repeat(np.arange(len(each), dtype=np.uint32), [len(x) for x in each])
            sig = np.concatenate(each)
            order = np.argsort(sig, kind="stable")          # a signature's sets stay in ascending order
            sig, who = sig[order], who[order]
            first = np.flatnonzero(np.concatenate([[True], sig[1:] != sig[:-1]]))
            m = np.diff(np.append(first, len(sig)))
            shared = m >= COMBINE
            if shared.any():
                pivot = np.repeat(who[first], m)
                inner = np.repeat(shared, m)
                inner[first] = False
                yield row(int(fps[0] % buckets), -1, sig[inner], pivot[inner], fps, who[inner])
                stay = ~inner
                weight = np.ones(len(sig), np.uint32)
                weight[first[shared]] = m[shared]
                sig, who, weight = sig[stay], who[stay], weight[stay]
            else:
                weight = np.ones(len(sig), np.uint32)
            bucket = (sig % _U(buckets)).astype(np.int32)
            order = np.argsort(bucket, kind="stable")
            sig, who, weight, bucket = sig[order], who[order], weight[order], bucket[order]
            first = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
            for s, e in zip(first, [*first[1:], len(bucket)]):
                here, own = np.unique(who[s:e], return_inverse=True)
                yield row(bucket[s], bucket[s], sig[s:e], own.astype(np.uint32), fps[here], weight[s:e])
    return docs.mapInArrow(run, "deal int, bucket int, sig binary, who binary, fps binary, ns binary")


_GROUP = "gid long, pivot long, fp long, m long"


def _groups(packed: DataFrame, buckets: int) -> DataFrame:
    """Rows gid, pivot, fp, m: each node of a signature group of m >= 2 nodes but a pivot. Rows
    with m < 0 and no pivot: node fp may leave -m groups of the universe gid."""
    def groups_of(parts: list[tuple]):
        # A signature's sets are in one share of the bucket: those of a range of its middle bits.
        shares = 1 << max(0, (sum(len(p[0]) for p in parts) // 8 // SORTED).bit_length())
        for k in range(shares):
            if (b := groups_in(parts, shares, k)) is not None:
                yield b

    def groups_in(parts: list[tuple], shares: int, k: int) -> pa.RecordBatch | None:
        sig, fp, weight = [], [], []
        for p in parts:
            s = np.frombuffer(p[0], _U)
            at = slice(None) if shares == 1 else (s >> _U(40)) & _U(shares - 1) == _U(k)
            sig.append(s[at])
            fp.append(np.frombuffer(p[2], np.int64)[np.frombuffer(p[1], np.uint32)[at]])
            weight.append(np.frombuffer(p[3], np.uint32)[at].astype(np.int64))
        sig, fp, weight = np.concatenate(sig), np.concatenate(fp), np.concatenate(weight)
        if not len(sig):
            return None
        order = np.lexsort((fp, sig))
        sig, fp, weight = sig[order], fp[order], weight[order]
        new = np.flatnonzero(np.concatenate([[True], (sig[1:] != sig[:-1]) | (fp[1:] != fp[:-1])]))
        sig, fp, weight = sig[new], fp[new], np.maximum.reduceat(weight, new)
        first = np.flatnonzero(np.concatenate([[True], sig[1:] != sig[:-1]]))
        m = np.diff(np.append(first, len(sig)))
        pivot, size = np.repeat(fp[first], m), np.repeat(np.add.reduceat(weight, first), m)
        keep = fp != pivot
        return pa.RecordBatch.from_arrays(
            [pa.array(sig[keep].astype(np.int64)), pa.array(pivot[keep]), pa.array(fp[keep]), pa.array(size[keep])],
            names=["gid", "pivot", "fp", "m"])

    def combined(sig, pivot, fps, who):
        sig, fps = np.frombuffer(sig, np.int64), np.frombuffer(fps, np.int64)
        return pa.RecordBatch.from_arrays(
            [pa.array(sig), pa.array(fps[np.frombuffer(pivot, np.uint32)]),
             pa.array(fps[np.frombuffer(who, np.uint32)]), pa.array(np.full(len(sig), COMBINE))],
            names=["gid", "pivot", "fp", "m"])

    def left(code, who, fps, number):
        code, number = np.frombuffer(code, np.int64), np.frombuffer(number, np.uint32).astype(np.int64)
        return pa.RecordBatch.from_arrays(
            [pa.array(code), pa.nulls(len(code), pa.int64()),
             pa.array(np.frombuffer(fps, np.int64)[np.frombuffer(who, np.uint32)]), pa.array(-number)],
            names=["gid", "pivot", "fp", "m"])

    def run(batches):
        bucket, parts = None, []
        for b in batches:
            cols = [b.column(i).to_pylist() for i in range(1, 6)]
            for row in zip(*cols):
                if row[0] < 0:
                    yield combined(*row[1:]) if row[0] == -1 else left(*row[1:])
                    continue
                if row[0] != bucket and parts:
                    yield from groups_of(parts)
                    parts = []
                bucket = row[0]
                parts.append(row[1:])
        if parts:
            yield from groups_of(parts)
    return packed.repartition(buckets, "deal").sortWithinPartitions("bucket").mapInArrow(run, _GROUP)


def _prefixes(spark: SparkSession, signed: DataFrame, root: str) -> DataFrame:
    """Rows gid, pivot, fp, m of the groups after every node has left what it may.

    A node's signatures that no other node has come first in the order, then those in few
    groups; so a node that has no more groups than it may leave is in none. What
    one window holds are the signatures of one node.
    """
    code = F.shiftrightunsigned("gid", 61).alias("code")
    spare = (signed.filter("m < 0").groupBy("fp", F.col("gid").alias("code"))
             .agg(F.max(-F.col("m")).alias("spare")))
    node = Window.partitionBy("fp", "code")
    members = (_members(signed.filter("m > 0")).select("gid", "fp", code)
               .withColumn("own", F.count(F.lit(1)).over(node)).join(spare, ["fp", "code"], "left")
               .withColumn("spare", F.coalesce("spare", F.lit(0))).filter("own > spare"))
    members = _stored(spark, members.drop("own"), root, "members")       # read twice
    size = members.groupBy("gid").agg(F.count(F.lit(1)).alias("m"))
    kept = (members.join(size, "gid")
            .withColumn("place", F.row_number().over(node.orderBy(F.desc("m"), "gid")))
            .filter("place > spare").select("gid", "fp"))
    group = kept.groupBy("gid").agg(F.min("fp").alias("pivot"), F.count(F.lit(1)).alias("m")).filter("m > 1")
    return kept.join(group, "gid").filter("fp <> pivot").select("gid", "pivot", "fp", "m")


BITS = 1 << 25                  # of the fixed-size filter of wanted ids (4 MB, whatever their number)


def _filtered(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``docs`` without most of the rows whose id is not wanted, so that they are not shuffled.
    The filter never loses a wanted row; the join after it is exact."""
    spot = F.pmod(F.xxhash64("key"), F.lit(BITS))
    maps = (wanted.select(spot.alias("spot"))
            .groupBy(F.bitmap_bucket_number("spot").alias("b"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("spot")).alias("bits")).collect())
    parts = {r.b: bytes(r.bits) for r in maps}
    width = 8 * 4096
    bits = np.zeros((BITS // width + 2) * width, bool)
    for b, raw in parts.items():
        bits[b * width:(b + 1) * width] = np.unpackbits(np.frombuffer(raw, np.uint8), bitorder="little")
    bits = np.packbits(bits)
    at = (F.bitmap_bucket_number(spot) * width + F.bitmap_bit_position(spot)).alias("at")

    def run(batches):
        for b in batches:
            spots = b.column(2).to_numpy()
            keep = (bits[spots >> 3] >> (7 - (spots & 7))) & 1
            yield b.select(["doc_id", "text"]).filter(pa.array(keep.astype(bool)))
    return (docs.withColumn("key", F.col("doc_id")).select("doc_id", "text", at)
            .mapInArrow(run, "doc_id long, text string"))


def _sets_of(docs: DataFrame, nodes: DataFrame, wanted: DataFrame) -> DataFrame:
    """Rows fp, shingles (packed) for the wanted nodes, from one document of each."""
    one = (nodes.filter(F.col("fp").isNotNull()).join(wanted.select("fp"), "fp", "left_semi")
           .groupBy("fp").agg(F.min("doc_id").alias("key")))
    texts = _filtered(docs, one).join(one, F.col("doc_id").eqNullSafe(F.col("key"))).select("fp", "text")

    def work(fps, texts):
        sets = [shingle_set(t) for t in texts]
        # An id may stand on several texts; only the one that makes the node counts.
        at = [i for i, s in enumerate(sets) if len(s) and fingerprint(s) == fps[i]]
        return [[fps[i] for i in at], [sets[i].tobytes() for i in at]]
    return map_batches(texts, "fp long, shingles binary", work).dropDuplicates(["fp"])


def _possible(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """The (pivot, fp) rows whose sketches leave a link possible."""
    one = nodes.select("fp", "n", "sketch")
    both = (edges.join(one, "fp").select("pivot", F.col("fp").alias("other"), F.col("n").alias("m"),
                                         F.col("sketch").alias("theirs"))
            .join(one, F.col("pivot") == F.col("fp")).select("pivot", "other", "n", "sketch", "m", "theirs"))

    def work(pivots, others, n, a, m, b):
        at = [i for i in range(len(n)) if may_link(n[i], a[i], m[i], b[i])]
        return [[pivots[i] for i in at], [others[i] for i in at]]
    return map_batches(both, "pivot long, fp long", work)


def _by_group(rows: DataFrame, keys: list[str], values: list[str], search) -> DataFrame:
    """Rows u, v from ``search(list of value tuples)`` on each group of ``keys``."""
    def run(batches):
        key, group = None, []
        for b in batches:
            for row in zip(*[b.column(i).to_pylist() for i in range(b.num_columns)]):
                if row[:len(keys)] != key and group:
                    yield out(search(group))
                    group = []
                key = row[:len(keys)]
                group.append(row[len(keys):])
        if group:
            yield out(search(group))

    def out(links):
        return pa.RecordBatch.from_arrays(
            [pa.array([x[i] for x in links], pa.int64()) for i in (0, 1)], names=["u", "v"])
    return (rows.select(*keys, *values).repartition(*keys).sortWithinPartitions(*keys, *values[:2])
            .mapInArrow(run, "u long, v long"))


#: Nodes whose names are sent to all executors (some 30 MB there); beyond it the join alone picks.
SENT = 1 << 20


def _only(nodes: DataFrame, pairs: DataFrame) -> DataFrame:
    """``nodes`` (by fp) without those of no pair, where these are few enough to be named to each
    executor; so that the join after it shuffles little. ``pairs`` is a written table."""
    ends = pairs.select("fp").unionByName(pairs.select(F.col("pivot").alias("fp"))).distinct()
    if 2 * pairs.count() > SENT:
        return nodes
    return nodes.join(F.broadcast(ends), "fp", "left_semi")


def _star_links(edges: DataFrame, sets: DataFrame) -> DataFrame:
    """Links between pivots and the nodes they met."""
    degree = edges.groupBy("pivot").agg(F.count(F.lit(1)).alias("d"))
    blocks = degree.withColumn("blocks", F.ceil(F.col("d") / BLOCK))
    members = (edges.join(blocks, "pivot")
               .select("pivot", F.pmod(F.xxhash64("fp"), F.col("blocks")).alias("block"), "fp",
                       F.lit(1).alias("side")))
    queries = blocks.select("pivot", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"),
                            F.col("pivot").alias("fp"), F.lit(0).alias("side"))
    rows = members.unionByName(queries).join(sets, "fp")

    def search(group):
        if group[0][0] != 0:
            return []
        (_, pivot, query), others = group[0], group[1:]
        query, links = np.frombuffer(query, _U), []
        for a in range(0, len(others), BLOCK):
            part = others[a:a + BLOCK]
            found = divide_skip(query, [np.frombuffer(x[2], _U) for x in part])
            links += [(pivot, part[i][1]) for i, _ in found]
        return links
    return _by_group(rows, ["pivot", "block"], ["side", "fp", "shingles"], search)


def _all_pairs(groups: DataFrame, nodes: DataFrame) -> DataFrame:
    """All pairs (pivot, fp) of nodes of one group that may link."""
    members = _members(groups).withColumn("label", F.col("fp"))
    rows = _once(members).join(nodes.select("fp", "n", "sketch"), "fp")
    return _near(rows, None)


def _members(groups: DataFrame) -> DataFrame:
    """Rows gid, fp of whole groups."""
    return groups.select("gid", "fp").unionByName(groups.select("gid", F.col("pivot").alias("fp"))).distinct()


def _once(members: DataFrame) -> DataFrame:
    """Rows gid, fp, label, m of the groups that hold several labels; of groups with the same nodes, one."""
    open_ = (members.groupBy("gid").agg(F.min("label").alias("lo"), F.max("label").alias("hi"),
                                        F.count(F.lit(1)).alias("m"),
                                        F.sum(F.xxhash64("fp").cast("decimal(38,0)")).alias("who"))
             .filter("lo <> hi"))
    return members.join(open_.groupBy("m", "who").agg(F.min("gid").alias("gid")), "gid")


def _labelled(members: DataFrame, label: DataFrame) -> DataFrame:
    return members.select("gid", "fp").join(label, "fp", "left").select(
        "gid", "fp", F.coalesce("root", "fp").alias("label"))


def _pivots(open_: DataFrame, turn: int) -> DataFrame:
    """Rows pivot, fp: the nodes of each group that are in another component than its ``turn``-th pivot.
    Pivots are smallest by a hash, so groups that share most nodes share most pivots."""
    pivot = open_.groupBy("gid").agg(F.min_by(F.struct("fp", "label"), F.xxhash64("fp", F.lit(turn))).alias("p"))
    return (open_.join(pivot, "gid").filter(F.col("label") != F.col("p.label"))
            .select(F.col("p.fp").alias("pivot"), "fp").distinct())


def _near(rows: DataFrame, most: int | None) -> DataFrame:
    """Rows pivot, fp: for each node outside its group's largest component, the ``most`` nearest
    nodes by sketch (or all) that may link and are in other components. A node that has more
    of them is also paired with itself.

    ``rows`` are gid, fp, label, n, sketch. The outer nodes of a group are dealt to
    blocks; each block meets the whole group.
    """
    size = rows.groupBy("gid", "label").agg(F.count(F.lit(1)).alias("c"))
    main = size.groupBy("gid").agg(F.max_by("label", "c").alias("main"), F.sum("c").alias("m"), F.max("c").alias("c"))
    main = main.select("gid", "main", F.ceil((F.col("m") - F.col("c")) / BLOCK).alias("blocks"))
    all_ = rows.select("gid", "fp", "label", "n", "sketch").join(main, "gid").withColumn("outer", F.col("label") != F.col("main"))
    own = F.when(F.col("outer"), F.pmod(F.xxhash64("fp"), F.col("blocks")))
    dealt = all_.withColumn("own", own).withColumn(
        "block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    dealt = dealt.withColumn("side", (F.col("own").isNull() | (F.col("own") != F.col("block"))).cast("int"))

    def search(group):
        side, fp, label, n = (np.array([g[i] for g in group], np.int64) for i in range(4))
        width = np.array([len(g[4]) for g in group])
        out = []
        # Only sets of neighbouring sketch sizes can link: fold to the smaller of the two.
        for w in np.unique(width).tolist():
            at = np.flatnonzero((width >= w) & (width <= 2 * w))
            bits = np.frombuffer(b"".join(folded(group[i][4], w).to_bytes(w, "little") for i in at), _U)
            bits = bits.reshape(len(at), -1)
            narrow = width[at] == w
            for k in np.flatnonzero(side[at] == 0).tolist():
                i = at[k]
                j = np.flatnonzero((label[at] != label[i]) & (narrow | narrow[k]))
                j = j[10 * np.minimum(n[at[j]], n[i]) >= 8 * np.maximum(n[at[j]], n[i])]
                differ = np.bitwise_count(bits[j] ^ bits[k]).sum(1)
                near = differ <= (n[at[j]] + n[i]) // 9
                j, differ = at[j[near]], differ[near]
                for t in j[np.lexsort((fp[j], differ))][:most].tolist():
                    out.append((min(fp[i], fp[t]), max(fp[i], fp[t])))
                if most is not None and len(j) > most:
                    out.append((fp[i], fp[i]))
        return out
    found = _by_group(dealt, ["gid", "block"], ["side", "fp", "label", "n", "sketch"], search)
    return found.select(F.col("u").alias("pivot"), F.col("v").alias("fp")).distinct()


#: Links that one task joins up in memory (some 100 MB there); more go through the stars.
ONE_TASK = 1 << 19


def _joined_up(batches):
    """Rows fp, root of all links of one task, by union-find."""
    up: dict[int, int] = {}

    def find(x: int) -> int:
        while up.setdefault(x, x) != x:
            up[x] = up[up[x]]
            x = up[x]
        return x
    for b in batches:
        for u, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            a, c = find(u), find(v)
            if a != c:
                up[max(a, c)] = min(a, c)
    nodes = [x for x in up if find(x) != x]
    yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array([find(x) for x in nodes], pa.int64())],
                                     names=["fp", "root"])


def components(spark: SparkSession, links: DataFrame, root: str, name: str, one_task: int = ONE_TASK) -> DataFrame:
    """Rows fp, root (smallest node reachable), for nodes with links that are not their own root: by
    union-find in one task up to a proven number of links, beyond it by alternating stars."""
    if links.count() <= one_task:
        return links.select("u", "v").repartition(1).mapInArrow(_joined_up, "fp long, root long")
    edges = _stored(spark, links.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                    .distinct(), root, f"{name}-0")
    before, step = None, 0
    while True:
        step += 1
        # Large star: every larger neighbour of a node moves to the node's smallest one.
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        big = (both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        # Small star: a node's smaller neighbours, and the node, move to the smallest of them.
        least = big.groupBy("u").agg(F.min("v").alias("m"))
        small = (big.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(least.select("u", F.col("m").alias("v"))).filter("u <> v").distinct())
        edges = _stored(spark, small, root, f"{name}-{step}")
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(state) == before:
            return edges.groupBy("u").agg(F.min("v").alias("root")).withColumnRenamed("u", "fp")
        before = tuple(state)


def _closed(spark: SparkSession, docs: DataFrame, nodes: DataFrame, groups: DataFrame, label: DataFrame,
            root: str) -> DataFrame:
    """Labels after the search of the groups whose nodes are still in several components."""
    open_ = _stored(spark, _once(_labelled(_members(groups.filter("m > 2")), label)), root, "open-0")
    if open_.isEmpty():
        return label
    sets = _stored(spark, _with_sketches(_sets_of(docs, nodes, open_.select("fp").distinct())), root, "open-sets")
    sketches = sets.select("fp", "n", "sketch")

    def linked(pairs: DataFrame, turn: int) -> DataFrame | None:
        # Finer sketches of the pairs' nodes leave few to fetch whole sets for.
        finer = _only(sets.select("fp", "n", F.col("fine").alias("sketch")), pairs)
        pairs = _stored(spark, _possible(pairs, finer), root, f"open-left-{turn}")
        links = _stored(spark, _star_links(pairs, _only(sets.select("fp", "shingles"), pairs)), root, f"open-links-{turn}")
        if links.isEmpty():
            return None
        edges = links.unionByName(label.select(F.col("fp").alias("u"), F.col("root").alias("v")))
        return _stored(spark, components(spark, edges, root, f"open-{turn}"), root, f"open-label-{turn}")

    for turn in range(1, PIVOTS + 3):
        if turn <= PIVOTS:
            pairs = _possible(_pivots(open_, turn), sketches)
        elif turn == PIVOTS + 1:
            pairs = _near(open_.join(sketches, "fp"), NEAREST)
        else:
            # Nodes that had more than their nearest: all that is left, in the groups they are in.
            more = near.filter("pivot = fp").select("fp")
            again = open_.join(open_.join(more, "fp", "left_semi").select("gid").distinct(), "gid")
            if again.isEmpty():
                break
            finer = sets.select("fp", "n", F.col("fine").alias("sketch"))
            pairs = _near(again.join(finer, "fp"), None).join(near, ["pivot", "fp"], "left_anti")
        near = _stored(spark, pairs, root, f"open-pairs-{turn}")
        new = linked(near.filter("pivot <> fp"), turn)
        if new is None:
            continue
        label = new
        open_ = _stored(spark, _once(_labelled(open_, label)), root, f"open-{turn}")
        if open_.isEmpty():
            break
    return label


def _with_sketches(sets: DataFrame) -> DataFrame:
    """Rows fp, n, sketch, fine, shingles, with sketches of ``FINE`` and four times ``FINE`` times the bits."""
    def work(fps, raw):
        each = [np.frombuffer(x, _U) for x in raw]
        return [fps, [len(x) for x in each], [sketch(x, FINE) for x in each], [sketch(x, 4 * FINE) for x in each], raw]
    return map_batches(sets.select("fp", "shingles"),
                       "fp long, n long, sketch binary, fine binary, shingles binary", work)


def _prepared(spark: SparkSession, docs: DataFrame, root: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Documents with their nodes, signature groups, and one sketch of each node."""
    nodes = _stored(spark, _nodes(docs), root, "nodes")
    hot = _hot_shingles(nodes)
    entries = nodes.agg(F.sum("n")).first()[0] or 0
    buckets = max(32, -(-entries // (2 * BUCKET_ENTRIES)))
    signed = _stored(spark, _groups(_packed_signatures(docs, hot, buckets), buckets), root, "signed")
    groups = _stored(spark, _prefixes(spark, signed, root), root, "groups")
    one = _stored(spark, nodes.filter(F.col("fp").isNotNull()).select("fp", "n", "sketch").dropDuplicates(["fp"]),
                  root, "sketches")
    return nodes, groups, one


def _links_of(spark: SparkSession, docs: DataFrame, nodes: DataFrame, pairs: DataFrame, root: str,
              name: str) -> DataFrame:
    """The pairs that link, by T-occurrence search over their nodes' whole sets."""
    ends = pairs.select("fp").unionByName(pairs.select(F.col("pivot").alias("fp"))).distinct()
    sets = _stored(spark, _sets_of(docs, nodes, ends), root, f"{name}-sets")
    return _stored(spark, _star_links(pairs, sets), root, f"{name}-links")


def all_links(spark: SparkSession, df: DataFrame, id_col: str = "doc_id",
              text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Every link between different sets once (fp u < v), and the sets' documents (doc_id,
    fp, n_shingles; null fp for an empty set). Documents of one fp link too."""
    root = fresh_dir(spark, "ngram-links")
    docs = id_and_text(df, id_col, text_col)
    nodes, groups, one = _prepared(spark, docs, root)
    pairs = _stored(spark, _all_pairs(groups, one), root, "pairs")
    return (_links_of(spark, docs, nodes, pairs, root, "all"),
            nodes.select("doc_id", "fp", F.col("n").alias("n_shingles")))


def link_counts(spark: SparkSession, df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_shingles, n_links (other rows that link with it)."""
    links, members = all_links(spark, df, id_col, text_col)
    copies = members.filter(F.col("fp").isNotNull()).groupBy("fp").agg(F.count(F.lit(1)).alias("copies"))
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    others = (both.join(copies, F.col("v") == F.col("fp")).groupBy("u").agg(F.sum("copies").alias("others"))
              .withColumnRenamed("u", "fp"))
    n_links = F.coalesce(F.col("copies") - 1 + F.coalesce("others", F.lit(0)), F.lit(0)).alias("n_links")
    return (members.join(copies.join(others, "fp", "left"), "fp", "left")
            .select("doc_id", "n_shingles", n_links))


def link_components(spark: SparkSession, df: DataFrame, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_shingles, component_id (smallest id reachable by links)."""
    root = fresh_dir(spark, "ngram-join")
    docs = id_and_text(df, id_col, text_col)
    nodes, groups, one = _prepared(spark, docs, root)
    edges = _stored(spark, _possible(groups.select("pivot", "fp").distinct(), one), root, "edges")
    links = _links_of(spark, docs, nodes, edges, root, "star")
    label = _stored(spark, components(spark, links, root, "stars"), root, "label")
    label = _closed(spark, docs, nodes, groups, label, root)
    ids = nodes.select("doc_id", "fp", "n").filter(F.col("fp").isNotNull())
    named = (ids.groupBy("fp").agg(F.min("doc_id").alias("lowest")).join(label, "fp", "left")
             .withColumn("root", F.coalesce("root", "fp")))
    lowest = named.groupBy("root").agg(F.min("lowest").alias("component_id"))
    of_node = named.join(lowest, "root").select("fp", "component_id")
    linked = ids.join(of_node, "fp").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    alone = nodes.filter(F.col("fp").isNull()).select("doc_id", F.col("n").alias("n_shingles"),
                                                      F.col("doc_id").alias("component_id"))
    return linked.unionByName(alone)


SQL = """
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\\x20\\x09-\\x0D]+') AS words
  FROM documents
), s AS (
  SELECT doc_id, CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
    ELSE list_distinct([array_to_string(words[i:i + 4], ' ') FOR i IN range(1, len(words) - 3)]) END AS sh
  FROM w
), x AS (
  SELECT doc_id, unnest(sh) AS g FROM s
), common AS (
  SELECT a.doc_id AS p, b.doc_id AS q, count(*) AS i FROM x a JOIN x b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2
), link AS (
  SELECT p, q FROM common JOIN s a ON a.doc_id = p JOIN s b ON b.doc_id = q
  WHERE 100 * i >= 80 * (len(a.sh) + len(b.sh) - i)
), edge AS (
  SELECT p, q FROM link UNION ALL SELECT q, p FROM link
), reach(doc_id, r) AS (
  SELECT doc_id, doc_id FROM s UNION SELECT reach.doc_id, edge.q FROM reach JOIN edge ON edge.p = reach.r
)
SELECT s.doc_id, CAST(len(sh) AS BIGINT) AS n_shingles, c.component_id
FROM s JOIN (SELECT doc_id, min(r) AS component_id FROM reach GROUP BY doc_id) c USING (doc_id)
"""
