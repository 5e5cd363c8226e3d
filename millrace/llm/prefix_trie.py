"""Prefix trie of conversations by truncation peeling (operator 13).

The trie is never built. Every distinct turn sequence starts as a conversation
that ended at its own depth; from the deepest on, the last turn is stripped, what
became equal is merged with the conversations that end there, and a node's
figures are complete the moment its last turn is stripped.

1. *Sequences.* Turns become (128-bit hash of role and text, words) in the JVM;
   texts are never shuffled. Conversations are rebuilt by one join of
   at most three head turns. Equal sequences become one row with its members
   counted, the smallest of them, and the hash of their sorted ids. Ids travel in
   sorted blocks of at most 1,024 (``id >> 10``), and the hash is taken over the
   stream of blocks, so a sequence that a third of all conversations share needs
   no more memory than another.
2. *Peeling.* Sequences are dealt by ranges of their turns and sorted, so what
   shares a prefix stands together, and a prefix that a third of the corpus shares
   spreads over many tasks. A task keeps the nodes of one path: the next
   sequence leaves all nodes beyond their common prefix, which are peeled from the
   deepest up, each handing its figures to the node one turn shorter.
3. *Seams.* Nodes on a task's first and last path may go on in its neighbours.
   They leave the task open, with what they gathered; one more peel over these
   paths, in order, closes them. It sees two paths a task, however many rows there are.
4. *Parents* by one join on the parent's prefix hash.

Defined results: a null role or text reads as empty; turns that tie (null turns
too) are ordered by the MD5 of ``<length of role>:<role><text>``; repeated rows are
turns of their own; rows without a conversation id belong to none and are left out;
``%`` keeps the sign of the id. An empty table has no nodes. A conversation's turn
hashes (some 30 bytes a turn, no text) are one row, so a single conversation should
stay under some ten million turns.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import fresh_dir
from ._batches import pick

GROUP = 20
HEADS = 4
BLOCK_BITS = 10
WORD = r"[^\x20\x09-\x0D]+"
NO_ENDS = hashlib.sha256(b"").hexdigest()
ROOT = b"\0" * 16

_NODE = ("key binary, parent binary, conv_id long, depth long, n_convs long, n_children long, n_leaves long, "
         "saved_tokens long, ends_sha256 string")
_OPEN = "part long, side int, words long"


# -- Sequences ----------------------------------------------------------------------------------

def turn_sequences(conversations: DataFrame) -> DataFrame:
    """conv_id, turns: array of (turn, h, w) in order; h hashes role and text, w counts words."""
    d = pick(conversations, "conv_id", "turn", "role", "text").toDF("conv_id", "turn", "role", "text")
    clean = {c: F.make_valid_utf8(F.coalesce(F.col(c).cast("string"), F.lit(""))) for c in ("role", "text")}
    turns = d.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        clean["role"].alias("role"), clean["text"].alias("text"))
    told = F.concat(F.char_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))
    turn = F.struct("turn", F.unhex(F.md5(told)).alias("h"),
                    F.regexp_count("text", F.lit(WORD)).cast("long").alias("w"))
    return turns.select("conv_id", turn.alias("t")).groupBy("conv_id").agg(
        F.sort_array(F.collect_list("t")).alias("turns"))


def rebuilt(sequences: DataFrame, group: int = GROUP, heads: int = HEADS) -> DataFrame:
    """conv_id, h array, w array, key: every conversation behind the head turns of its group's first."""
    first = sequences.filter(F.col("conv_id") % group == 0).select(
        F.col("conv_id").alias("first_id"), F.slice("turns", 1, heads - 1).alias("head"))
    n = (F.crc32(F.col("conv_id").cast("string")) % heads).cast("int")
    both = sequences.withColumn("n", n).join(
        first, F.col("conv_id") - F.col("conv_id") % group == F.col("first_id"), "left")
    head = F.when(F.col("head").isNull(), F.slice("turns", 1, 0)).otherwise(F.slice("head", F.lit(1), F.col("n")))
    own = F.slice("turns", F.col("n") + 1, F.size("turns"))
    out = both.select("conv_id", F.concat(head, own).alias("t"))
    h = F.col("t.h")
    return out.select("conv_id", h.alias("h"), F.col("t.w").alias("w"), F.unhex(F.md5(
        F.array_join(F.transform(h, F.hex), ""))).alias("key"))


def _ends(batches):
    """Blocks of ids, sorted by (key, block): one row a key, hashed as they pass."""
    key, least, n, sha = None, 0, 0, None
    for b in batches:
        out = []
        for k, ids, m, first in zip(*(c.to_pylist() for c in b.columns)):
            if k != key:
                if key is not None:
                    out.append((least, n, sha.hexdigest()))
                key, least, n, sha = k, first, 0, hashlib.sha256()
            sha.update((("," if n else "") + ids).encode())
            n += m
        yield _columns(out, "conv_id long, n long, ends string")
    if key is not None:
        yield _columns([(least, n, sha.hexdigest())], "conv_id long, n long, ends string")


def distinct_sequences(conversations: DataFrame) -> DataFrame:
    """conv_id (the smallest member), n (members), ends (hash of their ids) of every distinct sequence."""
    blocks = conversations.groupBy("key", F.shiftright("conv_id", BLOCK_BITS).alias("block")).agg(
        F.sort_array(F.collect_list("conv_id")).alias("ids"))
    rows = blocks.select("key", "block", F.array_join(F.col("ids").cast("array<string>"), ",").alias("text"),
                         F.size("ids").cast("long").alias("m"), F.get("ids", F.lit(0)).alias("first"))
    return (rows.repartition("key").sortWithinPartitions("key", "block").drop("block")
            .mapInArrow(_ends, "conv_id long, n long, ends string"))


# -- Peeling ------------------------------------------------------------------------------------

_TYPES = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}


def _columns(rows: list[tuple], ddl: str) -> pa.RecordBatch:
    names = [f.split() for f in ddl.split(", ")]
    cols = list(zip(*rows)) or [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, _TYPES[t]) for c, (_, t) in zip(cols, names)],
                                      names=[n for n, _ in names])


class Node:
    """A prefix on the current path and what was gathered from the nodes peeled below it."""

    __slots__ = ("key", "words", "n", "conv", "children", "leaves", "saved", "ends", "seam")

    def __init__(self, key: bytes, words: int, seam: bool = False):
        self.key, self.words, self.seam = key, words, seam
        self.n = self.children = self.leaves = self.saved = 0
        self.conv: int | None = None
        self.ends: str | None = None

    def add(self, n, conv, children, leaves, saved, ends) -> None:
        self.n += n
        if conv is not None:
            self.conv = conv if self.conv is None else min(self.conv, conv)
        self.children += children
        self.leaves += leaves
        self.saved += saved
        self.ends = ends or self.ends

    def gathered(self) -> tuple:
        return self.n, self.conv, self.children, self.leaves, self.saved, self.ends


class Peel:
    """One path of the trie; nodes that the path leaves are closed or, at a seam, kept open."""

    def __init__(self, seams: bool):
        self.path: list[Node] = []
        self.seams = seams                          # nodes of the first path may go on before it
        self.closed: list[tuple] = []
        self.left: list[tuple[int, Node]] = []      # nodes of the first path that were left, with their depth

    def strip(self, depth: int) -> None:
        """Peel the path to ``depth`` turns (-1: all of it)."""
        while len(self.path) > depth + 1:
            v = self.path.pop()
            if v.seam:
                self.left.append((len(self.path), v))
                continue
            leaves = v.leaves or 1
            saved = v.saved + (v.n - 1) * v.words
            up = self.path[-1] if self.path else None
            self.closed.append((v.key, up.key if up else None, v.conv, len(self.path), v.n, v.children, leaves,
                                saved, v.ends or NO_ENDS))
            if up:
                up.add(v.n, v.conv, 1, leaves, saved, None)

    def push(self, key: bytes, words: int, seam: bool) -> None:
        self.path.append(Node(key, words, seam))


def _peel(batches):
    """A task's sorted sequences: closed nodes, and the open ones of its first and last path."""
    part, peel, before = TaskContext.get().partitionId(), Peel(True), None
    ddl = f"{_NODE}, {_OPEN}"
    first: list[Node] = []
    for b in batches:
        for turns, words, conv, n, ends in zip(*(c.to_pylist() for c in b.columns)):
            seam = before is None
            if seam:
                peel.push(ROOT, 0, True)
                common = 0
            else:
                common, most = 0, min(len(turns), len(before))
                while common < most and turns[common] == before[common]:
                    common += 1
                peel.strip(common)
            key = peel.path[-1].key
            for h, w in zip(turns[common:], words[common:]):
                key = hashlib.blake2b(key + h, digest_size=16).digest()
                peel.push(key, w, seam)
            peel.path[-1].add(n, conv, 0, 0, 0, ends)
            if seam:
                first = list(peel.path)
            before = turns
            if len(peel.closed) >= 10_000:
                yield _columns([(*r, None, None, None) for r in peel.closed], ddl)
                peel.closed.clear()
    out = [(*r, None, None, None) for r in peel.closed]
    left = dict(peel.left)
    nothing = (0, None, 0, 0, 0, None)
    for side, path in ((0, first), (1, peel.path)):
        for d, v in enumerate(path):
            n, conv, children, leaves, saved, ends = (
                v.gathered() if side or d in left else nothing)
            out.append((v.key, None, conv, d, n, children, leaves, saved, ends, part, side, v.words))
    yield _columns(out, ddl)


def _close(batches):
    """The open paths of all tasks, in order of task, side and depth: the nodes they make."""
    peel, at = Peel(False), None
    same = False
    for b in batches:
        cols = {n: c.to_pylist() for n, c in zip(b.schema.names, b.columns)}
        for i, key in enumerate(cols["key"]):
            depth, where = cols["depth"][i], (cols["part"][i], cols["side"][i])
            if where != at:
                at, same = where, True
            if same and not (depth < len(peel.path) and peel.path[depth].key == key):
                peel.strip(depth - 1)               # here the path leaves the one before
                same = False
            if not same:
                peel.push(key, cols["words"][i], False)
            peel.path[depth].add(*(cols[c][i] for c in (
                "n_convs", "conv_id", "n_children", "n_leaves", "saved_tokens", "ends_sha256")))
            if cols["last"][i] and same:
                peel.strip(depth)
        yield _columns(peel.closed, _NODE)
        peel.closed.clear()
    peel.strip(-1)
    yield _columns(peel.closed, _NODE)


def peeled(spark: SparkSession, sequences: DataFrame, root: str) -> DataFrame:
    """Nodes (key, parent, conv_id, depth, n_convs, n_children, n_leaves, saved_tokens, ends_sha256) of
    distinct sequences h, w, conv_id, n, ends."""
    columns = ["h", "w", "conv_id", "n", "ends"]
    (sequences.select(*columns).repartitionByRange("h").sortWithinPartitions("h")
     .mapInArrow(_peel, f"{_NODE}, {_OPEN}").write.parquet(f"{root}/peeled"))
    rows = spark.read.parquet(f"{root}/peeled")
    nodes = [c.split()[0] for c in _NODE.split(", ")]
    # Two paths a task: bounded by the number of tasks and the depth, not by the rows.
    open_ = rows.filter(F.col("part").isNotNull())
    ends = open_.groupBy("part", "side").agg(F.max("depth").alias("end"))
    seams = (open_.join(ends, ["part", "side"]).withColumn("last", F.col("depth") == F.col("end"))
             .repartition(1).sortWithinPartitions("part", "side", "depth").mapInArrow(_close, _NODE))
    return rows.filter(F.col("part").isNull()).select(*nodes).unionByName(seams)


def build_trie(spark: SparkSession, conversations: DataFrame, rebuild: Callable[[DataFrame], DataFrame] = rebuilt,
               ) -> DataFrame:
    """The nodes of the trie over ``conversations`` (conv_id, turn, role, text)."""
    root = fresh_dir(spark, "trie")
    rebuild(turn_sequences(conversations)).write.parquet(f"{root}/rebuilt")
    convs = spark.read.parquet(f"{root}/rebuilt")
    (distinct_sequences(convs).join(convs.select("conv_id", "h", "w"), "conv_id")
     .write.parquet(f"{root}/distinct"))
    peeled(spark, spark.read.parquet(f"{root}/distinct"), root).write.parquet(f"{root}/nodes")
    nodes = spark.read.parquet(f"{root}/nodes")
    up = nodes.filter(F.col("n_children") > 0).select(
        F.col("key").alias("up"), F.col("conv_id").alias("parent_conv_id"))
    return nodes.join(up, F.col("parent") == F.col("up"), "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


SQL = r"""
WITH tab AS (
  SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda a, x: xor(a >> 1, (a & 1) * 3988292384)) ORDER BY i) AS t
  FROM range(256) r(i)),
turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  WHERE conv_id IS NOT NULL),
convs AS (
  SELECT conv_id, list({'role': role, 'text': text}
    ORDER BY turn NULLS FIRST, md5(length(role)::VARCHAR || ':' || role || text)) AS s
  FROM turns GROUP BY conv_id),
heads AS (
  SELECT conv_id, s, (xor(list_reduce(list_concat([4294967295], list_transform(
      string_split(conv_id::VARCHAR, ''), lambda c: ord(c)::BIGINT)),
      lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295) % 4)::INTEGER AS h
  FROM convs, tab),
rebuilt AS (
  SELECT c.conv_id, list_concat(list_filter(coalesce(b.s, []), lambda x, i: i <= c.h),
                                list_filter(c.s, lambda x, i: i > c.h)) AS s
  FROM heads c LEFT JOIN convs b ON b.conv_id = c.conv_id - c.conv_id % 20),
members AS (SELECT conv_id, s, len(s) AS n, unnest(range(len(s) + 1)) AS depth FROM rebuilt),
nodes AS MATERIALIZED (
  SELECT depth, list_filter(s, lambda x, i: i <= depth) AS k, min(conv_id) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE n = depth), '')) AS ends_sha256
  FROM members GROUP BY ALL),
linked AS MATERIALIZED (
  SELECT c.*, p.conv_id AS parent_conv_id, list_filter(c.k, lambda x, i: i < c.depth) AS pk
  FROM nodes c LEFT JOIN nodes p ON p.depth = c.depth - 1 AND p.k = list_filter(c.k, lambda x, i: i < c.depth)),
kids AS (SELECT depth - 1 AS depth, pk AS k, count(*) AS n FROM linked WHERE depth > 0 GROUP BY ALL),
own AS (
  SELECT l.*, coalesce(kids.n, 0) AS n_children, CASE WHEN l.depth = 0 THEN 0 ELSE
    (l.n_convs - 1) * len(regexp_extract_all(l.k[l.depth].text, '[^\x20\x09-\x0D]+')) END AS saved
  FROM linked l LEFT JOIN kids ON kids.depth = l.depth AND kids.k = l.k),
below AS (SELECT k, saved, n_children, unnest(range(depth + 1)) AS up FROM own),
sums AS (
  SELECT up AS depth, list_filter(k, lambda x, i: i <= up) AS k, count(*) FILTER (WHERE n_children = 0) AS n_leaves,
    sum(saved)::BIGINT AS saved_tokens
  FROM below GROUP BY ALL)
SELECT o.conv_id, o.depth, o.parent_conv_id, o.n_convs, o.n_children, s.n_leaves, s.saved_tokens, o.ends_sha256
FROM own o JOIN sums s ON s.depth = o.depth AND s.k = o.k"""
