"""Best-fit packing of documents into fixed-length sequences (operator 11).

Few lengths, many documents: the problem is solved over the *histogram* of
piece lengths, and each piece then finds its place by arithmetic on its rank.

1. *Pieces.* One narrow pass encodes every text once (byte-level BPE, end id
   appended), cuts what is longer than a sequence (the first piece takes the
   remainder), and ranks the pieces of each length inside their task. The rows
   are written to the shared folder; they carry counts and CRCs, no ids.
2. *Ranks.* Counts by (task, length) give each task's first rank of a length by
   a running sum over tasks; a length that a third of all pieces share is one
   row a task there.
3. *Configuration linear program.* A configuration is a multiset of lengths that
   fits one sequence; the program covers the histogram with the fewest
   configurations. ``solve`` runs multiplicative weights: a length's weight falls
   as its pieces get covered, and the pricing step finds the heaviest
   configuration by a knapsack dynamic program over the capacity.
4. *Rounding.* Whole multiples of the program's configurations are taken as far
   as pieces are left; the rest is packed best fit, longest first, sequences that
   are filled alike at once. Work and plan depend on the capacity, not the corpus.
5. *Places.* A piece's (length, rank) falls into one run of the plan; its
   sequence and offset follow by division. Narrow, over the written pieces.

Defined results: a null or empty text is one piece with the end id only; repeated
rows (equal ids too) are pieces of their own; an empty table gives no rows; a
very long text is cut, all its pieces but the first full. Ids and extra columns
never matter. The driver holds the histogram (at most ``capacity`` counts) and the plan.
"""

from __future__ import annotations

import functools
import re
import zlib
from array import array
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import fresh_dir
from ._batches import id_and_text
from ._pieces import LONG_CHUNK, ChunkStore, in_groups

VOCABULARY = "byte_bpe_50k.json"
END_ID = 2
CAPACITY = 1024
#: How fast a length's weight falls as it gets covered.
SHARP = 4.0
#: Part of one token's price that the weights may move: under 1, a fuller configuration always wins.
NUDGE = 0.9

_PIECE_DDL = ("doc_id long, piece int, start long, length long, ids_crc32 long, part int, rank long")


# -- Encoding -----------------------------------------------------------------------------------

class ByteEncoder:
    """Ids of whole texts, put together from the ids of their chunks.

    The byte-level splitter starts a new token at white space that follows
    anything else, whatever stands before, so texts are cut there; each distinct
    chunk is encoded once. A chunk of Latin letters or digits and then stops is two tokens
    to the splitter, and each such part is encoded once as well.
    """

    #: Marks a chunk as it stands. Texts are valid UTF-8 and hold no surrogates; a key
    #: without the mark is the chunk after a space, or, with a line break ahead, after that.
    AS_IS = "\ud800"
    DOUBLE = re.compile(r"\s\s")
    ANY = re.compile(r"[ \n]*[^ \n]+|[ \n]+")
    LETTERS = r"A-Za-z\xc0-\xd6\xd8-\xf6\xf8-ɏ"
    PART = re.compile(rf"({AS_IS}|\n?)([{LETTERS}]+|[0-9]+)([.,;:!?]*)\Z")
    STOPS = frozenset(".,;:!?")
    MOST = 1_000_000

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel
        self.tk = Tokenizer.from_file(path)
        split = self.tk.pre_tokenizer
        # Only this splitter is known to allow the cuts.
        self.cuts = (self.tk.normalizer is None and type(split).__name__ == "ByteLevel"
                     and not split.add_prefix_space and split.use_regex)
        spell = ByteLevel(add_prefix_space=False, use_regex=False)
        self.spelled = {c: spell.pre_tokenize_str(chr(c))[0][0] for c in range(1, 0x250)}
        self.known: dict[str, bytes] = {}
        self.store = ChunkStore(self._chunks, most=1_000_000)

    def split(self, text: str) -> list[str]:
        if not text:
            return []
        if not self.cuts:
            return [self.AS_IS + text]
        if self.DOUBLE.search(text):
            # Runs of white space stay whole, in front of what follows.
            out = []
            for c in self.ANY.findall(text):
                if out and out[-1][-1].isspace():
                    out[-1] += c                # other white space ahead of the cut
                else:
                    out.append(self.AS_IS + c)
            return out
        chunks = text.replace("\n", " \n").split(" ")
        first = chunks[0]
        if first:
            chunks[0] = self.AS_IS + first
        else:
            del chunks[0]
        return chunks

    def _word(self, word: str) -> bytes:
        """Ids of one token of the splitter: a space and letters, or letters."""
        ids = self.known.get(word)
        if ids is None:
            ids = array("i", [t.id for t in self.tk.model.tokenize(word.translate(self.spelled))]).tobytes()
            if len(word) <= LONG_CHUNK:
                self.known[word] = ids
        return ids

    def _rest(self, chunk: str) -> bytes:
        """Ids of any chunk or stops, by the whole tokenizer."""
        ids = self.known.get(chunk)
        if ids is None:
            ids = array("i", self.tk.encode(chunk, add_special_tokens=False).ids).tobytes()
            if len(chunk) <= LONG_CHUNK:
                self.known[chunk] = ids
        return ids

    def _chunks(self, keys: list[str]) -> list[bytes]:
        word, rest, out = self._word, self._rest, []
        for k in keys:
            if k.isascii():
                if k.isalpha():
                    out.append(word(" " + k))
                    continue
                if k[-1:] in self.STOPS and k[:-1].isalpha():
                    out.append(word(" " + k[:-1]) + rest(k[-1]))
                    continue
            if m := self.PART.match(k):
                ahead, letters, stops = m.groups()
                ids = (word(" " + letters) if not ahead else
                       rest(ahead) + word(letters) if ahead == "\n" else word(letters))
                out.append(ids + rest(stops) if stops else ids)
            elif k[:1] == self.AS_IS:
                out.append(rest(k[1:]))
            else:
                out.append(rest(k if k[:1] == "\n" else " " + k))
        if len(self.known) > self.MOST:
            self.known.clear()
        return out

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        out = []
        for a, b in in_groups(len(texts), lambda i: len(texts[i])):
            out += self.store.texts([self.split(t) for t in texts[a:b]])
        return out


@functools.cache
def byte_encoder(path: str) -> ByteEncoder:
    """The worker's encoder of one vocabulary file."""
    return ByteEncoder(path)


def pieces(df: DataFrame, vocabulary: str = VOCABULARY, end_id: int = END_ID,
           capacity: int = CAPACITY) -> DataFrame:
    """Rows of ``_PIECE_DDL``: every document's pieces, ranked by length inside their task."""
    path = public_tokenizers.path(vocabulary)

    def run(batches):
        part, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for b in batches:
            texts = b.column(1).to_pylist()
            doc, piece, start, length, crc = [], [], [], [], []
            for a, z in in_groups(len(texts), lambda i: len(texts[i])):
                ids = byte_encoder(path).encode(texts[a:z])
                for i, x in zip(b.column(0)[a:z].to_pylist(), ids):
                    raw = np.append(x, end_id).astype("<u4").tobytes()
                    n = len(raw) // 4
                    at, size, k = 0, (n - 1) % capacity + 1, 0
                    while at < n:
                        doc.append(i)
                        piece.append(k)
                        start.append(at)
                        length.append(size)
                        crc.append(zlib.crc32(raw[4 * at:4 * (at + size)]))
                        at, size, k = at + size, capacity, k + 1
            rank = np.empty(len(length), np.int64)
            for j, n in enumerate(length):
                rank[j] = seen[n]
                seen[n] += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc, pa.int64()), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                 pa.array(length, pa.int64()), pa.array(crc, pa.int64()),
                 pa.array(np.full(len(doc), part, np.int32)), pa.array(rank)],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "part", "rank"])
    return id_and_text(df).mapInArrow(run, _PIECE_DDL)


# -- The configuration program --------------------------------------------------------------------

Config = tuple[tuple[int, int], ...]        # (length, how often), longest first


def price(weights: np.ndarray, limit: np.ndarray | None = None) -> Config:
    """The heaviest configuration: knapsack over capacities 0..C by dynamic programming.

    ``weights[l]`` is the weight of length ``l`` (index 0 unused; 0: not for use),
    C the last index. ``limit`` caps how often a length is taken, by falling back
    to the best item that is left.
    """
    c = len(weights) - 1
    use = np.flatnonzero(weights > 0)
    best, choice = np.zeros(c + 1), np.zeros(c + 1, np.int64)
    w = np.where(weights > 0, weights, -np.inf)[1:]
    ends = np.searchsorted(use, np.arange(c + 1), "right")
    for j in range(1, c + 1):
        gain = w[:j] + best[j - 1::-1]
        at = gain.argmax()
        best[j] = best[j - 1]
        if gain[at] > best[j]:
            best[j], choice[j] = gain[at], at + 1
    taken: dict[int, int] = {}
    j = c
    while j > 0:
        n = int(choice[j])
        if not n:
            j -= 1
            continue
        if limit is None or taken.get(n, 0) < limit[n]:
            taken[n] = taken.get(n, 0) + 1
            j -= n
            continue
        left = [int(x) for x in use[:ends[j]] if taken.get(int(x), 0) < limit[x]]
        if not left:
            break
        n = max(left, key=lambda x: (best[j - x] + weights[x], x))
        taken[n] = taken.get(n, 0) + 1
        j -= n
    return tuple(sorted(taken.items(), reverse=True))


def solve(counts: np.ndarray) -> list[tuple[Config, float]]:
    """Fractional amounts of configurations towards covering the histogram, by multiplicative weights.

    ``counts[l]`` pieces have length ``l``. A length's price is its share of the
    capacity (the program's dual solution where nothing is wasted) plus a small
    weight that falls by ``exp(-SHARP * covered share)``; it decides among
    configurations that are equally full, for long and little covered lengths.
    Each round takes as much of the priced configuration as its scarcest length
    allows, in whole multiples while there is one. It ends when no full
    configuration is left: what is not covered then goes to rounding.
    """
    c = len(counts) - 1
    rest, size = counts.astype(float), np.arange(c + 1) / c
    amount: dict[Config, float] = {}
    while True:
        covered = 1 - rest / np.maximum(counts, 1)
        w = np.where(rest > 1e-6, size + NUDGE / (c + 1) * size ** 2 * np.exp(-SHARP * covered), 0.0)
        config = price(w, np.ceil(rest))
        if sum(n * k for n, k in config) < c:
            return list(amount.items())
        ls, ks = np.array(config).T
        x = float((rest[ls] / ks).min())
        x = float(int(x)) if x >= 1 else x
        rest[ls] -= x * ks
        amount[config] = amount.get(config, 0.0) + x


def best_fit(counts: np.ndarray) -> dict[Config, int]:
    """Pack all pieces best fit, longest first.

    Sequences filled alike are one entry with their number, so the work depends
    on the lengths, not on the number of pieces.
    """
    c = len(counts) - 1
    by_room: list[dict[Config, int]] = [{} for _ in range(c + 1)]
    by_room[c][()] = int(counts.sum())              # empty ones, as many as could be needed
    for n in range(c, 0, -1):
        left, room = int(counts[n]), n
        while left:
            while not by_room[room]:
                room += 1
            taken, m = by_room[room].popitem()
            # An empty sequence takes all of this length that fits; an open one takes one piece.
            k = 1 if taken else min(c // n, left)
            some = min(m, left // k)
            if m > some:
                by_room[room][taken] = m - some
            config = (taken[:-1] + ((n, taken[-1][1] + k),) if taken and taken[-1][0] == n
                      else taken + ((n, k),))
            to = by_room[room - k * n]
            to[config] = to.get(config, 0) + some
            left -= k * some
            room = n
    by_room[c].pop((), None)
    out: dict[Config, int] = {}
    for row in by_room:
        out |= row
    return out


def plan_sequences(counts: np.ndarray) -> dict[Config, int]:
    """Configurations and how many sequences use each; together they hold every piece once."""
    rest = counts.astype(np.int64).copy()
    plan: dict[Config, int] = {}
    for config, x in sorted(solve(rest), key=lambda t: (-t[1], t[0])):
        whole = min(int(x + 1e-6), *(int(rest[n]) // k for n, k in config))
        if whole:
            plan[config] = plan.get(config, 0) + whole
            for n, k in config:
                rest[n] -= k * whole
    for config, m in best_fit(rest).items():
        plan[config] = plan.get(config, 0) + m
    return plan


@dataclass
class Places:
    """The plan as runs of ranks: arrays sorted by (length, first rank)."""

    key: np.ndarray         # length << 40 | first rank
    sequence: np.ndarray    # first sequence of the run
    each: np.ndarray        # pieces of the length in one sequence
    offset: np.ndarray      # of the first of them

    def find(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(sequence, offset) of pieces."""
        key = (length << 40) | rank
        i = np.searchsorted(self.key, key, "right") - 1
        k = key - self.key[i]
        return self.sequence[i] + k // self.each[i], self.offset[i] + (k % self.each[i]) * length


def places(plan: dict[Config, int]) -> Places:
    rows, first, used = [], 0, {}
    for config, m in plan.items():
        offset = 0
        for n, k in config:
            rank = used.get(n, 0)
            rows.append((n << 40 | rank, first, k, offset))
            used[n] = rank + k * m
            offset += n * k
        first += m
    rows.sort()
    return Places(*(np.array([r[i] for r in rows], np.int64) for i in range(4)))


# -- The job ----------------------------------------------------------------------------------------

def pack(spark: SparkSession, df: DataFrame, vocabulary: str = VOCABULARY, end_id: int = END_ID,
         capacity: int = CAPACITY) -> DataFrame:
    """Rows doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    path = f"{fresh_dir(spark, 'pieces')}/pieces"
    pieces(df, vocabulary, end_id, capacity).write.mode("errorifexists").parquet(path)
    rows = spark.read.parquet(path)
    by_task = rows.groupBy("part", "length").agg(F.count("*").alias("n"))
    counts = np.zeros(capacity + 1, np.int64)
    for r in by_task.groupBy("length").agg(F.sum("n").alias("n")).collect():     # at most ``capacity`` rows
        counts[r["length"]] = r["n"]
    found = places(plan_sequences(counts))
    # One row a task and length: a running sum over tasks, whatever the rows of a length.
    before = by_task.select(F.col("part").alias("_part"), F.col("length").alias("_length"), F.expr(
        "coalesce(sum(n) over (partition by length order by part rows between unbounded preceding "
        "and 1 preceding), 0)").alias("before"))
    ranked = rows.join(before, (F.col("part") == F.col("_part")) & (F.col("length") == F.col("_length")))
    keep = ["doc_id", "piece", "start", "length", "ids_crc32"]

    def run(batches):
        for b in batches:
            if b.num_rows:
                sequence, offset = found.find(b.column(3).to_numpy(), b.column(5).to_numpy())
                yield pa.RecordBatch.from_arrays([*b.columns[:5], pa.array(sequence), pa.array(offset)],
                                                 names=[*keep, "sequence_id", "offset"])

    return ranked.select(*keep, (F.col("before") + F.col("rank")).alias("rank")).mapInArrow(
        run, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
