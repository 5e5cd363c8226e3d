"""Token ids as ORC files (operator 10).

Texts are dealt out by ranges of the document id and sorted, encoded in a
narrow pass, and written by Spark's ORC writer: one file per range, ids as an
integer list (run-length encoded by ORC), with row indexes and a Bloom filter
on ``doc_id``. Files are in ascending id order; readers split them by stripe,
and a filter on ``doc_id`` skips files and stripes by their statistics and
Bloom filters. Each row also holds its offset inside its file, so the global
start of a document only needs the files' totals (one row per file).

The tokenizer is the ``tokenizers`` library with a vocabulary file given as a
parameter. Its normaliser and splitter treat white space as a break and drop
it, so a text has the ids of its chunks between ASCII white space. Arrow splits
the texts of a slice and numbers their distinct chunks; each of these is encoded
once per worker (``_pieces``), from the ids of its words and signs (``WordEncoder``).

Defined results: a null or empty text has only the end id; equal ids (and null
ids, which come first) are ordered by the text; an empty table writes an empty
data set; a very long text is one row.
"""

from __future__ import annotations

import functools
import json
import os
import re
import zlib
from array import array
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import fresh_dir
from ._batches import id_and_text, slices, small_batches
from ._pieces import LONG_CHUNK, ChunkStore, in_groups

VOCABULARY = "word_bpe_49k.json"
END_ID = 1
STRIPE_BYTES = 64 << 20
ROW_GROUP = 10_000

_ARROW = pa.schema([("doc_id", pa.int64()), ("part", pa.int32()), ("start_in_part", pa.int64()),
                    ("n_tokens", pa.int64()), ("ids", pa.list_(pa.int32()))])
_DDL = "doc_id long, part int, start_in_part long, n_tokens long, ids array<int>"


class WordEncoder:
    """Ids of chunks between white space, put together from the ids of their parts.

    A chunk is cut where a small Latin letter meets an ASCII sign other than the
    apostrophe; the splitter always breaks there. A part of such letters only is
    its own normal form and one word to the splitter, so the model encodes it
    directly; every other part goes through the whole tokenizer.
    """

    #: Small letters of ASCII and Latin-1, as text and as UTF-8 bytes.
    LETTERS = "abcdefghijklmnopqrstuvwxyz" + "".join(map(chr, range(0xDF, 0x100))).replace("\xf7", "")
    _L = rb"(?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf])"
    _SIGN = rb"[!-&(-/:-@\[-`{-~]"
    PART = re.compile(_L + rb"+(?=" + _SIGN + rb"|\Z)|" + _SIGN + rb"+(?=[a-z])")
    WORD = re.compile(rb"(" + _L + rb"+)(" + _SIGN + rb"*)\Z")
    SIGNS = frozenset(b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~")
    MOST = 1 << 18
    #: Bytes between which ``column`` cuts: a small ASCII letter, then a sign.
    IS_SMALL = np.isin(np.arange(256), list(b"abcdefghijklmnopqrstuvwxyz"))
    IS_SIGN = np.isin(np.arange(256), list(SIGNS))
    #: Texts with a mark that may join an ASCII letter, or a special token, are not cut so.
    ODD = (b"\xcc", b"\xcd", b"<|")

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tk = Tokenizer.from_file(path)
        # Only this normaliser and splitter are known to allow the cuts.
        steps = json.loads(self.tk.to_str())
        self.cuts = (steps["normalizer"] == {"type": "Sequence", "normalizers": [
            {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "},
            {"type": "Lowercase"}]} and steps["model"]["type"] == "BPE"
            and steps["pre_tokenizer"]["pretokenizers"][0]["behavior"] == "Removed")
        from tokenizers.pre_tokenizers import ByteLevel
        spell = ByteLevel(add_prefix_space=False, use_regex=False)
        self.spelled = {ord(c): spell.pre_tokenize_str(c)[0][0] for c in self.LETTERS}
        self.store = ChunkStore(self.chunks, self.MOST)

    def parts(self, chunk: bytes) -> tuple[bytes, ...]:
        # By far the most: a word, then one sign or nothing.
        if chunk.isalpha() or not chunk:
            return (chunk,)
        if chunk[-1] in self.SIGNS and chunk[:-1].isalpha():
            return chunk[:-1], chunk[-1:]
        m = self.WORD.match(chunk)
        if m:
            return m.groups() if m.end(1) < len(chunk) else (chunk,)
        if b"<|" in chunk:                  # may hold a special token
            return (chunk,)
        out, at = [], 0
        while at < len(chunk):
            m = self.PART.match(chunk, at)
            end = m.end() if m else len(chunk)
            out.append(chunk[at:end])
            at = end
        return tuple(out)

    def chunks(self, chunks: list[bytes]) -> list[bytes]:
        cut = [self.parts(c) for c in chunks] if self.cuts else [(c,) for c in chunks]
        tokenize, spelled, rest = self.tk.model.tokenize, self.spelled, []
        known: dict[bytes, bytes] = {b"": b""}              # part -> packed ids
        for p in set(chain.from_iterable(cut)) - known.keys():
            if self.cuts and p.isalpha() and p.islower():       # ASCII: spelled as it is
                known[p] = array("i", [t.id for t in tokenize(p.decode("ascii"))]).tobytes()
            elif self.cuts and (m := self.WORD.match(p)) and not m.group(2):
                known[p] = array("i", [t.id for t in tokenize(p.decode("utf-8").translate(spelled))]).tobytes()
            else:
                rest.append(p)
        for p, e in zip(rest, self.tk.encode_batch([p.decode("utf-8") for p in rest], add_special_tokens=False)):
            known[p] = array("i", e.ids).tobytes()
        return [known[c[0]] if len(c) == 1 else b"".join([known[p] for p in c]) for c in cut]

    def split(self, text: str) -> list[bytes]:
        """Chunks between ASCII white space. Capitals are lowered first, as the normaliser
        would, unless a combining mark (lead bytes CC, CD) could join an ASCII letter."""
        data = text.encode("utf-8")
        if self.cuts and not self.odd(data):
            data = data.lower()
        return data.split()

    def odd(self, data: bytes) -> bool:
        return any(x in data for x in self.ODD)

    def column(self, texts: pa.Array) -> list[np.ndarray]:
        """Ids of the whole texts of a string column, which is split and numbered by Arrow."""
        texts = texts.cast(pa.large_string())
        ends = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, 8 * texts.offset)
        data = texts.buffers()[2].slice(ends[0], ends[-1] - ends[0]).to_pybytes() if ends[-1] > ends[0] else b""
        ends = ends - ends[0]
        if not self.cuts or self.odd(data):
            odd = np.array([not self.cuts or self.odd(data[a:b]) for a, b in zip(ends, ends[1:])])
            plain = iter(self.column(texts.filter(pa.array(~odd)))) if not odd.all() else iter(())
            rest = iter(self.store.texts([self.split(t) for t in texts.filter(pa.array(odd)).to_pylist()]))
            return [next(rest) if o else next(plain) for o in odd]
        x = np.frombuffer(data.lower(), np.uint8)
        cuts = np.flatnonzero(self.IS_SMALL[x[:-1]] & self.IS_SIGN[x[1:]]) + 1
        x, ends = np.insert(x, cuts, 32), ends + np.searchsorted(cuts, ends)
        cut = pa.Array.from_buffers(pa.large_string(), len(texts), [None, pa.py_buffer(ends), pa.py_buffer(x)])
        chunks = pc.ascii_split_whitespace(cut)
        numbered = chunks.flatten().dictionary_encode()
        return self.store.coded(numbered.dictionary.cast(pa.large_binary()).to_pylist(), numbered.indices.to_numpy(),
                                np.diff(chunks.offsets.to_numpy()))


@functools.cache
def word_encoder(path: str) -> WordEncoder:
    """The worker's encoder of one vocabulary file."""
    return WordEncoder(path)


def encode_texts(texts: list[str], path: str) -> list[np.ndarray]:
    """Ids of whole texts, without special tokens."""
    words, out = word_encoder(path), []
    for a, b in in_groups(len(texts), lambda i: len(texts[i])):
        out += words.column(pa.array(texts[a:b], pa.large_string()))
    return out


def encode_ranges(df: DataFrame, vocabulary: str = VOCABULARY, end_id: int = END_ID,
                  ranges: int | None = None) -> DataFrame:
    """Rows of the files, sorted and dealt by ranges of ``doc_id``."""
    small_batches(df.sparkSession)
    docs = id_and_text(df)
    order = [F.col("doc_id").asc_nulls_first(), F.col("text")]
    dealt = docs.repartitionByRange(ranges, "doc_id") if ranges else docs.repartitionByRange("doc_id")
    path = public_tokenizers.path(vocabulary)

    def run(batches):
        part, start = TaskContext.get().partitionId(), 0
        for b in slices(batches):
            ids = word_encoder(path).column(b.column(1))
            sizes = np.fromiter(map(len, ids), np.int64, len(ids)) + 1
            ends = np.cumsum(sizes)
            flat = np.full(ends[-1], end_id, np.int32)
            own = np.ones(len(flat), bool)
            own[ends - 1] = False
            flat[own] = np.concatenate(ids)
            yield pa.RecordBatch.from_arrays([
                b.column(0), pa.array(np.full(len(ids), part, np.int32)),
                pa.array(start + ends - sizes), pa.array(sizes),
                pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)),
                                         pa.array(flat))], schema=_ARROW)
            start += int(ends[-1])

    return dealt.sortWithinPartitions(*order).mapInArrow(run, _DDL)


def write_tokens(df: DataFrame, path: str, **how) -> None:
    """Encode and write the ORC files under ``path``."""
    (encode_ranges(df, **how).write.mode("errorifexists")
     .option("orc.stripe.size", STRIPE_BYTES).option("orc.row.index.stride", ROW_GROUP)
     .option("orc.create.index", "true").option("orc.bloom.filter.columns", "doc_id")
     .option("orc.bloom.filter.fpp", 0.01).option("compression", "zstd").orc(path))


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and ids, from the files."""
    rows = spark.read.schema(_DDL).orc(path)
    totals = rows.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    # One row per file; the window and the broadcast see nothing that grows with the rows.
    before = F.broadcast(totals.select("part", F.expr(
        "coalesce(sum(n) over (order by part rows between unbounded preceding and 1 preceding), 0)")
        .alias("before")))
    return rows.join(before, "part").select(
        "doc_id", (F.col("before") + F.col("start_in_part")).alias("start"), "n_tokens", "ids")


def crc_of_ids(tokens: DataFrame, *carry: str) -> DataFrame:
    """``carry`` columns and ids_crc32, the CRC-32 of ids as little-endian 32-bit integers."""
    small_batches(tokens.sparkSession)
    kinds = dict(tokens.dtypes)

    def run(batches):
        for b in batches:
            col = b.column(b.num_columns - 1)
            flat, offsets = col.values.to_numpy(), col.offsets.to_numpy()
            raw = np.ascontiguousarray(flat, dtype="<u4")
            crc = [zlib.crc32(raw[s:e]) for s, e in zip(offsets, offsets[1:])]
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:-1], pa.array(crc, pa.int64())], names=[*carry, "ids_crc32"])

    ddl = ", ".join(f"{c} {kinds[c]}" for c in carry) + ", ids_crc32 long"
    return tokens.select(*carry, "ids").mapInArrow(run, ddl)


def tokens_report(spark: SparkSession, df: DataFrame, path: str | None = None) -> DataFrame:
    """The digest of operator 10: write the files, read them back."""
    path = path or os.path.join(fresh_dir(spark, "tokens"), "orc")
    write_tokens(df, path)
    return crc_of_ids(read_tokens(spark, path), "doc_id", "start", "n_tokens")
