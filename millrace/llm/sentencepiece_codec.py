"""SentencePiece models on the ``tokenizers`` backend (operator 1).

The model file is a protobuf; its wire format is parsed here, and the parts are
rebuilt as a tokenizer of the ``tokenizers`` library: the normaliser (compiled
character map, surplus spaces, dummy prefix), the metaspace marker, unigram
scores, or for BPE models the merges in the order of their scores, byte
fallback, and the matching decoder.

Pieces never hold the marker after another character, nor a line break with
anything else; where a model's vocabulary shows this, a normalised text may be
cut before each run of markers and around line breaks, and has the ids of its
segments. Each distinct segment is encoded by the library's multithreaded
``encode_batch`` when a worker meets it first, decoded again, and checked against
the SentencePiece library (parity). The ids are always the rebuilt tokenizer's;
where the two differ, the documents are reported with ``parity`` false. Both
marks are stored on the segment's ids and evicted with them.

Defined results: null and empty texts have no ids (the dummy prefix is not
added to nothing) and pass both checks; null ids are kept; repeated rows give
repeated results; very long texts are read whole.
"""

from __future__ import annotations

import functools
import re
import struct
import zlib
from array import array
from dataclasses import dataclass, field

import numpy as np
import public_tokenizers
from pyspark.sql import DataFrame

from ._batches import id_and_text, map_batches
from ._pieces import ChunkStore, in_groups

MODEL = "piece_bpe_32k.model"
MARK = "▁"

# Field numbers and enumerations of the model's protobuf.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2


def _fields(data: bytes):
    """(field number, value) pairs of one protobuf message."""
    at, end = 0, len(data)

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            b = data[at]
            at += 1
            value |= (b & 127) << shift
            if b < 128:
                return value
            shift += 7

    while at < end:
        key = varint()
        kind = key & 7
        if kind == 0:
            value = varint()
        elif kind == 2:
            size = varint()
            value = data[at:at + size]
            at += size
        elif kind in (1, 5):
            size = 8 if kind == 1 else 4
            value = struct.unpack("<d" if kind == 1 else "<f", data[at:at + size])[0]
            at += size
        else:
            raise ValueError(f"wire type {kind} in a SentencePiece model")
        yield key >> 3, value


@dataclass
class PieceModel:
    """What encoding and decoding need of a SentencePiece model."""
    pieces: list[tuple[str, float, int]] = field(default_factory=list)   # text, score, type
    kind: int = UNIGRAM
    byte_fallback: bool = False
    charsmap: bytes = b""
    dummy_prefix: bool = True
    squeeze: bool = True
    escape: bool = True

    @property
    def unknown_id(self) -> int:
        return next((i for i, p in enumerate(self.pieces) if p[2] == UNKNOWN), 0)


def parse_model(data: bytes) -> PieceModel:
    m = PieceModel()
    for number, value in _fields(data):
        if number == 1:
            piece, score, kind = "", 0.0, NORMAL
            for n, v in _fields(value):
                if n == 1:
                    piece = v.decode("utf-8")
                elif n == 2:
                    score = v
                elif n == 3:
                    kind = v
            m.pieces.append((piece, score, kind))
        elif number == 2:
            for n, v in _fields(value):
                if n == 3:
                    m.kind = v
                elif n == 35:
                    m.byte_fallback = bool(v)
        elif number == 3:
            for n, v in _fields(value):
                if n == 2:
                    m.charsmap = v
                elif n == 3:
                    m.dummy_prefix = bool(v)
                elif n == 4:
                    m.squeeze = bool(v)
                elif n == 5:
                    m.escape = bool(v)
    return m


def _merges(m: PieceModel) -> list[tuple[str, str]]:
    """Every way to join two pieces into a third, best score first (ties: lower id)."""
    ids = {p: i for i, (p, _, kind) in enumerate(m.pieces) if kind in (NORMAL, USER_DEFINED)}
    found = []
    for piece, i in ids.items():
        for cut in range(1, len(piece)):
            a, b = piece[:cut], piece[cut:]
            if a in ids and b in ids:
                found.append((-m.pieces[i][1], i, ids[a], ids[b], a, b))
    return [(f[4], f[5]) for f in sorted(found)]


def build_tokenizer(m: PieceModel):
    """The model on the tokenizers backend: normaliser, model and decoder."""
    from tokenizers import Regex, Tokenizer, decoders, models, normalizers
    if m.kind == BPE:
        vocab = {p: i for i, (p, _, _) in enumerate(m.pieces)}
        model = models.BPE(vocab=vocab, merges=_merges(m), unk_token=m.pieces[m.unknown_id][0],
                           fuse_unk=True, byte_fallback=m.byte_fallback)
    elif m.kind == UNIGRAM:
        model = models.Unigram([(p, s) for p, s, _ in m.pieces], unk_id=m.unknown_id,
                               byte_fallback=m.byte_fallback)
    else:
        raise ValueError(f"SentencePiece model type {m.kind} is neither unigram nor BPE")
    tk = Tokenizer(model)
    steps = []
    if m.charsmap:
        steps.append(normalizers.Precompiled(m.charsmap))
    if m.squeeze:
        steps += [normalizers.Replace(Regex("^ +| +$"), ""), normalizers.Replace(Regex(" {2,}"), " ")]
    if m.dummy_prefix:
        steps.append(normalizers.Prepend(" "))
    if m.escape:
        steps.append(normalizers.Replace(" ", MARK))
    if steps:
        tk.normalizer = normalizers.Sequence(steps)
    decode = [decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse()]
    tk.decoder = decoders.Sequence(decode + ([decoders.Strip(" ", 1, 0)] if m.dummy_prefix else []))
    return tk


#: Marks on the first id of a stored segment, evicted with it: SentencePiece gives other
#: ids; the ids decode to something else. Ids are smaller.
DIFFERS, LOSSY = 1 << 30, 1 << 29
#: Letters of the segments that go to the libraries as one text.
GROUP_LETTERS = 400


class Codec:
    """Encoder and decoder of one model file, with parity checks by segment."""

    def __init__(self, path: str):
        import sentencepiece
        with open(path, "rb") as f:
            raw = f.read()
        self.model = parse_model(raw)
        self.full = build_tokenizer(self.model)
        self.normalizer, self.bare = self.full.normalizer, build_tokenizer(self.model)
        from tokenizers import normalizers
        self.bare.normalizer = normalizers.Sequence([])     # segments are normalised already
        self.reference = sentencepiece.SentencePieceProcessor(model_proto=raw)
        plain = [p for p, _, kind in self.model.pieces if kind in (NORMAL, USER_DEFINED)]
        self.cut_marks = all(MARK not in p.lstrip(MARK) for p in plain)
        self.cut_lines = all("\n" not in p or p == "\n" for p in plain)
        self.segment = re.compile(("\n|" if self.cut_lines else "") + (
            rf"{MARK}*[^{MARK}\n]+|{MARK}+" if self.cut_marks and self.cut_lines else
            rf"{MARK}*[^{MARK}]+|{MARK}+" if self.cut_marks else
            r"[^\n]+" if self.cut_lines else r"(?s:.+)"))
        # With an identity normaliser and no unknown pieces (neighbours among those are
        # fused), segments can be checked one by one behind a line
        # break, which no piece crosses. Otherwise whole texts are compared.
        m = self.model
        self.by_segment = bool(self.cut_marks and self.cut_lines and m.escape and m.byte_fallback
                               and not m.charsmap and not m.squeeze)
        self.ahead = self.reference.encode("\n") if self.by_segment else []
        #: Text of each id; None for bytes, whose text depends on their neighbours.
        self.spelled = ["\n" if p == "<0x0A>" else None if kind not in (NORMAL, USER_DEFINED) else p
                        for p, _, kind in m.pieces]
        line = [i for i, p in enumerate(m.pieces) if p[0] in ("\n", "<0x0A>")]
        self.line = line[0] if line else -1
        self.store = ChunkStore(self._encode, most=250_000)

    def _encode(self, segments: list[str]) -> list[bytes]:
        """Packed ids of segments, their first id marked with ``DIFFERS`` or ``LOSSY``.

        Short segments go to both libraries as lines of a few hundred letters (no
        piece crosses a line break); a group on which anything differs is checked
        again segment by segment.
        """
        if not self.by_segment:
            return self._singly(segments)
        groups: list[list[int]] = [[]]
        size = 0
        for i, s in enumerate(segments):
            if size + len(s) > GROUP_LETTERS and groups[-1]:
                groups.append([])
                size = 0
            groups[-1].append(i)
            size += len(s) + 1
        texts = ["\n".join([segments[i] for i in g]) for g in groups]
        own = [e.ids for e in self.bare.encode_batch_fast(texts, add_special_tokens=False)]
        n = len(self.ahead)
        exact = self.reference.encode(["\n" + t.replace(MARK, " ") for t in texts], num_threads=1)
        out: list[bytes] = [b""] * len(segments)
        for g, text, a, b in zip(groups, texts, own, exact):
            said = [self.spelled[i] for i in a]
            ids = np.array(a, np.int32)
            ends = np.flatnonzero(ids == self.line)
            if a == b[n:] and len(ends) == len(g) - 1 and None not in said and "".join(said) == text:
                raw, at = ids.tobytes(), 0
                for i, e in zip(g, [*ends.tolist(), len(a)]):
                    out[i] = raw[4 * at:4 * e]
                    at = e + 1
            else:
                for i, x in zip(g, self._singly([segments[i] for i in g])):
                    out[i] = x
        return out

    def _singly(self, segments: list[str]) -> list[bytes]:
        own = [e.ids for e in self.bare.encode_batch(segments, add_special_tokens=False)]
        exact = own
        if self.by_segment:
            n = len(self.ahead)
            exact = [x[n:] for x in self.reference.encode(
                ["\n" + s.replace(MARK, " ") for s in segments], num_threads=1)]
        back = self.bare.decode_batch([self.guard + x for x in own], skip_special_tokens=False)
        out = []
        for s, a, b, text in zip(segments, own, exact, back):
            ids = array("i", a)
            if ids:
                ids[0] |= DIFFERS * (a != b) | LOSSY * (text != "." + s.replace(MARK, " "))
            out.append(ids.tobytes())
        return out

    @functools.cached_property
    def guard(self) -> list[int]:
        """A leading full stop keeps the decoder from dropping a segment's own space."""
        return self.bare.encode(".", add_special_tokens=False).ids

    def normalize(self, text: str) -> str:
        if not text:
            return text
        if self.by_segment:           # what the normaliser does without a character map
            return (MARK if self.model.dummy_prefix else "") + text.replace(" ", MARK)
        return self.normalizer.normalize_str(text) if self.normalizer else text

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, bool, bool]]:
        """(ids, parity with SentencePiece, decodes to the normalised text) of whole texts."""
        out = []
        for a, b in in_groups(len(texts), lambda i: len(texts[i])):
            segments = [self.segment.findall(self.normalize(t)) for t in texts[a:b]]
            for x in self.store.texts(segments):
                marks = int(np.bitwise_or.reduce(x)) if len(x) else 0
                if marks >= LOSSY:
                    x = x & (LOSSY - 1)
                out.append((x, not marks & DIFFERS, not marks & LOSSY))
            if not self.by_segment:
                exact = self.reference.encode(texts[a:b], num_threads=1)
                for i, e in enumerate(exact, a):
                    out[i] = (out[i][0], list(out[i][0]) == e, out[i][2])
        return out

    def decode(self, ids: list[list[int]]) -> list[str]:
        return self.full.decode_batch(ids, skip_special_tokens=False)


@functools.cache
def codec(model: str = MODEL) -> Codec:
    """The worker's codec of one model; a file name of the public set, or a path."""
    return Codec(model if "/" in model else public_tokenizers.path(model))


def encode_documents(df: DataFrame, model: str = MODEL, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """Rows doc_id, ids array<int>, parity, round_trip."""
    def work(ids, texts):
        r = codec(model).encode(texts)
        return [ids, [x[0] for x in r], [x[1] for x in r], [x[2] for x in r]]
    return map_batches(id_and_text(df, id_col, text_col),
                       "doc_id long, ids array<int>, parity boolean, round_trip boolean", work)


def decode_documents(df: DataFrame, model: str = MODEL, id_col: str = "doc_id",
                     ids_col: str = "ids") -> DataFrame:
    """Rows doc_id, text: the decoded ids (null ids read as none)."""
    from ._batches import pick

    def work(keys, ids):
        return [keys, codec(model).decode([x or [] for x in ids])]
    return map_batches(pick(df, id_col, ids_col).toDF("doc_id", "ids"), "doc_id long, text string", work)


def codec_report(df: DataFrame, model: str = MODEL) -> DataFrame:
    """The digest of operator 1: tokens, their CRC-32 (little-endian 32 bit), and both checks."""
    def work(keys, texts):
        r = codec(model).encode(texts)
        return [keys, [len(x[0]) for x in r], [zlib.crc32(x[0].astype("<u4").tobytes()) for x in r],
                [x[1] for x in r], [x[2] for x in r]]
    return map_batches(id_and_text(df), "doc_id long, n_tokens long, ids_crc32 long, parity boolean, "
                       "round_trip boolean", work)
