"""Operators 1 and 10: exact parity with the libraries, round trips, and file pruning."""

import glob
import struct
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from millrace.llm import sentencepiece_codec as sp
from millrace.llm import token_orc
from millrace.llm._batches import SLICE_BYTES

TEXT = st.text(alphabet=st.one_of(st.sampled_from("aeinrst .,'\n\té́▁<>|-_0AÉÑ\x00\x1c"), st.characters(
    exclude_categories=("Cs",))), max_size=60)


def varint(n):
    out = b""
    while n > 127:
        out, n = out + bytes([n & 127 | 128]), n >> 7
    return out + bytes([n])


def message(*fields):
    out = b""
    for number, value in fields:
        if isinstance(value, float):
            out += varint(number << 3 | 5) + struct.pack("<f", value)
        elif isinstance(value, int):
            out += varint(number << 3) + varint(value)
        else:
            value = value.encode() if isinstance(value, str) else value
            out += varint(number << 3 | 2) + varint(len(value)) + value
    return out


def unigram_model(byte_fallback, dummy_prefix=True, squeeze=False):
    """A small unigram model written by hand (nothing is trained)."""
    pieces = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3)]
    if byte_fallback:
        pieces += [(f"<0x{b:02X}>", 0.0, 6) for b in range(256)]
    words = ["▁", "▁the", "the", "▁a", "a", "e", "i", "n", "r", "s", "t", "h", "in", "▁in", "er", "st", "rest",
             "▁rest", "an", "ant", ".", ",", "é", "ne", "nest"]
    pieces += [(w, -2.0 - 0.37 * i, 1) for i, w in enumerate(words)]
    spec = [(1, message((1, p), (2, s), (3, k))) for p, s, k in pieces]
    trainer = message((3, 1), (35, int(byte_fallback)), (40, 0), (41, 1), (42, 2), (43, (1 << 64) - 1))
    normal = message((1, "identity"), (3, int(dummy_prefix)), (4, int(squeeze)), (5, 1))
    return message(*spec, (2, trainer), (3, normal))


@pytest.mark.parametrize("fallback,prefix,squeeze", [(True, True, False), (False, True, False),
                                                     (True, False, False), (True, True, True)])
def test_unigram_models(tmp_path, fallback, prefix, squeeze):
    raw = unigram_model(fallback, prefix, squeeze)
    path = tmp_path / "u.model"
    path.write_bytes(raw)
    codec, ref = sp.Codec(str(path)), sentencepiece.SentencePieceProcessor(model_proto=raw)
    assert codec.model.kind == sp.UNIGRAM and codec.model.byte_fallback == fallback
    texts = ["the rest in a nest", " the  rest ", "", "antérest, in.", "x the y", "a\nnest", "日本 the", "thethethe"]
    for t, (ids, _, _) in zip(texts, codec.encode(texts)):
        assert list(ids) == ref.encode(t), t
    plain = ["the rest in a nest", "a nest, the ant.", "inerest"]
    for t, (ids, parity, trip) in zip(plain, codec.encode(plain)):
        assert parity and trip and codec.decode([list(ids)]) == [t]


@settings(max_examples=300, deadline=None)
@given(TEXT)
def test_bpe_model_parity_random(t):
    codec = sp.codec()
    (ids, parity, _), = codec.encode([t])
    assert list(ids) == codec_reference().encode(t)
    assert parity or "▁" in t


def codec_reference(cache={}):
    if not cache:
        cache["ref"] = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(sp.MODEL))
    return cache["ref"]


def test_sentencepiece_on_all_documents(docs):
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    got = sp.codec_report(docs).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = np.array(codec_reference().encode(texts[r.doc_id]), "<u4")
        assert (r.n_tokens, r.ids_crc32) == (len(ids), zlib.crc32(ids.tobytes()))
        assert r.parity and r.round_trip
    back = sp.decode_documents(sp.encode_documents(docs)).collect()
    assert {r.doc_id: r.text for r in back} == texts


def test_sentencepiece_awkward_and_empty(awkward, empty):
    got = sp.codec_report(awkward).collect()
    want = {r.doc_id: len(codec_reference().encode(r.text or "")) for r in awkward.collect()}
    assert len(got) == awkward.count() and {r.doc_id: r.n_tokens for r in got} == want
    assert {r.n_tokens for r in got if r.doc_id in (1, 2)} == {0}
    assert sp.codec_report(empty).count() == 0


@settings(max_examples=500, deadline=None)
@given(TEXT)
def test_word_encoder_random(t):
    path = public_tokenizers.path(token_orc.VOCABULARY)
    assert list(token_orc.encode_texts([t], path)[0]) == whole(path).encode(t, add_special_tokens=False).ids


def whole(path, cache={}):
    if path not in cache:
        cache[path] = Tokenizer.from_file(path)
    return cache[path]


@pytest.mark.parametrize("t", ["<|endoftext|> a<|endoftext|>b", "H̱ ẖ İ", "don't 's'sa .'s a.'re",
                               "A.B.C a..b 1a2 ß÷é.", "ÀÉ À", "ﬁ İ ſ K", "Word. ẃord. word' it's. x<| <|endoftext|. a\x00 b\x7f É. É̂.", "a" * 500 + "." + "b" * 500])
def test_word_encoder_cases(t):
    path = public_tokenizers.path(token_orc.VOCABULARY)
    for _ in range(2):
        assert list(token_orc.encode_texts([t], path)[0]) == whole(path).encode(t, add_special_tokens=False).ids


def test_chunk_store_survives_clearing():
    path = public_tokenizers.path(token_orc.VOCABULARY)
    enc = token_orc.WordEncoder(path)
    enc.MOST, enc.store.most = 20, 20
    rng = np.random.default_rng(1)
    for _ in range(30):
        texts = [" ".join("".join(rng.choice(list("abcde."), rng.integers(1, 90))) for _ in range(12)) for _ in range(4)]
        for t, ids in zip(texts, enc.store.texts([enc.split(t) for t in texts])):
            assert list(ids) == whole(path).encode(t, add_special_tokens=False).ids


def test_words_and_their_signs_are_stored_apart():
    path = public_tokenizers.path(token_orc.VOCABULARY)
    enc = token_orc.WordEncoder(path)
    texts = ["", "unread", " Word, word. \tWORD!? ", "H\u0331i, a<|endoftext|>b", "(word)-word's \u00e9t\u00e9.", "x1.5,y", ""]
    got = enc.column(pa.array(["unread"] + texts)[2:])
    assert [list(x) for x in got] == [whole(path).encode(t, add_special_tokens=False).ids for t in texts[1:]]
    enc.store.clear()
    enc.column(pa.array(["Word, word. word! word"]))
    assert enc.store.row.keys() - {b""} == {b"word", b",", b".", b"!"}
    assert enc.column(pa.array([], pa.string())) == []


def test_word_store_is_bounded_under_many_distinct_words():
    path = public_tokenizers.path(token_orc.VOCABULARY)
    enc = token_orc.WordEncoder(path)
    held = 0
    for a in range(0, 400_000, 40_000):
        words = [f"w{i:x}" for i in range(a, a + 40_000)]
        ids, = enc.column(pa.array([" ".join(words)]))
        held = max(held, len(enc.store.row))
    assert held <= 300_000
    assert list(ids[-40:]) == whole(path).encode(" ".join(words), add_special_tokens=False).ids[-40:]


def test_tokens_limit_the_bytes_of_a_batch(spark, workdir):
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.getAll.get(name)
    docs = spark.range(0, 3000, 1, 1).selectExpr("id as doc_id", "concat(repeat('the cat and the dog ', 150), id) as text")
    try:
        spark.conf.unset(name)
        want = {(r.doc_id, r.n_tokens, r.ids_crc32)
                for r in token_orc.tokens_report(spark, docs, f"{workdir}/orc").collect()}
        assert len(want) == 3000
        assert spark.conf.get(name) == str(SLICE_BYTES)
        spark.conf.set(name, 8 * SLICE_BYTES)           # the caller's own limit stays
        got = {(r.doc_id, r.n_tokens, r.ids_crc32)
               for r in token_orc.tokens_report(spark, docs, f"{workdir}/orc-2").collect()}
        assert spark.conf.get(name) == str(8 * SLICE_BYTES) and got == want
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def expected(rows):
    path = public_tokenizers.path(token_orc.VOCABULARY)
    out, start = [], 0
    for i, t in sorted(((r.doc_id, r.text or "") for r in rows), key=lambda x: (x[0] is not None, x[0] or 0, x[1])):
        ids = np.array([*whole(path).encode(t, add_special_tokens=False).ids, 1], "<u4")
        out.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_token_files(spark, docs, awkward, empty):
    for df in (docs, awkward):
        got = token_orc.tokens_report(spark, df).select("doc_id", "start", "n_tokens", "ids_crc32").collect()
        assert sorted(map(tuple, got), key=lambda x: x[1]) == expected(df.collect())
    assert token_orc.tokens_report(spark, empty).count() == 0


def test_token_files_are_sorted_pruned_and_indexed(spark, docs, tmp_path):
    path = str(tmp_path / "orc")
    token_orc.write_tokens(docs, path, ranges=4)
    files = sorted(glob.glob(f"{path}/part-*"))
    assert len(files) >= 2
    last = -1
    for f in files:
        ids = [r.doc_id for r in spark.read.orc(f).collect()]
        assert ids == sorted(ids) and ids[0] > last
        last = ids[-1]
    from pyarrow import orc
    assert sum(orc.ORCFile(f).nrows for f in files) == docs.count()
    # Bloom filters and row indexes lie in the stripes' index sections.
    plain = str(tmp_path / "plain")
    token_orc.encode_ranges(docs, ranges=4).write.option("orc.create.index", "true").orc(plain)

    def index_bytes(folder):
        jvm, total = spark._jvm, 0
        for f in glob.glob(f"{folder}/part-*"):
            reader = jvm.org.apache.orc.OrcFile.createReader(
                jvm.org.apache.hadoop.fs.Path(f),
                jvm.org.apache.orc.OrcFile.readerOptions(spark._jsc.hadoopConfiguration()))
            total += sum(x.getIndexLength() for x in reader.getStripes())
        return total
    assert index_bytes(path) > index_bytes(plain) > 0
    one = token_orc.read_tokens(spark, path).filter("doc_id = 17")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(doc_id,17)" in plan
    assert one.select(F.size("ids")).first()[0] == one.first().n_tokens
