"""Operators 11 to 13 against brute force, on awkward, empty and seam-heavy tables."""

import hashlib
import random
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from millrace.llm import centroids, packing, prefix_trie

SF = "/root/testdata/sf0.001"
TEXT = st.text(alphabet=st.one_of(st.sampled_from("aeinr st.,'\n\té \x85\xa0\x1c<|>-_0AÉ"), st.characters(
    exclude_categories=("Cs",))), max_size=60)


# -- 11: packing ----------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def encoder():
    return packing.ByteEncoder(public_tokenizers.path(packing.VOCABULARY))


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path(packing.VOCABULARY))


@settings(max_examples=400, deadline=None)
@given(st.lists(TEXT, min_size=1, max_size=4))
def test_ids_are_the_tokenizers(encoder, tokenizer, texts):
    for t, ids in zip(texts, encoder.encode(texts)):
        assert ids.tolist() == tokenizer.encode(t, add_special_tokens=False).ids


def test_ids_of_awkward_texts(encoder, tokenizer, awkward):
    texts = [r["text"] or "" for r in awkward.collect()] + [
        "a  b\n\nc", " lead", "trail ", "it's we'll.\nDon't!", "<|endoftext|> x<|endoftext|>\n", "\n", " ", "　 a"]
    for t, ids in zip(texts, encoder.encode(texts)):
        assert ids.tolist() == tokenizer.encode(t, add_special_tokens=False).ids


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 40), st.integers(1, 30)), max_size=12))
def test_a_plan_holds_every_piece_once(spec):
    counts = np.zeros(41, np.int64)
    for n, k in spec:
        counts[n] += k
    plan, held = packing.plan_sequences(counts), np.zeros(41, np.int64)
    for config, m in plan.items():
        assert sum(n * k for n, k in config) <= 40 and m > 0
        for n, k in config:
            held[n] += k * m
    assert (held == counts).all()
    # Never more than first fit decreasing could need.
    assert sum(plan.values()) <= 11 / 9 * -(-int((counts * np.arange(41)).sum()) // 40) + 6 + counts[21:].sum()


def test_price_is_the_best_knapsack():
    rng = np.random.default_rng(3)
    for _ in range(20):
        w = np.zeros(16)
        use = rng.choice(np.arange(1, 16), 4, replace=False)
        w[use] = rng.random(4)
        best = [0.0] * 16
        for j in range(1, 16):
            best[j] = max([best[j - 1]] + [best[j - n] + w[n] for n in use if n <= j])
        assert abs(sum(w[n] * k for n, k in packing.price(w)) - best[15]) < 1e-9


def packed(rows, texts, tokenizer, capacity):
    """Check rows against the texts (by id order is not given: as multisets); returns the sequences used."""
    by_doc = defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append((r["piece"], r["start"], r["length"], r["ids_crc32"]))
    want = defaultdict(list)
    for i, t in texts:
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 2]
        at, k, size = 0, 0, (len(ids) - 1) % capacity + 1
        while at < len(ids):
            part = np.array(ids[at:at + size], "<u4").tobytes()
            want[i].append((k, at, size, zlib.crc32(part)))
            at, k, size = at + size, k + 1, capacity
    assert {k: sorted(v) for k, v in by_doc.items()} == {k: sorted(v) for k, v in want.items()}
    seqs = defaultdict(list)
    for r in rows:
        seqs[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in seqs.values():
        at = 0
        for offset, n in sorted(places):
            assert offset == at
            at += n
        assert at <= capacity
    return len(seqs)


def test_packing_of_documents(spark, docs, tokenizer):
    rows = packing.pack(spark, docs).collect()
    used = packed(rows, [(r["doc_id"], r["text"]) for r in docs.collect()], tokenizer, 1024)
    assert used <= -(-sum(r["length"] for r in rows) // 1024) * 1.01 + 2


def test_packing_of_awkward_and_empty(spark, awkward, empty, tokenizer):
    rows = packing.pack(spark, awkward, capacity=64).collect()
    packed(rows, [(r["doc_id"], r["text"]) for r in awkward.collect()], tokenizer, 64)
    assert packing.pack(spark, empty).collect() == []


# -- 12: centroids --------------------------------------------------------------------------------

def lloyd(rows, k, rounds, dims):
    kept = [(i, [int(np.floor(256 * float(x))) for x in v]) for i, v in rows
            if v is not None and len(v) == dims and all(x is not None and np.isfinite(x) for x in v)]
    name = {None: ""}
    cents = [v for _, _, v in sorted((hashlib.sha256(f"2:{name.get(i, i)}".encode()).hexdigest(), v, v)
                                     for i, v in kept)[:k]]
    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(cents))
    for _ in range(rounds):
        groups = defaultdict(list)
        for _, v in kept:
            groups[nearest(v)[1]].append(v)
        for j, g in groups.items():
            cents[j] = [sum(col) // len(g) for col in zip(*g)]
    out = [(i, *reversed(nearest(v))) for i, v in kept]
    return sorted(out, key=repr), cents


@pytest.mark.parametrize("n,k", [(300, 7), (5, 7), (0, 7)])
def test_clusters_against_plain_lloyd(spark, n, k):
    rng = random.Random(n)
    rows = [(i, [rng.gauss(i % 3, 1) for _ in range(6)]) for i in range(n)]
    rows += [(1, rows[1][1]), (None, rows[0][1]), (2, rows[3][1])] if n > 10 else []      # repeated rows and ids
    rows += [(900, None), (901, [1.0] * 5), (902, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (903, [float("nan")] * 6),
             (904, [float("inf")] * 6), (905, [])]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows],
                               "vec_id long, embedding array<double>, cluster int, chunk long").repartition(5)
    found, cents = centroids.cluster(spark, df, clusters=k, rounds=3, dimensions=6, block=4)
    want, plain = lloyd(rows, k, 3, 6)
    assert sorted((tuple(r) for r in found.collect()), key=repr) == want
    assert cents.tolist() == plain or not n


def test_components_out_of_range_stop(spark):
    df = spark.createDataFrame([(1, [1e30] * 64)], "vec_id long, embedding array<float>")
    with pytest.raises(Exception, match="too large"):
        centroids.cluster_report(spark, df).collect()


def test_cluster_report_matches_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF}/embeddings.parquet'")
    got = centroids.cluster_report(spark, spark.read.parquet(f"{SF}/embeddings.parquet"))
    want = con.execute(centroids.SQL)
    assert [c[0] for c in want.description] == got.columns
    assert sorted(tuple(r) for r in got.collect()) == sorted(want.fetchall())


# -- 13: prefix trie ------------------------------------------------------------------------------

def trie(rows):
    """Rows (conv_id, turn, role, text) -> the contract's nodes, the plain way."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            h = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            own[c].append((turn is not None, turn or 0, h, role, text))
    turns = {c: [(r, t) for *_, r, t in sorted(v)] for c, v in own.items()}
    full = {}
    for c, v in turns.items():
        h = zlib.crc32(str(c).encode()) % 4
        full[c] = turns.get(c - c % 20, [])[:h] + v[h:]
    members, ends = defaultdict(list), defaultdict(list)
    for c, v in full.items():
        for d in range(len(v) + 1):
            members[tuple(v[:d])].append(c)
        ends[tuple(v)].append(c)
    kids = defaultdict(list)
    for k in members:
        if k:
            kids[k[:-1]].append(k)
    out, done = [], {}
    for k in sorted(members, key=len, reverse=True):
        words = len([w for w in k[-1][1].translate({c: " " for c in range(9, 14)}).split(" ") if w]) if k else 0
        leaves = sum(done[c][0] for c in kids[k]) or 1
        saved = sum(done[c][1] for c in kids[k]) + (len(members[k]) - 1) * words
        done[k] = leaves, saved
        sha = hashlib.sha256(",".join(map(str, sorted(ends[k]))).encode()).hexdigest()
        out.append((min(members[k]), len(k), min(members[k[:-1]]) if k else None, len(members[k]), len(kids[k]),
                    leaves, saved, sha))
    return sorted(out, key=repr)


def built(spark, rows, partitions=None):
    df = spark.createDataFrame([(*r, 1, "x") for r in rows],
                               "conv_id long, turn long, role string, text string, depth int, key string")
    was = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions or was))
    try:
        return sorted((tuple(r) for r in prefix_trie.build_trie(spark, df).collect()), key=repr)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", was)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


@pytest.mark.parametrize("seed,partitions", [(1, 1), (2, 5), (3, 16), (4, 40)])
def test_trie_against_brute_force(spark, seed, partitions):
    rng = random.Random(seed)
    rows = []
    for c in range(120):
        n = rng.choice([1, 2, 3, 5, 9, 30])
        rows += [(c, t, rng.choice(["user", None]), rng.choice(["a b", "c", None, " "]) if t < 6 else "same again")
                 for t in range(n)]
    assert built(spark, rows, partitions) == trie(rows)


def test_trie_of_awkward_rows(spark):
    deep = [(40, t, "u", f"w{t % 3} x") for t in range(400)]
    rows = [*deep, *((41, *r[1:]) for r in deep), *((42, *r[1:]) for r in deep[:200]), *((43, *r[1:]) for r in deep[:399]),
            (None, 0, "u", "lost"), (1, None, "u", "null turn"), (1, None, None, "tie"), (1, 0, "u", "x"),
            (1, 0, "u", "x"), (7, 5, "", "y"), (2, 1, "u", "long " * 50_000), (-5, 0, "u", "x"), (25, 0, "u", "z")]
    # A third of all conversations are copies; ids span many blocks.
    rows += [(5000 + 20 * i, t, "u", f"hot {t}") for i in range(900) for t in range(2)]
    got = built(spark, rows, 7)
    plain = [r for r in rows if r[0] is None or r[0] >= 0]
    minus = [r for r in rows if r[0] == -5]         # its group's first is 0 by the sign of %; it has no rows
    assert len(got) == len(trie([*plain, *minus]))
    assert built(spark, plain, 7) == trie(plain)
    assert built(spark, []) == []


def test_trie_matches_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{SF}/conversations.parquet'")
    got = prefix_trie.build_trie(spark, spark.read.parquet(f"{SF}/conversations.parquet"))
    want = con.execute(prefix_trie.SQL)
    names = [c[0] for c in want.description]
    assert names == got.columns
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want.fetchall(), key=repr)
