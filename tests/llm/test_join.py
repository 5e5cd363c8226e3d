"""Operator 3 against brute force: signatures, the T-occurrence search, and whole components."""

import random

import numpy as np

import duckdb

from millrace.llm import ngram_join as nj
from millrace.llm._batches import id_and_text
from millrace.session import fresh_dir


def brute(sets):
    """Components (by position) of sets with 100 |A & B| >= 80 |A | B|."""
    parent = list(range(len(sets)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                x, y = root(i), root(j)
                parent[max(x, y)] = min(x, y)
    return [root(i) for i in range(len(sets))]


def words_sets(texts):
    out = []
    for t in texts:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
        for c in "\t\n\x0b\x0c\r":
            low = low.replace(c, " ")
        w = [x for x in low.split(" ") if x]
        out.append({tuple(w)} if 0 < len(w) < 5 else {tuple(w[i:i + 5]) for i in range(len(w) - 4)})
    return out


def check(spark, rows, **kw):
    """rows: (doc_id, text) with distinct ids."""
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in nj.link_components(spark, df).collect()}
    rows = sorted(rows)
    sets = words_sets([t for _, t in rows])
    want = {rows[i][0]: (len(sets[i]), rows[c][0]) for i, c in enumerate(brute(sets))}
    assert got == want
    return want


def test_signatures_are_shared_by_every_link():
    rng = np.random.default_rng(0)
    for trial in range(3000):
        n = int(rng.integers(1, 120)) if trial % 3 else int(rng.integers(1, 14))
        base = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64) * np.uint64(2))
        drop = int(rng.integers(0, max(1, len(base) // 5) + 1))
        a = np.delete(base, rng.choice(len(base), min(drop, len(base) - 1), replace=False))
        extra = rng.integers(0, 1 << 63, int(rng.integers(0, max(1, n // 5) + 1))).astype(np.uint64)
        b = np.unique(np.concatenate([base, extra]))
        common = len(np.intersect1d(a, b))
        if 100 * common < 80 * (len(a) + len(b) - common):
            continue
        hot = np.sort(rng.choice(base, int(rng.integers(0, len(base) + 1)), replace=False))
        for seed in range(3):           # whatever the order, of which both leave the last
            kept = []
            for x in (a, b):
                sig, spare = nj.signatures(x, hot)
                order = np.argsort(nj._mix(sig + np.uint64(seed)))
                leave = set()
                for code, number in spare:
                    own = [i for i in order.tolist() if int(sig[i]) >> 61 == code]
                    leave |= set(own[len(own) - number:])
                kept.append(np.delete(sig, sorted(leave)))
            assert np.intersect1d(*kept).size, (len(a), len(b))


def test_divide_skip_is_exact():
    rng = np.random.default_rng(1)
    for _ in range(400):
        pool = np.unique(rng.integers(0, 1 << 60, 60).astype(np.uint64))
        sets = [np.sort(rng.choice(pool, int(rng.integers(1, 50)), replace=False)) for _ in range(int(rng.integers(1, 40)))]
        core = np.sort(rng.choice(pool, 40, replace=False))
        sets += [np.sort(np.delete(core, rng.choice(40, int(rng.integers(0, 12)), replace=False))) for _ in range(20)]
        want = []
        for i, s in enumerate(sets):
            c = len(np.intersect1d(core, s))
            if 100 * c >= 80 * (len(core) + len(s) - c):
                want.append((i, c))
        assert sorted(nj.divide_skip(core, sets)) == want


def test_word_hashes_tell_words_apart_wherever_they_stand(monkeypatch):
    rng = np.random.default_rng(6)
    words = sorted({bytes(rng.integers(97, 100, int(rng.integers(1, 9))).astype(np.uint8)) for _ in range(3000)}
                   | {"é".encode(), "日本".encode(), b"\x00", b"\x00\x00", b"x" * 5000})
    one = {w: int(nj.word_hashes(w)[0]) for w in words}
    assert len(set(one.values())) == len(words)
    for size in (nj.SEGMENT, 7):
        monkeypatch.setattr(nj, "SEGMENT", size)
        order = rng.permutation(len(words))
        text = b" \n\t".join(words[i] for i in order) + b"\r"
        assert [int(h) for h in nj.word_hashes(b"\x0b" + text)] == [one[words[i]] for i in order]
    assert len(nj.word_hashes(b"")) == len(nj.word_hashes(b" \n ")) == 0


def test_sketches_never_rule_out_a_link():
    rng = np.random.default_rng(3)
    ruled_out = 0
    for _ in range(2000):
        n = int(rng.integers(1, 400))
        a = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
        b = np.unique(np.concatenate([rng.choice(a, int(rng.integers(1, len(a) + 1)), replace=False),
                                      rng.integers(0, 1 << 63, int(rng.integers(0, n // 4 + 2))).astype(np.uint64)]))
        common = len(np.intersect1d(a, b))
        ok = nj.may_link(len(a), nj.sketch(a), len(b), nj.sketch(b))
        if 100 * common >= 80 * (len(a) + len(b) - common):
            assert ok
        ruled_out += not ok
    assert ruled_out > 1000


def test_all_documents_against_sql(spark, docs):
    con = duckdb.connect()
    con.register("documents", docs.select("doc_id", "text").toArrow())
    want = sorted(con.execute(nj.SQL).fetchall())
    got = nj.link_components(spark, docs).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, got)) == want


def test_groups_chains_and_shared_passages(spark):
    rng = np.random.default_rng(2)
    vocab = ["".join(rng.choice(list("abcdefgh"), 6)) for _ in range(3000)]
    prose = lambda n: [str(w) for w in rng.choice(vocab, n)]
    passage, rows = prose(60), []
    add = lambda w: rows.append((len(rows) + 100, " ".join(w)))
    base = prose(150)
    for _ in range(200):                                   # near copies of one text, also among themselves
        w = list(base)
        for i in rng.choice(150, int(rng.integers(0, 7)), replace=False):
            w[i] = str(rng.choice(vocab))
        add(w)
    for _ in range(40):                                    # exact copies
        add(base)
    chain = prose(200)
    for i in range(30):                                    # each similar to the next only
        chain = chain[7:] + prose(7)
        add(chain)
    for _ in range(150):                                   # unrelated texts with one passage
        add(prose(int(rng.integers(20, 120))) + passage + prose(int(rng.integers(20, 120))))
    for _ in range(60):                                    # mostly passage: links among them by chance
        add(passage + prose(int(rng.integers(0, 20))))
    for n in (1, 2, 4, 5, 6, 9):                           # short ones, upper case
        w = prose(n)
        add(w)
        add([x.upper() for x in w])
        add(w + prose(1))
    want = check(spark, rows)
    assert len({c for _, c in want.values()}) < len(rows) - 200


def test_small_blocks_and_buckets(spark, monkeypatch):
    monkeypatch.setattr(nj, "BLOCK", 7)
    monkeypatch.setattr(nj, "BUCKET_ENTRIES", 50)
    test_groups_chains_and_shared_passages(spark)


def test_buckets_sorted_in_shares_give_the_same_groups(spark, docs, monkeypatch):
    packed = nj._packed_signatures(id_and_text(docs), np.zeros(0, np.uint64), 2).cache()
    whole = sorted(map(tuple, nj._groups(packed, 2).collect()), key=str)
    monkeypatch.setattr(nj, "SORTED", 1000)
    assert whole and sorted(map(tuple, nj._groups(packed, 2).collect()), key=str) == whole
    packed.unpersist()


def test_all_links_and_their_number(spark, empty, monkeypatch):
    rng = np.random.default_rng(4)
    vocab = ["".join(rng.choice(list("abcdefgh"), 6)) for _ in range(2000)]
    prose = lambda n: [str(w) for w in rng.choice(vocab, n)]
    base, chain, texts = prose(150), prose(200), ["", None, "one two", "One two"]
    for _ in range(60):                                    # near copies; most of them link with one another
        w = list(base)
        for i in rng.choice(150, int(rng.integers(0, 5)), replace=False):
            w[i] = str(rng.choice(vocab))
        texts.append(" ".join(w))
    for _ in range(12):
        chain = chain[7:] + prose(7)
        texts += [" ".join(chain)] * int(rng.integers(1, 4))
    texts += [" ".join(prose(40)) for _ in range(20)]
    sets = words_sets(texts)
    links = [(i, j) for i, a in enumerate(sets) for j, b in enumerate(sets)
             if i != j and a and b and 100 * len(a & b) >= 80 * len(a | b)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    for block in (nj.BLOCK, 7):
        monkeypatch.setattr(nj, "BLOCK", block)
        found, members = nj.all_links(spark, df)
        of = {r.doc_id: r.fp for r in members.collect()}
        got = [(r.u, r.v) for r in found.collect()]
        assert len(got) == len(set(got))
        assert set(got) == {(of[i], of[j]) for i, j in links if of[i] < of[j]}
    counts = {r.doc_id: (r.n_shingles, r.n_links) for r in nj.link_counts(spark, df).collect()}
    assert counts == {i: (len(s), sum(x == i for x, _ in links)) for i, s in enumerate(sets)}
    assert max(n for _, n in counts.values()) > 20
    assert nj.link_counts(spark, empty).count() == 0


def test_awkward_and_empty(spark, awkward, empty):
    rows = nj.link_components(spark, awkward).collect()
    assert len(rows) == awkward.count()
    by = {r.doc_id: r for r in rows}
    assert {by[i].n_shingles for i in (1, 2, 3)} == {0}
    assert [by[i].component_id for i in (1, 2, 3)] == [1, 2, 3]
    assert {by[i].component_id for i in (4, 5)} == {4} and sum(r.doc_id == 5 for r in rows) == 2
    assert {by[i].component_id for i in (7, 12)} == {7}
    assert by[None].component_id is None
    assert nj.link_components(spark, empty).count() == 0
    nulls = spark.createDataFrame([(None, "a b c d e f"), (None, "a b c d e f"), (9, "A b c d e f")],
                                  "doc_id long, text string")
    assert {r.component_id for r in nj.link_components(spark, nulls).collect()} == {9}


def test_templates_that_do_not_link_make_few_pairs(spark):
    """Texts that share 120 of 150 words, none linked: candidates grow with the texts, not their pairs."""
    made = {}
    for n in (300, 600):
        rng = random.Random(5)
        base = [f"t{i}" for i in range(120)]
        rows = [(i, " ".join(base + [f"p{rng.randrange(10 ** 9)}" for _ in range(30)])) for i in range(n)]
        docs = id_and_text(spark.createDataFrame(rows, "doc_id long, text string"))
        root = fresh_dir(spark, "templates")
        nodes, groups, one = nj._prepared(spark, docs, root)
        made[n] = groups.count()
        out = nj.link_components(spark, docs).collect()
        assert {r["component_id"] for r in out} == set(range(n))
    assert made[600] <= 2.5 * made[300] + 600


def test_chains_of_near_copies_with_many_pivots(spark):
    """Edited copies of edited copies: most do not link with any one pivot; components are brute force's."""
    rng = random.Random(9)
    rows, i = [], 0
    for family in range(4):
        words = [f"f{family}w{k}" for k in range(90)]
        for _ in range(60):
            words = list(words)
            for _ in range(rng.choice([1, 1, 2, 4])):
                words[rng.randrange(len(words))] = f"x{rng.randrange(10 ** 6)}"
            rows.append((i, " ".join(words)))
            i += 1
    got = {r["doc_id"]: r["component_id"] for r in nj.link_components(
        spark, spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()}
    sets = {k: set(nj.shingle_set(t).tolist()) for k, t in rows}
    root = {k: k for k in sets}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k
    for a in sets:
        for b in range(a):
            if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    assert got == {k: find(k) for k in sets}


def test_both_ways_to_components(spark):
    rng = random.Random(3)
    links = [(rng.randrange(400), rng.randrange(400)) for _ in range(300)]
    links = [(max(x), min(x)) for x in links if x[0] != x[1]]
    df = spark.createDataFrame(links, "u long, v long")
    one = nj.components(spark, df, fresh_dir(spark, "c"), "one").collect()
    stars = nj.components(spark, df, fresh_dir(spark, "c"), "stars", one_task=0).collect()
    assert sorted(map(tuple, one)) == sorted(map(tuple, stars))
    assert nj.components(spark, df.limit(0), fresh_dir(spark, "c"), "none").collect() == []
