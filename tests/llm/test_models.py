"""Operators 6, 7 and 9: held-out accuracy, brute force, and awkward tables."""

import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from millrace.llm import byte_cnn, decontaminate, rank_profiles


def test_language_held_out_accuracy(docs):
    want = {r.doc_id: r.lang for r in docs.collect()}
    got = rank_profiles.identify(docs).collect()
    assert len(got) == len(want)
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1
    held = [r for r in got if r.held_out]
    assert np.mean([r.lang_pred == want[r.doc_id] for r in held]) > 0.95


def naive_grams(text):
    low = "".join(c.lower() if c.isalpha() and len(c.lower()) == 1 else c if c.isalpha() else " " for c in text)
    out = Counter()
    for w in low.split():
        p = f" {w} "
        for n in (1, 2, 3):
            out.update(g for i in range(len(p) - n + 1) if (g := p[i:i + n]).strip())
    return out


def naive_predict(text, profiles):
    grams = naive_grams(text)
    if not grams or not profiles:
        return rank_profiles.UNKNOWN, 0.0
    own = sorted(grams, key=lambda g: (-grams[g], len(g), g))[:rank_profiles.PROFILE]
    best = None
    for lang in sorted(profiles):
        place = {g: i for i, g in enumerate(profiles[lang])}
        d = sum(abs(place[g] - i) if g in place else rank_profiles.PROFILE for i, g in enumerate(own))
        if best is None or d < best[0]:
            best = (d, lang)
    return best[1], 1 - best[0] / (rank_profiles.PROFILE * len(own))


def test_language_against_brute_force(docs):
    rows = [r for r in docs.collect()]
    train = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 3 != 1 and r.lang is not None and r.text]
    counts = {}
    for r in train:
        counts.setdefault(r.lang, Counter()).update(naive_grams(r.text))
    want = {k: sorted(c, key=lambda g: (-c[g], len(g), g))[:rank_profiles.PROFILE] for k, c in counts.items()}
    profiles = rank_profiles.fit_profiles(docs)
    assert profiles == want
    texts = [r.text for r in rows[:60]] + ["", "123 ?!", "Ünïcödé 日本語 İstanbul ſ", "a", "x" * 5000]
    got = rank_profiles.predict_texts(texts, profiles)
    for t, (lang, score, _) in zip(texts, got):
        w = naive_predict(t, profiles)
        assert (lang, round(score, 9)) == (w[0], round(w[1], 9))


def test_language_awkward_and_empty(awkward, empty):
    got = rank_profiles.identify(awkward).collect()
    assert len(got) == awkward.count()
    by = {r.doc_id: r for r in got}
    for i in (1, 2, 3, 6, 9, 10):
        assert (by[i].lang_pred, by[i].score) == ("und", 0.0)
    assert by[None].held_out
    assert rank_profiles.identify(empty).count() == 0
    no_lang = awkward.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in rank_profiles.identify(no_lang).collect()} == {"und"}


def test_classifier_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    want = {r.doc_id: r.quality for r in labels.collect()}
    got = byte_cnn.classify(docs, labels).collect()
    assert len(got) == docs.count()
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    held = [(r.score, want[r.doc_id]) for r in got if r.held_out and r.doc_id in want]
    one, zero = [s for s, y in held if y == 1], [s for s, y in held if y == 0]
    assert np.mean([a > b for a in one for b in zero]) > 0.9
    assert np.mean([s >= 0.3 for s in one]) > 0.95


def naive_score(net, text):
    data = text.encode("utf-8")
    n = max(1, -(-max(0, len(data) - byte_cnn.WIDTH) // byte_cnn.STEP) + 1)
    data += bytes((n - 1) * byte_cnn.STEP + byte_cnn.WIDTH - len(data)) if len(data) < (n - 1) * byte_cnn.STEP + byte_cnn.WIDTH else b""
    r = np.array([sum(net.table[j][data[p * byte_cnn.STEP + j]].astype(float) for j in range(byte_cnn.WIDTH)) + net.bias
                  for p in range(n)])
    halves = range(0, n, byte_cnn.HALF)
    spans = [(a, min(n, a + 2 * byte_cnn.HALF)) for a in halves][:max(1, len(halves) - 1)]
    z = np.mean([np.maximum(r[a:b].max(0), 0) @ net.out for a, b in spans]) + net.const
    return 1 / (1 + np.exp(-z))


def test_network_covers_whole_texts():
    rng = np.random.default_rng(2)
    net = byte_cnn.Network.start()
    texts = ["", "a", "abcdefgh", "abcdefghi", "é" * 50] + \
        ["".join(chr(c) for c in rng.integers(32, 400, n)) for n in (100, 2047, 2056, 4096, 9000, 70_000)]
    got = byte_cnn.score_texts(net, texts)
    for t, s in zip(texts, got):
        assert abs(s - naive_score(net, t)) < 1e-4
        assert abs(s - byte_cnn.score_text(net, t)) < 1e-6
    big = "".join(chr(c) for c in rng.integers(32, 127, 700_000))
    assert abs(byte_cnn.score_text(net, big) - naive_score(net, big)) < 1e-4


def test_scores_keep_the_share_of_the_table_when_the_sample_is_bounded(spark, monkeypatch):
    rng = np.random.default_rng(8)
    rows = [(i, "".join(rng.choice(list("abcdefgh "), 200)), int(i % 10 > 0)) for i in range(1200)]
    df = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    means = []
    for most in (byte_cnn.FIT_ROWS, 60):                   # texts say nothing: scores are about the share, 0.9
        monkeypatch.setattr(byte_cnn, "FIT_ROWS", most)
        monkeypatch.setattr(byte_cnn, "EPOCHS", 2)
        got = byte_cnn.classify(df, df).collect()
        means.append(np.mean([r.score for r in got]))
        assert np.mean([r.predicted for r in got]) > 0.95
    assert min(means) > 0.8 and abs(means[0] - means[1]) < 0.1


def test_one_class_in_the_sample_gives_the_share_of_the_table():
    net = byte_cnn.train(["a", "b"], [1, 1], (3, 9))
    assert abs(byte_cnn.score_text(net, "a") - 10 / 14) < 1e-6


def test_classifier_awkward_and_empty(spark, awkward, empty, labels):
    none = spark.createDataFrame([], "doc_id long, quality int, score double")
    assert {r.score for r in byte_cnn.classify(awkward, none).collect()} == {0.5}
    mixed = spark.createDataFrame([(4, 1), (4, 0), (7, 0), (None, 1), (13, 0), (11, 1), (6, None)],
                                  "doc_id long, quality int")
    got = byte_cnn.classify(awkward, mixed).collect()
    assert len(got) == awkward.count() and all(0 <= r.score <= 1 for r in got)
    assert byte_cnn.classify(empty, labels).count() == 0


def naive_align(a, b):
    h = np.zeros((len(a) + 1, len(b) + 1), int)
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            s = decontaminate.MATCH if a[i - 1] == b[j - 1] else decontaminate.MISMATCH
            h[i, j] = max(0, h[i - 1, j - 1] + s, h[i - 1, j] + decontaminate.GAP, h[i, j - 1] + decontaminate.GAP)
    return int(h.max())


def test_alignment_scores():
    rng = np.random.default_rng(4)
    for _ in range(300):
        a, b = rng.integers(0, 4, rng.integers(1, 12)), rng.integers(0, 4, rng.integers(1, 20))
        score, equal, s, e = decontaminate.align(a, b)
        assert score == naive_align(a, b)
        assert score == naive_align(a, b[s:e]) and equal <= min(len(a), e - s)


def test_decontamination_against_brute_force(docs, benchmark):
    """Every pair that reaches the thresholds in a full alignment is found, and no other."""
    items = {r.item_id: decontaminate.words_of(r.text or "") for r in benchmark.collect()}
    texts = {r.doc_id: decontaminate.words_of(r.text or "") for r in docs.collect()}
    number = {}
    code = lambda w: np.array([number.setdefault(x, len(number)) for x in w])
    items = {k: code(w) for k, w in items.items()}
    texts = {k: code(w) for k, w in texts.items()}
    want = set()
    for d, x in texts.items():
        for i, q in items.items():
            if len(q) < 3 or len(np.intersect1d(x, q)) < 0.4 * len(np.unique(q)):
                continue
            score, equal, _, _ = decontaminate.align(q, x)
            if equal >= decontaminate.needed_words(len(q)) and score >= decontaminate.SCORE * decontaminate.MATCH * len(q):
                want.add((d, i))
    got = decontaminate.contaminated(docs, benchmark).collect()
    assert {(r.doc_id, r.item_id) for r in got} == want and len(got) == len(want)
    left = {r.doc_id for r in decontaminate.drop_contaminated(docs, benchmark).collect()}
    assert left == set(texts) - {d for d, _ in want}


def test_decontamination_edited_copies_hot_items_and_blocks(spark, monkeypatch):
    rng = np.random.default_rng(9)
    word = lambda: "".join(rng.choice(list("abcdefghij"), 5))
    vocab = [word() for _ in range(400)]
    prose = lambda n: " ".join(rng.choice(vocab, n))
    items = [prose(40) for _ in range(6)] + ["", None, "two words"]
    edited = items[1].split()
    for i in (3, 17, 30):
        edited[i] = "changed"
    del edited[10]
    rows = [(i, f"{prose(30)} {items[0]} {prose(30)}") for i in range(300)]
    rows += [(1000, f"{prose(50)} {' '.join(edited)} {prose(9)}"), (1001, prose(300)), (1002, None), (1003, ""),
             (1004, f"{items[2].upper()}!"), (1005, f"{prose(20)} {items[3]} {prose(20)} {items[3]}")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    want = {(i, 0) for i in range(300)} | {(1000, 1), (1004, 2), (1005, 3)}
    for size in (decontaminate.BLOCK_BYTES, 500):
        monkeypatch.setattr(decontaminate, "BLOCK_BYTES", size)
        got = decontaminate.contaminated(docs, bench).collect()
        assert {(r.doc_id, r.item_id) for r in got} == want
        assert {r.doc_id: r.places for r in got}[1005] == 2
        assert {r.doc_id for r in decontaminate.drop_contaminated(docs, bench).collect()} == {1001, 1002, 1003}


def test_decontamination_excerpts_of_long_items():
    """Excerpts are found whatever the item's length, exactly those that reach the strict score."""
    rng = np.random.default_rng(12)
    prose = lambda n: [f"w{v}" for v in rng.zipf(1.4, n) % 5000]
    items = [prose(n) for n in (200, 59, 120, 1000)]
    texts = []
    for q in items:
        for n in (11, 12, 13, 14, 17, 20, 30, 50):
            for edits in range(4):
                at = int(rng.integers(0, len(q) - n))
                part = list(q[at:at + n])
                for i in rng.choice(n, edits, replace=False):
                    part[i] = "edited" if rng.random() < 0.6 else ""
                texts.append(" ".join(prose(40) + part + prose(25)))
    texts.append(" ".join(prose(30) + items[0][40:140] + prose(30)))
    block = decontaminate.Items.of([(i, " ".join(q)) for i, q in enumerate(items)])
    get = lambda t: np.array([block.number.get(w, 0) for w in decontaminate.words_of(t)])
    counts = np.bincount(np.concatenate([get(t) for t in texts]), minlength=len(block.number) + 1)
    seeds = decontaminate.rare_seeds(block, counts, int(counts.sum()))
    new = 0
    for t in texts:
        x, got = get(t), {r[0] for r in decontaminate.find_items(t, seeds)}
        for i, q in enumerate(block.words):
            strict = decontaminate.align(q, x, decontaminate.EDIT, decontaminate.EDIT)[0] >= 13 * decontaminate.MATCH
            score, equal, _, _ = decontaminate.align(q, x)
            whole = equal >= decontaminate.needed_words(len(q)) and score >= 0.5 * decontaminate.MATCH * len(q)
            assert (i in got) == (strict or whole), (i, t)
            new += strict and not whole
    assert new > 30
    assert decontaminate.find_items(texts[-1], seeds)[0][2] >= 100


def test_decontamination_short_items_may_miss_a_word_by_a_rare_seed():
    block = decontaminate.Items.of([(0, "alpha bravo charlie delta echo foxtrot golf"), (1, "one two three four five"),
                                    (2, "kilo lima mike")])
    counts = np.full(len(block.number) + 1, 10)
    rare, common = (decontaminate.rare_seeds(block, counts, n) for n in (1_000_000_000, 1000))
    text = "x alpha bravo charlie changed echo foxtrot golf y one two three four six z kilo lima nine"
    assert [r[0] for r in decontaminate.find_items(text, rare)] == [0, 1]
    assert decontaminate.find_items(text, common) == []
    whole = "x alpha bravo charlie delta echo foxtrot golf y one two three four five z kilo lima mike"
    assert [r[0] for r in decontaminate.find_items(whole, common)] == [0, 1, 2]


def test_decontamination_awkward_and_empty(spark, awkward, empty, benchmark):
    assert decontaminate.contaminated(awkward, benchmark).count() == 0
    assert decontaminate.contaminated(empty, benchmark).count() == 0
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contaminated(awkward, none).count() == 0
    kept = decontaminate.drop_contaminated(awkward, none)
    assert kept.columns == awkward.columns and kept.count() == awkward.count()


def test_short_items_as_they_stand_and_edited():
    items = decontaminate.Items.of([(1, "foo bar"), (2, "solo"), (3, "alpha beta gamma delta"),
                                    (4, "one two three four five"), (5, ""), (6, None)])
    counts = np.array([10 ** 7] + [1] * len(items.number))
    seeds = decontaminate.rare_seeds(items, counts, 10 ** 7)
    for text, found in [("foo bar in FOO, bar", [(0, 2, 2)]), ("bar foo", []), ("Solo. solo", [(1, 1, 2)]), ("", []),
                        ("alpha X gamma delta", [(2, 3, 1)]), ("one two X four five", [(3, 4, 1)]),
                        ("alpha Y Z delta", [])]:
        assert [(f[0], f[2], f[5]) for f in decontaminate.find_items(text, seeds)] == found


def test_long_items_need_little_memory_and_clashing_text_columns(spark):
    import tracemalloc
    rng = np.random.default_rng(4)
    item = rng.integers(1, 5000, 6000)
    tracemalloc.start()
    score, equal, s, e = decontaminate.align(item, np.concatenate([item[:3000], [0], item[3001:], item[:900]]))
    assert (equal, s, e) == (5999, 0, 6000)
    assert tracemalloc.get_traced_memory()[1] < 60 << 20         # the matrix has 165 MB
    tracemalloc.stop()
    words = " ".join(f"w{i}" for i in range(30))
    docs = spark.createDataFrame([(1, words, "x"), (2, "something else", None), (3, None, words)],
                                 "doc_id long, Text string, item_id string")
    bench = spark.createDataFrame([(7, words), (8, "else")], "item_id long, text string")
    assert sorted(r["doc_id"] for r in decontaminate.drop_contaminated(docs, bench).collect()) == [2, 3]
