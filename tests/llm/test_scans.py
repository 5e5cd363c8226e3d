"""Operators 2, 4, 5 and 8 against plain restatements of their base rules."""

import hashlib
import re

import duckdb
import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from millrace.llm import license_scan, personal_data, quality_rules, secret_scan

ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ANY_CASE = "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in ASSIGN.split(")", 1)[0]) + ")" + ASSIGN.split(")", 1)[1]


def digest(spans, order):
    spans = sorted(spans, key=lambda x: (x[1], order.index(x[0])))
    return hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in spans).encode()).hexdigest()


def naive_secrets(t):
    out = [("assign", *m.span()) for m in re.finditer(ANY_CASE, t) if len(m.group(2)) >= 12]
    out += [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m.group()) >= 18]
    return out + [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", t) if len(m.group()) >= 16]


def luhn(d):
    total = 0
    for i, c in enumerate(reversed(d)):
        v = int(c) * (2 if i % 2 else 1)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def naive_personal(t):
    digits = lambda s: re.sub("[^0-9]", "", s)
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t)
            if all(int(p) <= 255 for p in m.group().split("."))]
    out += [("card", *m.span()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t)
            if 14 <= len(digits(m.group())) <= 19 and luhn(digits(m.group()))]
    return out + [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t)
                  if 10 <= len(digits(m.group())) <= 15]


def naive_phrases(t):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    places = []
    for phrase, label in license_scan.BASE_PHRASES.items():
        p = phrase.split()
        places += [(i, label) for i in range(len(w)) if w[i:i + len(p)] == p]
    return len(w), places


def rows(df):
    return df.collect()


def spans_of(text):
    return [(x.split(":")[0], *map(int, x.split(":")[1:])) for x in text.split(",") if x]


def test_secrets_base_on_all_documents(docs):
    texts = {r.doc_id: r.text or "" for r in rows(docs)}
    got = rows(secret_scan.secret_digest(docs))
    assert len(got) == len(texts)
    for r in got:
        want = naive_secrets(texts[r.doc_id])
        assert r.base_sha256 == digest(want, ["assign", "access", "hex"])
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(x[0] == k for x in want) for k in ("assign", "access", "hex"))
        assert set(want) <= set(spans_of(r.spans))


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="pPaAsSwWoOrRdD=: \"'tToOkKeEnNAKIA0fſK_", max_size=80))
def test_secrets_base_random(t):
    assert sorted(naive_secrets(t)) == sorted((k, s, e) for s, e, k in secret_scan.base_spans(t))


def test_battery_finds_random_tokens_and_leaves_text():
    rng = np.random.default_rng(1)
    for name in ("base62", "base64", "base64url"):
        alphabet = dict(secret_scan.ENCODINGS)[name]
        found = 0
        for n in (40, 64, 88):
            for _ in range(40):
                token = "".join(rng.choice(list(alphabet), n))
                found += any(k == "random" for _, _, k in secret_scan.scan_text(f"see {token} here"))
        assert found >= 105, name
    prose = ("state-of-the-art_implementation_of_things Donaudampfschifffahrtsgesellschaftskapitaen "
             "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa abcabcabcabcabcabcabcabcabcabc ABCDEFGHIJKLMNOPQRSTUVWXYZ "
             "/usr/local/share/applications/configuration /path/to/SomeLongClassNameForTestingThings "
             "1234567890123456789012345 =========================== --------------------------------")
    assert not [x for x in secret_scan.scan_text(prose) if x[2] == "random"]


def test_battery_looks_behind_names_and_inside_paths():
    rng = np.random.default_rng(7)
    base62, base64, url = (list(dict(secret_scan.ENCODINGS)[k]) for k in ("base62", "base64", "base64url"))
    draw = lambda alphabet: "".join(rng.choice(alphabet, 64))
    forms = {"AUTH={}": base62, "PRIVATE_KEY={}": base64, "sig={}==": base64, "GET /x?key={}&v=1": url,
             "/services/team0/channel/{}": base62, "a_very_long_variable_name_indeed={}": base62,
             "export-of-the+{}": base62, "0123456789abcdef/{}": base62}
    for form, alphabet in forms.items():
        held = 0
        for _ in range(40):
            secret = draw(alphabet)
            text = f"see {form.format(secret)} here"
            spans = [(s, e) for s, e, k in secret_scan.scan_text(text) if k == "random"]
            assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))
            # A whole path may be found too; its span then holds the secret.
            at = text.index(secret)
            held += any(s <= at and at + len(secret) <= e for s, e in spans)
        assert held >= 34, (form, held)
    plain = ("name=state_of_the_art_implementation_of_things a=/usr/local/share/applications/configuration "
             "the-long+name_of-a/path_that+mixes-signs/of_all+kinds-together x=" + "=" * 40)
    assert not [x for x in secret_scan.scan_text(plain) if x[2] == "random"]


def test_step_up_is_the_textbook_procedure_for_equal_lengths():
    rng = np.random.default_rng(3)
    for _ in range(200):
        p = rng.random(12) ** 4
        q = np.sort(p)
        ok = [x for i, x in enumerate(q, 1) if x <= 0.01 * i / 12]
        assert secret_scan.step_up([(x, 40) for x in p]) == [bool(ok) and x <= max(ok) for x in p]


def test_personal_base_on_all_documents(docs):
    texts = {r.doc_id: r.text or "" for r in rows(docs)}
    for r in rows(personal_data.personal_digest(docs)):
        want = naive_personal(texts[r.doc_id])
        assert r.base_sha256 == digest(want, list(personal_data.BASE))
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(x[0] == k for x in want) for k in personal_data.BASE)
        assert set(want) <= set(spans_of(r.spans))


@settings(max_examples=500, deadline=None)
@given(st.text(alphabet="a.@-+ ()0123459", max_size=60))
def test_personal_base_random(t):
    assert sorted(naive_personal(t)) == sorted((k, s, e) for s, e, k in personal_data.base_spans(t))


def test_span_model_learns_from_votes(spark):
    good = [f"Please call our phone desk at (212) 555-{i:04d} or mail x{i}@site.org" for i in range(60)]
    bad = [f"part serial 100 200 {3000 + i} version 123-456-{i:04d} order id total 4 5 6 7 8 9 10 11 12 13" for i in range(60)]
    df = spark.createDataFrame(list(enumerate(good + bad)), "doc_id long, text string")
    model = personal_data.fit_model(df)
    found = [personal_data.find_spans(t, model) for t in good + bad]
    assert all(any(k == "phone_local" for _, _, k in f) for f in found[:60])
    assert not any(f for f in found[60:])
    assert personal_data.redact_text(good[0], model) == "Please call our phone desk at <PHONE_LOCAL> or mail <EMAIL>"
    clean = "The quick brown fox jumps over the lazy dog in 1999."
    assert personal_data.redact_text(clean, model) == clean


REFUSED = ["transfer to DE88 3704 0044 0532 0130 00 today", "my ssn is 000-45-6789 ok", "ssn 666-45-6789",
           "version 555-123-4567 part", "order 555-555-5555 id", "isbn 978-316-1484 page 3", "invoice 123-45-6789 total"]
FOUND = [("transfer to DE89 3704 0044 0532 0130 00 today", "iban"), ("my ssn is 123-45-6789 ok", "ssn"),
         ("call 212-555-0147 now", "phone_local"), ("mail joe (at) site (dot) org please", "email_spelled"),
         ("Dr. Anna Schmidt went home", "person"), ("yesterday Maria Lopez came", "person")]


def test_personal_planted_in_the_real_table(spark, docs):
    """Candidates that a checksum, a number range or a word speaks against are refused, others found."""
    words = [r["text"][:300] for r in docs.orderBy("doc_id").limit(len(REFUSED + FOUND)).collect()]
    planted = [f"{w}\n{t}\n" for w, t in zip(words, REFUSED + [t for t, _ in FOUND])]
    both = docs.select("doc_id", "text").unionByName(spark.createDataFrame(
        [(10 ** 9 + i, t) for i, t in enumerate(planted)], "doc_id long, text string"))
    for model in (personal_data.fit_model(both), personal_data.fit_model(both.limit(0))):
        kinds = [[k for s, e, k in personal_data.find_spans(t, model) if s >= len(w)] for t, w in zip(planted, words)]
        assert kinds[:len(REFUSED)] == [[]] * len(REFUSED)
        assert kinds[len(REFUSED):] == [[k] for _, k in FOUND]


def test_em_against_direct_likelihood():
    """The posterior is Bayes' rule written out, and every round of EM raises the penalised likelihood."""
    import math
    import numpy as np
    pd_ = personal_data
    rng = np.random.default_rng(2)
    votes, features = pd_.defined_patterns()
    pick = rng.choice(len(votes), 60, replace=False)
    votes, kind, n = votes[pick], features[pick, 0], rng.integers(1, 400, 60).astype(float)

    def plain(tables, shares):
        total, post = 0.0, []
        for v, k, m in zip(votes.tolist(), kind.tolist(), n):
            like = []
            for c in (0, 1):
                x = shares[k] if c else 1 - shares[k]
                for j, vote in enumerate(v):
                    if pd_.LOOKS[k, j]:
                        x *= tables[k, j, c, vote + 1]
                like.append(x)
            total += m * math.log(sum(like))
            post.append(like[1] / sum(like))
        for k in sorted(set(kind.tolist())):
            total += pd_.KIND_STRENGTH * (pd_.KIND_PRIOR[k] * math.log(shares[k])
                                          + (1 - pd_.KIND_PRIOR[k]) * math.log(1 - shares[k]))
            total += sum(pd_.STRENGTH * float((pd_.VOTE_PRIOR[k, j] * np.log(tables[k, j])).sum())
                         for j in range(pd_.N_VOTES) if pd_.LOOKS[k, j])
        return total, post
    before = -math.inf
    for rounds in range(8):
        tables, shares = pd_.fit_labelers(votes, kind, n, rounds)
        total, post = plain(tables, shares)
        assert np.allclose(post, pd_.posterior(votes, kind, tables, shares))
        assert total >= before - 1e-6
        before = total


def test_license_versions_are_told_apart():
    for text, labels in [("GNU General Public License version 3", "gpl,gpl-3.0"),
                         ("the gnu general public licence, version 2 or later", "gpl,gpl-2.0"),
                         ("GNU General Public License version 7", "gpl,gpl-2.0,gpl-3.0"), ("GNU General Public License", "gpl"),
                         ("Creative Commons Attribution 4.0 International", "cc-by,cc-by-4.0"),
                         ("SPDX-License-Identifier: Apache-2.0", "apache-2.0")]:
        assert ",".join(license_scan.scan_text(text)["labels"]) == labels, text


def test_many_spans_in_one_text_take_linear_time():
    import time
    model = personal_data.fit_patterns(np.zeros((0, 8), int), np.zeros((0, 9), int), np.zeros(0))
    for scan, piece in ((license_scan.scan_text, "cc by x "), (secret_scan.scan_text, "token=abcdef0123456789abcdef "),
                        (lambda t: personal_data.find_spans(t, model), "a@b.cc 555-123-4567 ")):
        took = []
        for n in (4000, 16000):
            t0 = time.process_time()
            scan(piece * n)
            took.append(time.process_time() - t0)
        assert took[1] < 10 * took[0] + 0.5


def test_quality_matches_sql(spark, docs, awkward):
    con = duckdb.connect()
    for df in (docs, awkward):
        con.register("documents", df.select("doc_id", "text").toArrow())
        cur = con.execute(quality_rules.SQL)
        cols = [c[0] for c in cur.description]
        want = sorted(map(repr, cur.fetchall()))
        got = sorted(repr(tuple(r)) for r in quality_rules.quality_report(df).select(*cols).collect())
        assert got == want


def test_repeated_words_by_brute_force():
    rng = np.random.default_rng(5)
    for _ in range(300):
        w = [bytes([97 + int(c)]) for c in rng.integers(0, 3, int(rng.integers(0, 25)))]
        grams = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
        want = {i + j for i, g in enumerate(grams) if grams.count(g) > 1 for j in range(3)}
        assert quality_rules.repeated_words(w) == len(want)


def test_policies_and_ablations(docs):
    ledger = quality_rules.build_ledger(docs).cache()
    masks = [r.failed for r in ledger.collect()]
    for name, bits in quality_rules.POLICIES.items():
        assert quality_rules.apply_policy(ledger, name).filter("kept").count() == sum(not m & bits for m in masks)
        for r in quality_rules.ablations(ledger, name).collect():
            bit = quality_rules.BIT[r.rule]
            assert r.n_failed == sum(bool(m & bit) for m in masks)
            assert r.n_only == sum(m & bits == bit for m in masks)
            assert r.n_kept_without == sum(not m & bits & ~bit for m in masks)


def test_license_base_on_all_documents(docs):
    texts = {r.doc_id: r.text or "" for r in rows(docs)}
    for r in rows(license_scan.scan_licenses(docs)):
        n, places = naive_phrases(texts[r.doc_id])
        at = [p for p, _ in places]
        assert (r.n_words, r.n_base, r.first_word, r.last_word) == (n, len(at), min(at, default=None), max(at, default=None))
        assert r.base_labels == ",".join(sorted({x for _, x in places}))
        assert {x for _, x in places} <= set(r.labels.split(",")) and 0 <= r.score <= 1


def _distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        prev, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            prev, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, prev + (x != y))
    return row[-1]


def test_fuzzy_notices_find_every_edited_copy():
    rng = np.random.default_rng(11)
    for label, notice in license_scan.NOTICES:
        for _ in range(40):
            chars = list(notice)
            for _ in range(int(rng.integers(0, license_scan.errors(len(notice)) + 1))):
                i = int(rng.integers(1, len(chars) - 1))
                kind = rng.integers(0, 3)
                if kind == 0 and chars[i] != " ":
                    chars[i] = "q"
                elif kind == 1 and " " not in chars[i - 1:i + 2]:   # a lost word would be two edits
                    del chars[i]
                else:
                    chars.insert(i, "z")
            edited = "".join(chars)
            got = license_scan.scan_text(f"some words first. {edited.upper()}\n and more")
            assert label in got["labels"], (notice, edited)
            for f in got["finds"]:
                text = f"some words first. {edited.upper()}\n and more"[f["start"]:f["end"]]
                assert f["edits"] <= license_scan.errors(max(len(n) for _, n in license_scan.NOTICES))
                assert text.strip() == text
    assert license_scan.scan_text("we reserve the right to all things here, public and general")["labels"] == []


def test_scans_on_awkward_and_empty_tables(awkward, empty):
    n = awkward.count()
    for f in (secret_scan.secret_digest, personal_data.personal_digest, quality_rules.quality_report,
              license_scan.scan_licenses):
        got = f(awkward).collect()
        assert len(got) == n
        assert sum(r.doc_id is None for r in got) == 1
        five = [r for r in got if r.doc_id == 5]
        assert len(five) == 2 and five[0] == five[1]
        assert f(empty).count() == 0
    blank = [r for r in secret_scan.secret_digest(awkward).collect() if r.doc_id in (1, 2, 3)]
    assert {r.base_sha256 for r in blank} == {hashlib.sha256(b"").hexdigest()}
