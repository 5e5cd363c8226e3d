"""Personal data by weak supervision (operator 4).

Base kinds (email, ip, card, phone) are found by pattern and always reported.
Looser patterns give further candidates: phone numbers without a country sign,
written-out emails, social security numbers, IBANs and names after a title or
with a known given name. Every candidate is voted on by labelers that look at
different evidence:

* regex labelers: strict pattern, checksums and number ranges;
* gazetteer labelers: words near it that speak for or against, given names;
* context labelers: the characters and tokens around it, repeated digits.

Expectation-maximisation over the candidates of the corpus estimates, for each
kind, how reliable each labeler is and how many candidates are personal, without
any gold label. Both start from what the labeler is defined to mean
(``VOTE_PRIOR``, ``KIND_PRIOR``, worth ``STRENGTH`` and ``KIND_STRENGTH`` candidates), so a
kind that the corpus does not hold keeps its labelers' verdict, and base kinds say
nothing about others. The posteriors train a logistic span classifier on features of
the candidate, among them the checksums: on the corpus's patterns and, lightly, on
every pattern the definitions allow. It decides the loose candidates in a second
narrow pass.

Both fits only need counts of (votes, features) patterns, whose number is bounded
by the definitions and not by the data, so the corpus is reduced to them by one
partial aggregation.

Defined results: null or empty text gives no spans; a table without candidates
gives the classifier of the definitions alone; null ids are kept; repeated rows
count again in the statistics; texts are read whole, in linear time.
"""

from __future__ import annotations

import itertools
import math
import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._batches import Cover, id_and_text, map_batches, sha256_hex, span_list

KINDS = {"email": 0, "ip": 1, "card": 2, "phone": 3,
         "phone_local": 4, "email_spelled": 5, "ssn": 6, "iban": 7, "person": 8}
BASE = ("email", "ip", "card", "phone")

# The base patterns, in a form that cannot rescan a run of characters.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9]){13,}")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# Looser candidates.
_PHONE_LOCAL = re.compile(r"(?<![0-9+])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])")
_SPELLED = re.compile(r"\b[A-Za-z0-9_.-]{1,64} ?(?:\(at\)|\[at\]) ?[A-Za-z0-9-]{1,63} ?(?:\(dot\)|\[dot\]) ?[A-Za-z]{2,24}\b")
_SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_IBAN = re.compile(r"\b[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?\b")
_PERSON = re.compile(r"\b(?:Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Madame|Monsieur|Señor|Señora)\.? [A-Z][a-zà-ÿ]{1,30}(?: [A-Z][a-zà-ÿ]{1,30})?\b")
_NAME = re.compile(r"\b[A-Z][a-zà-ÿ]{1,30} [A-Z][a-zà-ÿ]{1,30}\b")
_TITLE = re.compile(r"Mr|Ms|Dr|Prof|Herr|Frau|Mada|Mons|Señor")
_DIGIT = re.compile(r"[0-9]")

#: Gazetteers: words near a candidate that speak for it, and against it.
FOR = frozenset("phone tel telephone call mobile cell fax contact reach dial whatsapp email mail write ssn social "
                "security iban account bank transfer payee name telefon kontakt handy anruf konto kontonummer "
                "teléfono móvil llamar correo cuenta nombre téléphone portable appeler courriel compte nom".split())
AGAINST = frozenset("version isbn issn part serial order invoice model page section chapter figure table example "
                    "sample test id total price sku lot batch article item ticket case build release revision "
                    "artikel seite bestellung rechnung beispiel página pedido factura ejemplo commande facture "
                    "exemple numéro ref reference".split())
#: Given names that are common in the four languages of the labelers.
GIVEN = frozenset("""
Adam Alan Alice Amy Andrew Anna Anne Anthony Barbara Benjamin Brian Carl Carol Charles Christine Daniel David Deborah
Diana Donald Edward Elizabeth Emily Emma Eric Frank George Grace Hannah Helen Henry Jack Jacob James Jane Jennifer
Jessica John Joseph Julia Karen Kevin Laura Linda Lisa Margaret Maria Mark Martin Mary Matthew Michael Nancy Oliver
Olivia Patricia Paul Peter Rachel Rebecca Richard Robert Ruth Samuel Sandra Sarah Sophia Stephen Steven Susan Thomas
Victoria William Andreas Bernd Christoph Claudia Dieter Erika Friedrich Günter Hans Heike Heinrich Ingrid Jürgen Karin
Klaus Lukas Manfred Matthias Monika Petra Sabine Stefan Ursula Uwe Werner Wolfgang Antoine Camille Chloé Claire Émile
François Gérard Hélène Isabelle Jacques Jean Julien Louis Lucie Luc Marie Mathieu Nicolas Odile Philippe Pierre Sylvie
Thérèse Yves Alejandro Ana Antonio Carlos Carmen Diego Elena Fernando Francisco Isabel Javier Jorge José Juan Juana
Lucía Luis Manuel Miguel Pablo Pedro Pilar Rafael Rosa Sofía Teresa""".split())
NEAR = 40          # characters looked at on either side


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def _emails(text: str) -> list[tuple[int, int, str]]:
    """Leftmost, non-overlapping: at each @ the local part is read backwards, so a
    long run of letters is never tried from every start."""
    out, floor, at = [], 0, text.find("@")
    while at >= 0:
        s = at
        while s > floor and text[s - 1] in _LOCAL:
            s -= 1
        m = _DOMAIN.match(text, at + 1) if s < at else None
        if m:
            out.append((s, m.end(), "email"))
        floor = m.end() if m else at + 1
        at = text.find("@", floor)
    return out


def base_spans(text: str) -> list[tuple[int, int, str]]:
    out = _emails(text)
    if not _DIGIT.search(text):
        return out
    if "." in text:
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m.group().split(".")):
                out.append((*m.span(), "ip"))
    for m in _CARD.finditer(text):
        d = _digits(m.group())
        if len(d) <= 19 and _luhn(d):
            out.append((*m.span(), "card"))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= len(_digits(m.group())) <= 15:
                out.append((*m.span(), "phone"))
    return out


def _iban_ok(s: str) -> bool:
    s = s.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


def loose_spans(text: str, base: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """Candidates that only the classifier can accept; none overlaps a base span."""
    out = []
    if _DIGIT.search(text):
        out += [(*m.span(), "phone_local") for m in _PHONE_LOCAL.finditer(text)]
        if "-" in text:
            out += [(*m.span(), "ssn") for m in _SSN.finditer(text)]
        out += [(*m.span(), "iban") for m in _IBAN.finditer(text)]
    if "at)" in text or "at]" in text:
        out += [(*m.span(), "email_spelled") for m in _SPELLED.finditer(text)]
    titled = [(*m.span(), "person") for m in _PERSON.finditer(text)] if _TITLE.search(text) else []
    taken = Cover(len(text), titled)
    out += titled
    out += [(*m.span(), "person") for m in _NAME.finditer(text)
            if m.group().split(" ", 1)[0] in GIVEN and not taken.hits(*m.span())]
    known = Cover(len(text), base)
    return [x for x in out if not known.hits(x[0], x[1])]


_WORDS = re.compile(r"[^\W\d_]+")


def evidence(text: str, span: tuple[int, int, str]) -> tuple[tuple[int, ...], tuple[int, ...]]:
    """Votes (1 personal, 0 abstains, -1 not) of the labelers, and the features, of one span."""
    s, e, kind = span
    body = text[s:e]
    left, right = text[max(0, s - NEAR):s], text[e:e + NEAR]
    near = {w.lower() for w in _WORDS.findall(left) + _WORDS.findall(right)}
    spoken_for, spoken_against = bool(near & FOR), bool(near & AGAINST)
    digits = _digits(body)
    glued = bool(left[-1:].isalnum() or right[:1].isalnum())
    crowded = sum(c.isdigit() for c in left + right) > 12
    labelled = left.rstrip()[-1:] in (":", "=", "<", "(")
    one_digit = bool(digits) and len(set(digits)) <= 2
    check = (1 if _iban_ok(body) else -1) if kind == "iban" else \
        (-1 if digits[:3] in ("000", "666") or digits[:1] == "9" or digits[3:5] == "00" or digits[5:] == "0000" else 1) \
        if kind == "ssn" else 0
    named = kind == "person" and any(w in GIVEN for w in body.split())
    votes = (
        1 if kind in BASE else 0,                                             # strict pattern
        check,                                                                # checksums, number ranges
        1 if spoken_for else 0,                                               # gazetteers
        -1 if spoken_against else 0,
        1 if named else 0,
        1 if labelled else 0,                                                 # context
        -1 if glued or crowded else 0,
        -1 if one_digit else 0,
    )
    features = (KINDS[kind], check + 1, int(spoken_for), int(spoken_against), int(named), int(labelled),
                int(glued or crowded), int(one_digit), min(3, len(body) // 10))
    return votes, features


N_VOTES, N_FEATURES = 8, 9

#: What each labeler is defined to mean: chances of its votes (-1, 0, 1) on spans that are not
#: personal, and on those that are.
VOTE_PRIOR = np.repeat(np.array([
    [[.01, .60, .39], [.01, .30, .69]],         # strict pattern
    [[.60, .35, .05], [.005, .35, .645]],       # checksum
    [[.01, .79, .20], [.01, .49, .50]],         # a word for it
    [[.60, .39, .01], [.03, .96, .01]],         # a word against it
    [[.01, .79, .20], [.01, .49, .50]],         # a given name
    [[.01, .84, .15], [.01, .64, .35]],         # a label ahead
    [[.45, .54, .01], [.05, .94, .01]],         # glued or crowded
    [[.40, .59, .01], [.02, .97, .01]],         # one digit again and again
])[None], len(KINDS), 0)
# Most numbers lie in a social security number's ranges, so that says little for one.
VOTE_PRIOR[KINDS["ssn"], 1] = [[.30, .01, .69], [.005, .005, .99]]
#: The labelers that look at a kind at all (others abstain, which then says nothing).
LOOKS = np.array([[j != 1 or k in ("ssn", "iban") for j in range(N_VOTES)] for k in KINDS])
LOOKS[:, 4] = [k == "person" for k in KINDS]
LOOKS[:, 0] = [k in BASE for k in KINDS]
LOOKS[:, 7] = [k not in ("person", "email", "email_spelled") for k in KINDS]
#: Share of candidates of a kind that are personal, before any is seen.
KIND_PRIOR = np.array([.95, .95, .95, .95, .65, .85, .65, .65, .75])
STRENGTH, KIND_STRENGTH = 200.0, 20.0
#: Weight of all patterns that the definitions allow, next to the corpus's, in the classifier's fit.
DEFINED_WEIGHT = 200.0
RIDGE = 0.01


@dataclass(frozen=True)
class SpanModel:
    """Labeler reliabilities and the span classifier; small and picklable."""
    weights: tuple[float, ...]
    shares: tuple[float, ...] = ()              # of personal candidates, by kind
    #: By kind and labeler: chance of a vote for a personal span, and of one against another.
    reliability: tuple[tuple[tuple[float, float], ...], ...] = ()

    def probability(self, features: tuple[int, ...]) -> float:
        x = _design(np.array([features]))[0]
        return float(1 / (1 + math.exp(-max(-30.0, min(30.0, float(x @ np.array(self.weights)))))))


def _design(features: np.ndarray) -> np.ndarray:
    kinds = np.eye(len(KINDS))[features[:, 0]]
    checks = np.eye(3)[features[:, 1]]
    sizes = np.eye(4)[features[:, 8]]
    return np.hstack([np.ones((len(features), 1)), kinds, checks, features[:, 2:8], sizes])


WIDTH = 1 + len(KINDS) + 3 + 6 + 4


def posterior(votes: np.ndarray, kind: np.ndarray, tables: np.ndarray, shares: np.ndarray) -> np.ndarray:
    """Chance that a pattern is personal, by Bayes' rule over the labelers that look at its kind."""
    onehot = np.stack([votes == v for v in (-1, 0, 1)], 2).astype(float)       # pattern, labeler, vote
    ratio = np.log(tables[kind, :, 1]) - np.log(tables[kind, :, 0])             # pattern, labeler, vote
    log_odds = (onehot * ratio).sum(2) * LOOKS[kind]
    prior = np.log(shares[kind]) - np.log1p(-shares[kind])
    return 1 / (1 + np.exp(-np.clip(log_odds.sum(1) + prior, -30, 30)))


def fit_labelers(votes: np.ndarray, kind: np.ndarray, n: np.ndarray, rounds: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """Per kind: vote chances (labeler, not/personal, vote) and the share of personal candidates, by EM."""
    tables = VOTE_PRIOR.copy()
    shares = KIND_PRIOR.copy()
    onehot = np.stack([votes == v for v in (-1, 0, 1)], 2).astype(float)
    for _ in range(rounds if len(n) else 0):
        post = posterior(votes, kind, tables, shares)
        for k in np.unique(kind):
            own = kind == k
            w = np.stack([n[own] * (1 - post[own]), n[own] * post[own]])       # not/personal, pattern
            seen = np.einsum("cp,pjv->jcv", w, onehot[own]) + STRENGTH * VOTE_PRIOR[k]
            tables[k] = seen / seen.sum(2, keepdims=True)
            shares[k] = (w[1].sum() + KIND_STRENGTH * KIND_PRIOR[k]) / (w.sum() + KIND_STRENGTH)
    return tables, shares


def defined_patterns() -> tuple[np.ndarray, np.ndarray]:
    """Votes and features of every pattern a loose candidate can have."""
    votes, features = [], []
    for name, k in KINDS.items():
        if name in BASE:
            continue
        for check, for_, against, named, label, crowd, one, size in itertools.product(
                (-1, 1) if name in ("ssn", "iban") else (0,), (0, 1), (0, 1), (0, 1) if name == "person" else (0,),
                (0, 1), (0, 1), (0, 1) if LOOKS[k, 7] else (0,), range(4)):
            votes.append((0, check, for_, -against, named, label, -crowd, -one))
            features.append((k, check + 1, for_, against, named, label, crowd, one, size))
    return np.array(votes), np.array(features)


def fit_patterns(votes: np.ndarray, features: np.ndarray, n: np.ndarray) -> SpanModel:
    """EM over vote patterns (with counts ``n``), then the logistic classifier on its posteriors."""
    tables, shares = fit_labelers(votes, features[:, 0], n)
    more_votes, more = defined_patterns()
    loose = features[:, 0] >= len(BASE)
    all_votes, all_ = np.vstack([votes[loose], more_votes]), np.vstack([features[loose], more])
    post = posterior(all_votes, all_[:, 0], tables, shares)
    weight = np.concatenate([n[loose] * min(1.0, 1e6 / max(1.0, float(n[loose].sum()))),
                             np.full(len(more), DEFINED_WEIGHT / len(more))])
    x = _design(all_)
    w = np.zeros(WIDTH)
    for _ in range(50):                                                        # Newton, a small ridge
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (weight * (p - post)) + RIDGE * w
        hess = (x * (weight * p * (1 - p))[:, None]).T @ x + RIDGE * np.eye(WIDTH)
        step = np.linalg.solve(hess, grad)
        w -= step
        if np.abs(step).max() < 1e-9:
            break
    return SpanModel(weights=tuple(float(v) for v in w), shares=tuple(float(v) for v in shares),
                     reliability=tuple(tuple((float(t[j, 1, 2]), float(t[j, 0, 0])) for j in range(N_VOTES))
                                       for t in tables))


def fit_model(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> SpanModel:
    """Label model and classifier from all candidates of all documents.

    What reaches the driver is one row per (votes, features) pattern: at most
    some 3,000 by definition, some dozens in practice.
    """
    def work(_ids, texts):
        counts: dict[tuple, int] = {}
        for t in texts:
            base = base_spans(t)
            for span in base + loose_spans(t, base):
                v, f = evidence(t, span)
                counts[v + f] = counts.get(v + f, 0) + 1
        return list(counts), list(counts.values())
    patterns = (map_batches(id_and_text(df, id_col, text_col), "pattern array<int>, n long", work)
                .groupBy("pattern").agg(F.sum("n").alias("n")).collect())
    rows = sorted((tuple(r.pattern), r.n) for r in patterns)
    p = np.array([r[0] for r in rows], dtype=int).reshape(len(rows), N_VOTES + N_FEATURES)
    return fit_patterns(p[:, :N_VOTES], p[:, N_VOTES:], np.array([r[1] for r in rows], float))


def find_spans(text: str, model: SpanModel) -> list[tuple[int, int, str]]:
    """All spans of one text: every base span, and loose candidates the classifier accepts."""
    base = base_spans(text)
    extra, taken = [], Cover(len(text))
    for span in loose_spans(text, base):
        if not taken.hits(span[0], span[1]) and model.probability(evidence(text, span)[1]) >= 0.5:
            extra.append(span)
            taken.add(span[0], span[1])
    return base + extra


def personal_digest(df: DataFrame, model: SpanModel | None = None) -> DataFrame:
    """The digest of operator 4: counts by base kind, the base spans' hash, all spans as text."""
    model = model or fit_model(df)

    def work(ids, texts):
        counts, hashes, joined = [], [], []
        for t in texts:
            spans = find_spans(t, model)
            base = [x for x in spans if x[2] in BASE]
            counts.append([sum(x[2] == k for x in base) for k in BASE])
            hashes.append(sha256_hex(span_list(base, KINDS)))
            joined.append(span_list(spans, KINDS))
        return [ids, *zip(*counts, strict=True), hashes, joined]
    return map_batches(id_and_text(df), "doc_id long, n_email long, n_ip long, n_card long, "
                       "n_phone long, base_sha256 string, spans string", work)


def redact_text(text: str, model: SpanModel) -> str:
    """The text with every span replaced by its kind in angle brackets; of
    overlapping spans the merged stretch gets the first one's kind."""
    out, at = [], 0
    merged: list[list] = []
    for s, e, k in sorted(find_spans(text, model), key=lambda x: (x[0], KINDS[x[2]])):
        if merged and s < merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], e)
        else:
            merged.append([s, e, k])
    for s, e, k in merged:
        out += [text[at:s], f"<{k.upper()}>"]
        at = e
    return "".join(out) + text[at:]
