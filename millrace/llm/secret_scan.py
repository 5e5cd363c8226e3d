"""Secret scan: known formats plus a randomness test battery (operator 2).

Base kinds are found by pattern. The battery then looks at every other long
token, infers the encoding it is written in (the smallest alphabet that holds
it) and asks two questions:

* *Is it consistent with random draws?* Chi-squared uniformity over the
  alphabet, a runs test about the alphabet's middle and a lag-1 serial
  correlation test, joined by Fisher's method. A token that fails is ordinary.
* *Could an ordinary token look this uniform by chance?* The chi-squared value
  and the number of character-class changes are compared with what ordinary
  identifiers of the same length show, which gives a discovery p-value that a
  short token cannot make small.

``=`` belongs to a token only as trailing padding, so a value is a token without
the name before it. Where a token is not found as a whole (a path that ends in a
secret, a token that mixes alphabets, or one that a base find cuts into), its
pieces between separators are tested, and the longest found ones reported.

The discovery p-values of one document's tokens form one family, those of the
pieces a second one; each goes through a Benjamini-Hochberg step-up with weights
by length (longer tokens carry more evidence), so the share of false finds stays
at ``FDR`` in each, and pieces never cost a whole token its find.

The family is the document, so a result never depends on other rows: the scan
is one narrow pass, with no shuffle, and any lost task is simply run again.

Defined results: null or empty text, and text without a find, give zero counts
and the hash of the empty string; null ids are kept; repeated rows give
repeated results; very long texts are read whole in linear time.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._batches import Cover, id_and_text, map_batches

# The base patterns and their least lengths.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
# A run of 16 or more; shorter runs would be dropped, so they need no match.
HEX = re.compile(r"[0-9a-f]{16,}")
ASSIGN_LEAST, ACCESS_LEAST = 12, 18

KINDS = {"assign": 0, "access": 1, "hex": 2, "random": 3}

#: Tokens the battery looks at, and its levels.
TOKEN_LEAST = 20
FDR = 0.01
RANDOM_LEVEL = 0.001
#: Ordinary identifiers: chance that two characters agree, and that the
#: character class (lower, upper, digit) changes between neighbours.
ORDINARY_AGREE = 0.060
ORDINARY_CHANGE = 0.15
LENGTH_UNIT = 32

_TOKEN = re.compile(r"[A-Za-z0-9+/_-]{%d,}(?:=+(?![A-Za-z0-9+/_=-]))?" % TOKEN_LEAST)
_PATH = re.compile(r"[^/]+")
#: Cuts of a token that no alphabet holds: each leaves one alphabet's own signs.
_MIXED = [re.compile(r"[^+/]+"), re.compile(r"[^_-]+")]

_DIGITS = "0123456789"
_LOWER = "abcdefghijklmnopqrstuvwxyz"
_UPPER = _LOWER.upper()
#: Encodings from the smallest alphabet up; the first that holds a token is inferred.
ENCODINGS = [
    ("decimal", _DIGITS),
    ("hex", _DIGITS + "abcdef"),
    ("hex_upper", _DIGITS + "ABCDEF"),
    ("base32", _UPPER + "234567"),
    ("lower", _LOWER),
    ("base36", _DIGITS + _LOWER),
    ("base36_upper", _DIGITS + _UPPER),
    ("base62", _UPPER + _LOWER + _DIGITS),
    ("base64", _UPPER + _LOWER + _DIGITS + "+/"),
    ("base64url", _UPPER + _LOWER + _DIGITS + "-_"),
]
_RANKS = [(name, {c: i for i, c in enumerate(alphabet)}) for name, alphabet in ENCODINGS]


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """Pattern finds, leftmost and non-overlapping per kind; spans are whole matches."""
    out = []
    if ":" in text or "=" in text:
        for m in ASSIGN.finditer(text):
            if m.end(2) - m.start(2) >= ASSIGN_LEAST:
                out.append((m.start(), m.end(), "assign"))
    for m in ACCESS.finditer(text):
        if m.end() - m.start() >= ACCESS_LEAST:
            out.append((m.start(), m.end(), "access"))
    out += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return out


def infer_encoding(token: str) -> tuple[str, dict[str, int]] | None:
    body = set(token)
    for name, ranks in _RANKS:
        if body <= ranks.keys():
            return name, ranks
    return None


def _upper_tail(z: float) -> float:
    return 0.5 * math.erfc(z / math.sqrt(2))


def _fisher(ps: list[float]) -> float:
    half = -sum(math.log(max(p, 1e-300)) for p in ps)
    term = total = math.exp(-half)
    for i in range(1, len(ps)):
        term *= half / i
        total += term
    return min(1.0, total)


def _binomial_upper(k: int, n: int, p: float) -> float:
    """P(X >= k) for X ~ Binomial(n, p), by the normal form with continuity."""
    if k <= 0:
        return 1.0
    return _upper_tail((k - 0.5 - n * p) / math.sqrt(n * p * (1 - p)))


def battery(token: str) -> dict | None:
    """Test results of one token, or None if no encoding holds it.

    ``p_random``: the three randomness tests together (small: not random).
    ``p_ordinary``: how often an ordinary token of this length looks as random.
    """
    body = token.rstrip("=")
    found = infer_encoding(body)
    n = len(body)
    if found is None or n < TOKEN_LEAST:
        return None
    name, ranks = found
    a = len(ranks)
    values = [ranks[c] for c in body]
    counts: dict[int, int] = {}
    for v in values:
        counts[v] = counts.get(v, 0) + 1
    agree = sum(c * c for c in counts.values())
    chi2 = a * agree / n - n
    sd = math.sqrt(2 * (a - 1) * (n - 1) / n)
    p_uniform = _upper_tail((chi2 - (a - 1)) / sd)

    high = [v >= a / 2 for v in values]
    n1 = sum(high)
    n2 = n - n1
    p_runs = 0.0
    if n1 and n2:
        runs = 1 + sum(x != y for x, y in zip(high, high[1:]))
        mean = 1 + 2 * n1 * n2 / n
        var = (mean - 1) * (mean - 2) / (n - 1)
        p_runs = 2 * _upper_tail(abs(runs - mean) / math.sqrt(var)) if var > 0 else 1.0

    mu = sum(values) / n
    ss = sum((v - mu) ** 2 for v in values)
    p_serial = 0.0
    if ss:
        r = sum((x - mu) * (y - mu) for x, y in zip(values, values[1:])) / ss
        p_serial = 2 * _upper_tail(abs(r + 1 / n) * math.sqrt(n))
    p_random = _fisher([p_uniform, min(1.0, p_runs), min(1.0, p_serial)])

    # Ordinary tokens: chi2 is shifted by how much more often characters agree.
    agree_ordinary = max(ORDINARY_AGREE, 1.6 / a)
    shift = (n - 1) * (a * agree_ordinary - 1)
    z = ((a - 1) + shift - chi2) / math.sqrt(2 * (a - 1) + 4 * shift)
    classes = [0 if c in _DIGITS else 1 if c in _LOWER else 2
               for c in body if c.isalnum()]
    changes = sum(x != y for x, y in zip(classes, classes[1:]))
    p_change = _binomial_upper(changes, max(1, len(classes) - 1), ORDINARY_CHANGE)
    return {"encoding": name, "length": n, "p_uniform": p_uniform, "p_runs": min(1.0, p_runs),
            "p_serial": min(1.0, p_serial), "p_random": p_random,
            "p_ordinary": _fisher([_upper_tail(z), p_change])}


def step_up(tests: list[tuple[float, int]], level: float = FDR) -> list[bool]:
    """Weighted Benjamini-Hochberg. ``tests``: (p, length); weights have mean 1."""
    m = len(tests)
    if not m:
        return []
    raw = [min(2.0, n / LENGTH_UNIT) for _, n in tests]
    mean = sum(raw) / m
    q = [p / (w / mean) for (p, _), w in zip(tests, raw)]
    cut, order = 0.0, sorted(q)
    for i, x in enumerate(order, 1):
        if x <= level * i / m:
            cut = x
    return [x <= cut and cut > 0 or x == 0.0 for x in q]


def _pieces(token: str, s: int, out: set[tuple[int, int]]) -> set[tuple[int, int]]:
    """Spans of the parts of a token (which starts at ``s``) that are worth a test of their own."""
    body = token.rstrip("=")
    for cut in [_PATH] + (_MIXED if infer_encoding(body) is None else []):
        for m in cut.finditer(body):
            if TOKEN_LEAST <= m.end() - m.start() < len(body):
                # Padding goes with the last part.
                part = token[m.start():] if m.end() == len(body) else m.group()
                span = (s + m.start(), s + m.start() + len(part))
                if span not in out:
                    out.add(span)
                    _pieces(part, span[0], out)
    return out


def _accepted(text: str, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Those of a family of spans that the battery and the step-up take for random."""
    held = [(span, r) for span in spans if (r := battery(text[span[0]:span[1]]))]
    chosen = step_up([(r["p_ordinary"], r["length"]) for _, r in held])
    return [span for (span, r), ok in zip(held, chosen) if ok and r["p_random"] >= RANDOM_LEVEL]


def scan_text(text: str) -> list[tuple[int, int, str]]:
    """All spans of one text: base finds, then accepted random tokens elsewhere."""
    base = base_spans(text)
    known = Cover(len(text), base)
    tokens = [m.span() for m in _TOKEN.finditer(text)]
    whole = _accepted(text, [x for x in tokens if not known.hits(*x)])
    pieces: set[tuple[int, int]] = set()
    for s, e in set(tokens).difference(whole):
        _pieces(text[s:e], s, pieces)
    parts: list[tuple[int, int]] = []
    last = -1
    # Longest first among those that start together; a part inside a longer one adds nothing.
    found = _accepted(text, sorted(x for x in pieces if not known.hits(*x)))
    for s, e in sorted(found, key=lambda x: (x[0], -x[1])):
        if e > last:
            parts.append((s, e))
            last = e
    return base + [(s, e, "random") for s, e in sorted(whole + parts)]


def scan_secrets(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows ``doc_id``, ``spans`` array of (kind, start, end) in code points."""
    def work(ids, texts):
        return ids, [[{"kind": k, "start": s, "end": e} for s, e, k in
                      sorted(scan_text(t), key=lambda x: (x[0], KINDS[x[2]]))] for t in texts]
    return map_batches(id_and_text(df, id_col, text_col),
                       "doc_id long, spans array<struct<kind:string,start:long,end:long>>", work)


def secret_digest(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: counts by base kind, the base spans' hash, and all spans as text."""
    def joined(kinds: str):
        kept = F.expr(f"filter(spans, x -> x.kind in ({kinds}))") if kinds else F.col("spans")
        return F.array_join(F.transform(kept, lambda x: F.concat_ws(
            ":", x.kind, x.start.cast("string"), x.end.cast("string"))), ",")
    found = scan_secrets(df, id_col, text_col)
    count = lambda k: F.size(F.filter("spans", lambda x: x.kind == k)).cast("long")
    return found.select(
        "doc_id", *[count(k).alias(f"n_{k}") for k in ("assign", "access", "hex")],
        F.sha2(joined("'assign','access','hex'"), 256).alias("base_sha256"),
        joined("").alias("spans"), count("random").alias("n_random"))
