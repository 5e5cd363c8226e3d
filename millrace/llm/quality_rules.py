"""Quality rules as a bitmask ledger (operator 5).

``build_ledger`` reads every text once, stores its measurements and one failure
bit per rule. Policies are versioned sets of bits: applying one, changing one
or asking what a rule costs never touches the text again, it is bit arithmetic
and a grouped count over the ledger.

Rules only use integers, so a ledger is the same on every machine. Words are
``[^\\x20\\x09-\\x0D]+``; they are counted on UTF-8 bytes, whose ASCII white
space is exactly that set. Three-word windows are compared by exact word
numbers, not by hashes.

Defined results: a null or empty text has no words and fails ``short``; null
ids are kept; repeated rows give repeated results; an empty table gives an
empty ledger; a very long text is one numpy pass over its own words.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._batches import id_and_text, map_batches

SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"

MEASURES = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines",
            "n_repeat_words", "n_upper_words"]

#: name, SQL condition of failure over the measures. Position is the bit; never
#: reorder, only append, so that stored masks keep their meaning.
RULES: list[tuple[str, str]] = [
    ("short", "n_words < 50"),
    ("repeats", "100 * n_repeat_words > 50 * n_words"),
    ("symbols", "10 * n_symbols > n_words"),
    ("dup_lines", "100 * n_dup_lines > 30 * n_lines"),
    ("word_length", "word_chars < 2 * n_words or word_chars > 15 * n_words"),
    ("shouting", "100 * n_upper_words > 40 * n_words"),
]
BIT = {name: 1 << i for i, (name, _) in enumerate(RULES)}
BASE = BIT["short"] | BIT["repeats"]

#: Versioned policies: a document is kept if it fails none of the policy's bits.
POLICIES: dict[str, int] = {
    "base": BASE,
    "v1": BASE | BIT["symbols"] | BIT["dup_lines"],
    "v2": BASE | BIT["symbols"] | BIT["dup_lines"] | BIT["word_length"] | BIT["shouting"],
}
CURRENT = "v2"


def repeated_words(words: list[bytes]) -> int:
    """Words inside three-word windows that the text holds at least twice."""
    n = len(words)
    if n < 4:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, n)
    v = len(number)
    if v < 1 << 21:                       # three numbers fit one integer
        key = (ids[:-2] * v + ids[1:-1]) * v + ids[2:]
    else:                                 # number the pairs first, then the triples
        _, pair = np.unique(ids[:-2] * v + ids[1:-1], return_inverse=True)
        key = pair * v + ids[2:]
    order = np.argsort(key, kind="stable")
    k = key[order]
    same = k[1:] == k[:-1]
    twice = np.zeros(n - 2, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(n, bool)
    covered[:-2] |= twice
    covered[1:-1] |= twice
    covered[2:] |= twice
    return int(covered.sum())


def measure(text: str) -> tuple[int, ...]:
    """The values of MEASURES for one text."""
    words = text.encode("utf-8").split()
    chars = len(text) - sum(text.count(c) for c in SPACES)
    symbols = sum(text.count(c) for c in SYMBOLS)
    lines = [x for x in text.split("\n") if x.strip(SPACES)]
    upper = sum(w.isupper() for w in words)
    return (len(words), chars, symbols, len(lines), len(lines) - len(set(lines)),
            repeated_words(words), upper)


def build_ledger(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, the measures and ``failed``, the mask of failed rules.

    A word counts as upper when it has an ASCII capital and no ASCII small letter.
    """
    def work(ids, texts):
        return [ids, *zip(*(measure(t) for t in texts), strict=True)]
    measured = map_batches(id_and_text(df, id_col, text_col),
                           "doc_id long, " + ", ".join(f"{m} long" for m in MEASURES), work)
    mask = " | ".join(f"if({cond}, {BIT[name]}L, 0L)" for name, cond in RULES)
    return measured.withColumn("failed", F.expr(mask))


def apply_policy(ledger: DataFrame, policy: str | int = CURRENT) -> DataFrame:
    """The ledger with ``kept`` under a policy (its name, or a mask of bits)."""
    bits = POLICIES[policy] if isinstance(policy, str) else policy
    return ledger.withColumn("kept", F.col("failed").bitwiseAND(F.lit(bits).cast("long")) == 0)


def ablations(ledger: DataFrame, policy: str | int = CURRENT) -> DataFrame:
    """Per rule of a policy: documents failing it, failing nothing else, and kept without it.

    One grouped count over the mask (at most 2^rules groups) and a small expansion.
    """
    bits = POLICIES[policy] if isinstance(policy, str) else policy
    masks = (ledger.groupBy(F.col("failed").bitwiseAND(F.lit(bits).cast("long")).alias("m"))
             .agg(F.count(F.lit(1)).alias("n")))
    rules = F.array(*[F.struct(F.lit(name).alias("rule"), F.lit(BIT[name]).cast("long").alias("bit"))
                      for name, _ in RULES if BIT[name] & bits])
    return (masks.select("m", "n", F.explode(rules).alias("r")).groupBy(F.col("r.rule").alias("rule"))
            .agg(F.sum(F.when(F.col("m").bitwiseAND(F.col("r.bit")) != 0, F.col("n")).otherwise(0)).alias("n_failed"),
                 F.sum(F.when(F.col("m") == F.col("r.bit"), F.col("n")).otherwise(0)).alias("n_only"),
                 F.sum(F.when((F.col("m") == 0) | (F.col("m") == F.col("r.bit")), F.col("n"))
                       .otherwise(0)).alias("n_kept_without")))


def quality_report(df: DataFrame) -> DataFrame:
    """The digest of operator 5: measures, base verdict and the current policy's verdict."""
    kept = apply_policy(build_ledger(df))
    base = F.col("failed").bitwiseAND(F.lit(BASE).cast("long")) != 0
    return kept.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                       "n_repeat_words", base.alias("base_failed"), "kept", "failed")


SQL = """
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents
), w AS (
  SELECT r, doc_id, t, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS words,
         [x FOR x IN string_split(t, chr(10)) IF regexp_matches(x, '[^\\x20\\x09-\\x0D]')] AS lines
  FROM d
), grams AS (
  SELECT r, i, words[i] AS a, words[i + 1] AS b, words[i + 2] AS c
  FROM (SELECT r, words, unnest(range(1, len(words) - 1)) AS i FROM w)
), twice AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, a, b, c) AS k FROM grams) WHERE k > 1
), rep AS (
  SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM twice) GROUP BY r
), m AS (
  SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(t, '[\\x20\\x09-\\x0D]', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(lines) AS BIGINT) AS n_lines,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words,
         CAST(len([x FOR x IN words IF regexp_matches(x, '[A-Z]') AND NOT regexp_matches(x, '[a-z]')]) AS BIGINT) AS n_upper_words
  FROM w LEFT JOIN rep USING (r)
), f AS (
  SELECT *, CAST((CASE WHEN n_words < 50 THEN 1 ELSE 0 END)
    + (CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END)
    + (CASE WHEN 10 * n_symbols > n_words THEN 4 ELSE 0 END)
    + (CASE WHEN 100 * n_dup_lines > 30 * n_lines THEN 8 ELSE 0 END)
    + (CASE WHEN word_chars < 2 * n_words OR word_chars > 15 * n_words THEN 16 ELSE 0 END)
    + (CASE WHEN 100 * n_upper_words > 40 * n_words THEN 32 ELSE 0 END) AS BIGINT) AS failed
  FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (failed & 3) <> 0 AS base_failed, failed = 0 AS kept, failed FROM f
"""
