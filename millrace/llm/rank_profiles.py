"""Language identification by rank-order n-gram profiles (operator 9).

A text is read as words of lower-cased letters with a space on either side, and
counted as its 1- to 3-grams inside these words. A language's profile is its
``PROFILE`` most frequent n-grams over all training documents; a document's
profile is its own most frequent ones. The out-of-place distance adds up, for
each n-gram of the document, how far its rank lies from its rank in the
language (``PROFILE`` if the language lacks it). The nearest language wins.

Ranks are by count, then shorter first, then by code points, so profiles do not
depend on partitioning; equal distances go to the language that sorts first.

Counting is one narrow pass that leaves a row per batch, language and n-gram,
summed by Spark; only the ranked profiles (languages x PROFILE rows) reach the
driver. Scoring is a second narrow pass.

Defined results: a null text, one without letters, or any text when nothing
could be learned, is ``und`` with score 0; null ids count as held out; repeated
rows count again; texts are read whole.
"""

from __future__ import annotations

import functools

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._batches import id_and_text, map_batches, pick
from ._pieces import in_groups

PROFILE = 400
UNKNOWN = "und"
FOLDS, HELD_OUT = 3, 1


@functools.cache
def _letters() -> np.ndarray:
    """Code point -> its lower-case letter, or a space for anything else."""
    table = np.full(0x110000, 32, np.uint32)
    for cp in range(0x110000):
        c = chr(cp)
        if c.isalpha():
            low = c.lower()
            table[cp] = ord(low) if len(low) == 1 else cp
    return table


class Grams:
    """The n-grams of a group of texts, as integers over the group's own alphabet.

    The alphabet is in code point order and shorter n-grams come first, so the
    integers of one group sort like the n-grams themselves in any other group.
    """

    def __init__(self, texts: list[str]):
        points = [np.frombuffer(t.encode("utf-32-le"), np.uint32) for t in texts]
        size = [len(p) + 2 for p in points]
        self.bounds = np.concatenate([[0], np.cumsum(size)])
        flat = np.full(self.bounds[-1], 32, np.uint32)
        for a, p in zip(self.bounds, points):
            flat[a + 1:a + 1 + len(p)] = p
        flat = _letters()[flat]
        present = np.unique(flat)
        self.alphabet = present[present != 32]
        self.base = len(self.alphabet) + 1                      # 0 is the space
        kind = np.int32 if self.base ** 3 + self.base ** 2 + self.base < 2 ** 31 else np.int64
        lookup = np.zeros(int(present.max()) + 1 if len(present) else 1, kind)
        lookup[self.alphabet] = np.arange(1, self.base)
        self.flat = lookup[flat]

    def of(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """Distinct n-grams of text ``i``, ascending, and their counts."""
        x = self.flat[self.bounds[i]:self.bounds[i + 1]]
        b = self.base
        a0, a1, a2 = x[:-2], x[1:-1], x[2:]
        one = a1[a1 > 0]
        two = x[:-1] * b + x[1:]
        two = two[(x[:-1] > 0) | (x[1:] > 0)]
        three = ((a0 * b + a1) * b + a2)[a1 > 0]
        all_ = np.concatenate([one, two + b, three + b * b + b])
        all_.sort()
        if not len(all_):
            return all_, all_
        edge = np.flatnonzero(np.concatenate([[True], all_[1:] != all_[:-1], [True]]))
        return all_[edge[:-1]], np.diff(edge)

    def text(self, gram: int) -> str:
        b, out = self.base, []
        n = 1 if gram < b else 2 if gram < b * b + b else 3
        gram -= 0 if n == 1 else b if n == 2 else b * b + b
        for _ in range(n):
            gram, c = divmod(gram, b)
            out.append(" " if c == 0 else chr(self.alphabet[c - 1]))
        return "".join(reversed(out))

    def number(self, gram: str) -> int:
        """Inverse of ``text``; -1 if a letter is not in this group's alphabet."""
        v = 0
        for c in gram:
            if c == " ":
                k = 0
            else:
                k = int(np.searchsorted(self.alphabet, ord(c)))
                if k == len(self.alphabet) or self.alphabet[k] != ord(c):
                    return -1
                k += 1
            v = v * self.base + k
        b = self.base
        return v + (0 if len(gram) == 1 else b if len(gram) == 2 else b * b + b)


def held_out(id_col="doc_id"):
    fold = F.crc32(F.col(id_col).cast("string")) % FOLDS
    return F.coalesce(fold == HELD_OUT, F.lit(True))


def fit_profiles(docs: DataFrame) -> dict[str, list[str]]:
    """language -> its PROFILE most frequent n-grams, from training rows with a lang."""
    rows = pick(docs, "doc_id", "text", "lang").filter(
        ~held_out() & F.col("lang").isNotNull() & F.col("text").isNotNull())
    rows = rows.select(F.make_valid_utf8("text").alias("text"), F.col("lang").cast("string").alias("lang"))

    def work(texts, langs):
        out: list[tuple] = []
        for a, b in in_groups(len(texts), lambda i: len(texts[i])):
            g = Grams(texts[a:b])
            found: dict[str, list] = {}
            for i in range(a, b):
                found.setdefault(langs[i], []).append(g.of(i - a))
            for lang, parts in found.items():
                keys = np.concatenate([k for k, _ in parts])
                n = np.concatenate([c for _, c in parts])
                grams, where = np.unique(keys, return_inverse=True)
                total = np.bincount(where, weights=n, minlength=len(grams)).astype(np.int64)
                out += [(lang, g.text(int(x)), int(c)) for x, c in zip(grams, total)]
        return list(zip(*out)) or [[], [], []]

    counts = (map_batches(rows, "lang string, gram string, n long", work)
              .groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), F.length("gram"), "gram"))
    top = counts.select("lang", "gram", rank.alias("r")).filter(F.col("r") <= PROFILE).collect()
    profiles: dict[str, list[str]] = {}
    for row in sorted(top, key=lambda x: (x.lang, x.r)):
        profiles.setdefault(row.lang, []).append(row.gram)
    return profiles


def predict_texts(texts: list[str], profiles: dict[str, list[str]]) -> list[tuple[str, float, bool]]:
    """(language, score, text has letters); score is one less the mean relative rank distance."""
    langs = sorted(profiles)
    out: list[tuple[str, float, bool]] = []
    for a, b in in_groups(len(texts), lambda i: len(texts[i])):
        g = Grams(texts[a:b])
        known = sorted({n for p in profiles.values() for x in p if (n := g.number(x)) >= 0})
        at = {n: i for i, n in enumerate(known)}
        ranks = np.full((len(langs), len(known) + 1), PROFILE, np.int32)
        there = np.zeros((len(langs), len(known) + 1), bool)
        for li, lang in enumerate(langs):
            for r, x in enumerate(profiles[lang]):
                if (n := g.number(x)) >= 0:
                    ranks[li, at[n]], there[li, at[n]] = r, True
        known_a = np.array(known, np.int64)
        for i in range(b - a):
            grams, counts = g.of(i)
            if not len(grams) or not langs:
                out.append((UNKNOWN, 0.0, bool(len(grams))))
                continue
            own = grams[np.argsort(-counts, kind="stable")[:PROFILE]]
            col = np.searchsorted(known_a, own)
            col[col == len(known_a)] = len(known_a)
            hit = np.zeros(len(own), bool)
            inside = col < len(known_a)
            hit[inside] = known_a[col[inside]] == own[inside]
            col = np.where(hit, col, len(known_a))
            gap = np.where(there[:, col], np.abs(ranks[:, col] - np.arange(len(own))), PROFILE)
            total = gap.sum(1)
            best = int(np.argmin(total))
            out.append((langs[best], float(1.0 - total[best] / (PROFILE * len(own))), True))
    return out


def identify(docs: DataFrame, profiles: dict[str, list[str]] | None = None) -> DataFrame:
    """Per row: doc_id, held_out, lang_pred, score."""
    if profiles is None:
        profiles = fit_profiles(docs)

    def work(ids, texts):
        r = predict_texts(texts, profiles)
        return [ids, [x[0] for x in r], [x[1] for x in r]]
    found = map_batches(id_and_text(docs), "doc_id long, lang_pred string, score double", work)
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
