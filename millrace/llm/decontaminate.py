"""Benchmark decontamination: rare n-gram seeds and local alignment (operator 7).

Texts and test items are read as normalised words (A-Z lowered; digits, small
letters and non-ASCII characters make words). A first narrow pass counts the
items' words over all documents. An item's n-gram is *rare* if, going by these
counts, it would turn up by chance in less than one of ``RARE_WORDS`` words;
counts of words, not of n-grams, so that an often leaked item keeps its seeds.
Every item keeps at least its ``LEAST_SEEDS`` rarest ones, and the rarest one of
every five words, so that every excerpt (below) holds a seed.

A second narrow pass looks for seeds in the documents. Each hit gives a window
of the document as long as the item plus slack on both sides (hits on nearby
diagonals share one), and a Smith-Waterman alignment of item and window scores
exact, edited and partly reordered copies. A find is either

* a copy of the item: at least ``COVER`` of its words and ``SCORE`` of the perfect
  score (an item of ``LEAST_WORDS`` words or fewer may miss one word, if one of its
  rare n-grams is there, and no word if not), or
* an excerpt, whatever the item's length: ``EXCERPT`` equal words, and four more for
  each word that differs, is missing or is too many. All excerpts are found.

The test items are the stated query set. They are taken in blocks of about
``BLOCK_BYTES`` of text, one pair of passes each, so what is sent to executors
is bounded whatever the size of the benchmark, and no text is ever shuffled.

Defined results: null or empty texts and items match nothing; items of fewer than
``GRAM`` words are found as they stand; of items of four or five words, whose edit may
leave no ``GRAM`` words in a row, pairs of words that are rare together are seeds too;
null ids are kept; repeated items are reported each; repeated rows give repeated
results; a very long item or text needs memory for a few rows of the alignment; a document matching one item in several
places gives one row with its best place (ties: the first) and their number.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field, replace

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._batches import id_and_text, map_batches, slices

GRAM = 3
RARE_WORDS = 1_000_000
LEAST_SEEDS = 5
BLOCK_BYTES = 4 << 20
MATCH, MISMATCH, GAP = 2, -1, -1
#: A find needs this share of the perfect score, this share of the item's words,
#: and at least so many words (all, if the item has fewer).
SCORE, COVER, LEAST_WORDS = 0.5, 0.55, 8
#: Or this many equal words in an alignment in which an edit outweighs four of them.
EXCERPT, EDIT = 13, -4 * MATCH
#: Four equal words an edit and EXCERPT more: five of them stand in a row, however many edits.
ROW = 5

_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
               for b in range(256))


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8").translate(_TABLE).split()


@dataclass
class Items:
    """One block of test items: words as numbers from 1 (0 is any other word)."""
    ids: list
    words: list[np.ndarray]
    number: dict[bytes, int]

    @classmethod
    def of(cls, rows: Iterable[tuple]) -> Items:
        ids, words, number = [], [], {}
        for key, text in rows:
            ids.append(key)
            words.append(np.array([number.setdefault(w, len(number) + 1) for w in words_of(text or "")], np.int64))
        return cls(ids, words, number)

    def keys(self, x: np.ndarray) -> np.ndarray:
        """An integer for each n-gram (exact: a block has far fewer than 2^21 words)."""
        v = len(self.number) + 1
        return (x[:-2] * v + x[1:-1]) * v + x[2:]


@dataclass
class Seeds:
    """Rare n-grams, sorted, with the (item, offset) pairs of each."""
    items: Items
    keys: np.ndarray
    first: np.ndarray
    item: np.ndarray
    offset: np.ndarray
    rare: np.ndarray
    #: Items under GRAM words, by their words; word pairs of items of GRAM + 1 and GRAM + 2 words.
    short: dict[tuple[int, ...], list[int]] = field(default_factory=dict)
    pairs: dict[tuple[int, int], list[tuple[int, int]]] = field(default_factory=dict)


def rare_seeds(items: Items, counts: np.ndarray, total: int) -> Seeds:
    """``counts``: occurrences of each word number in the corpus of ``total`` words."""
    share = counts / max(1, total)
    key, item, offset, rare = [], [], [], []
    short: dict[tuple[int, ...], list[int]] = {}
    pairs: dict[tuple[int, int], list[tuple[int, int]]] = {}
    for i, x in enumerate(items.words):
        if len(x) < GRAM:
            if len(x):
                short.setdefault(tuple(x.tolist()), []).append(i)
            continue
        if GRAM < len(x) <= GRAM + 2:
            # An edit may leave no GRAM words in a row, but two that are rare together.
            for at in np.flatnonzero(share[x[:-1]] * share[x[1:]] <= 1 / RARE_WORDS).tolist():
                pairs.setdefault((int(x[at]), int(x[at + 1])), []).append((i, at))
        chance = share[x[:-2]] * share[x[1:-1]] * share[x[2:]]
        cut = max(1 / RARE_WORDS, np.sort(chance)[min(LEAST_SEEDS, len(chance)) - 1])
        keep = chance <= cut
        if len(x) >= EXCERPT:
            rows = np.lib.stride_tricks.sliding_window_view(chance, ROW - GRAM + 1)
            keep[rows.argmin(1) + np.arange(len(rows))] = True
        at = np.flatnonzero(keep)
        key.append(items.keys(x)[at])
        item.append(np.full(len(at), i))
        offset.append(at)
        rare.append(chance[at] <= 1 / RARE_WORDS)
    if not key:
        e = np.zeros(0, np.int64)
        return Seeds(items, e, np.zeros(1, np.int64), e, e, e > 0, short, pairs)
    k, i, o = np.concatenate(key), np.concatenate(item), np.concatenate(offset)
    order = np.lexsort((o, i, k))
    keys, first = np.unique(k[order], return_index=True)
    return Seeds(items, keys, np.append(first, len(k)), i[order], o[order], np.concatenate(rare)[order],
                 short, pairs)


def align(item: np.ndarray, window: np.ndarray, mismatch: int = MISMATCH, gap: int = GAP) -> tuple[int, int, int, int]:
    """Smith-Waterman on word numbers: (score, equal words, start, end) in the window.

    Of the matrix, every ``stride``-th row is kept; the rows between two of them are made
    again when the path is followed back, so memory grows with the window and the
    root of the item's length.
    """
    n, m = len(item), len(window)
    slope = np.arange(m + 1, dtype=np.int32) * -gap
    stride = max(16, math.isqrt(n))

    def rows(first: np.ndarray, start: int, stop: int):
        """Rows start + 1 .. stop, from the row ``first`` at ``start``."""
        h = first
        for i in range(start + 1, stop + 1):
            row = np.zeros(m + 1, np.int32)
            row[1:] = h[:-1] + np.where(window == item[i - 1], MATCH, mismatch)
            np.maximum(row, h + gap, out=row)
            np.maximum(row, 0, out=row)
            h = np.maximum.accumulate(row + slope) - slope       # gaps along the window
            yield i, h
    kept = {0: np.zeros(m + 1, np.int32)}
    best, i, j = 0, 0, 0
    for r, h in rows(kept[0], 0, n):
        if r % stride == 0:
            kept[r] = h
        top = int(h.max())
        if top > best:
            best, i, j = top, r, int(h.argmax())
    if best == 0:
        return 0, 0, 0, 0
    end, equal = j, 0
    base, block = -1, {}
    while True:
        if i - 1 < base or base < 0:
            base = max(0, i - 1) // stride * stride
            block = {base: kept[base], **dict(rows(kept[base], base, i))}
        if block[i][j] <= 0:
            return best, equal, j, end
        same = window[j - 1] == item[i - 1]
        if block[i][j] == block[i - 1][j - 1] + (MATCH if same else mismatch):
            equal += int(same)
            i, j = i - 1, j - 1
        elif block[i][j] == block[i - 1][j] + gap:
            i -= 1
        else:
            j -= 1


def needed_words(length: int, rare: bool = False) -> int:
    if rare and GRAM < length <= LEAST_WORDS:
        return length - 1
    return max(-(-int(100 * COVER) * length // 100), min(length, LEAST_WORDS))


def find_items(text: str, seeds: Seeds) -> list[tuple[int, float, int, int, int, int]]:
    """(item, score, equal words, start, end, places) for each item found in a text, in words."""
    items = seeds.items
    get = items.number.get
    words = words_of(text)
    x = np.array([get(w, 0) for w in words], np.int64)
    exact = _exact_finds(x, seeds.short)
    if len(x) < GRAM or not len(seeds.keys):
        return exact
    known = np.flatnonzero((x[:-2] > 0) & (x[1:-1] > 0) & (x[2:] > 0))
    key = items.keys(x)[known]
    at = np.searchsorted(seeds.keys, key)
    at[at == len(seeds.keys)] = 0
    hit = seeds.keys[at] == key
    spots: dict[int, dict[int, bool]] = {}
    for p, a in zip(known[hit], at[hit]):
        for s in range(seeds.first[a], seeds.first[a + 1]):
            own, d = spots.setdefault(int(seeds.item[s]), {}), int(p - seeds.offset[s])
            own[d] = own.get(d, False) or bool(seeds.rare[s])
    if seeds.pairs:
        for p in np.flatnonzero((x[:-1] > 0) & (x[1:] > 0)).tolist():
            for i, offset in seeds.pairs.get((int(x[p]), int(x[p + 1])), ()):
                spots.setdefault(i, {})[p - offset] = True
    out = []
    for i, diagonals in sorted(spots.items()):
        item = items.words[i]
        slack = max(4, len(item) // 4)
        bag = np.unique(item, return_counts=True)
        grams = np.unique(items.keys(item))
        best, places, last_end = None, 0, -1
        run: list[int] = []
        for d in [*sorted(diagonals), None]:
            if d is not None and (not run or d - run[0] <= slack):
                run.append(d)
                continue
            a = max(0, run[0] - slack)
            window = x[a:run[-1] + len(item) + slack]
            need = needed_words(len(item), any(diagonals[r] for r in run))
            run = [d] if d is not None else []
            # No alignment has more equal words than the two have words in common.
            there = np.bincount(window, minlength=len(items.number) + 1)[bag[0]] if len(items.number) < 4096 else \
                np.array([(window == w).sum() for w in bag[0]])
            score, equal, s, e = align(item, window) if np.minimum(there, bag[1]).sum() >= need else (0, 0, 0, 0)
            found = equal >= need and score >= SCORE * MATCH * len(item)
            # An excerpt has E >= EXCERPT + 4 X equal words in X + 1 rows, so E - 2 (X + 1) of its n-grams are the item's.
            if not found and len(window) >= EXCERPT and \
                    np.isin(items.keys(window), grams).sum() >= EXCERPT - GRAM + 1:
                score, equal, s, e = align(item, window, EDIT, EDIT)
                found = score >= EXCERPT * MATCH
            if found:
                if a + s >= last_end:
                    places += 1
                    last_end = a + e
                if best is None or score > best[0]:
                    best = (score, equal, a + s, a + e)
        if best:
            out.append((i, best[0] / (MATCH * len(item)), best[1], best[2], best[3], places))
    return sorted(out + exact) if exact else out


def _exact_finds(x: np.ndarray, short: dict[tuple[int, ...], list[int]]) -> list[tuple[int, float, int, int, int, int]]:
    """Items under GRAM words, as they stand: their first place, and how many do not overlap."""
    if not short:
        return []
    first: dict[tuple[int, ...], int] = {}
    places: dict[tuple[int, ...], int] = {}
    free: dict[tuple[int, ...], int] = {}
    words = x.tolist()
    for n in sorted({len(k) for k in short}):
        for p in range(len(words) - n + 1):
            k = tuple(words[p:p + n])
            if k in short and p >= free.get(k, 0):
                first.setdefault(k, p)
                places[k], free[k] = places.get(k, 0) + 1, p + n
    return sorted((i, 1.0, len(k), p, p + len(k), places[k]) for k, p in first.items() for i in short[k])


def _blocks(benchmark: DataFrame, item_col: str) -> list[Items]:
    """The items in blocks of about BLOCK_BYTES, by a hash of id and text."""
    rows = id_and_text(benchmark, item_col)
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-size // BLOCK_BYTES) or 1
    block = F.pmod(F.xxhash64("doc_id", "text"), F.lit(n))
    return [Items.of(sorted(((r.doc_id, r.text) for r in rows.filter(block == b).collect()),
                            key=lambda r: (r[0] is not None, r[0] or 0, r[1]))) for b in range(n)]


def fit_seeds(docs: DataFrame, items: Items) -> Seeds:
    """Count the block's words over all documents (one row per word reaches the driver)."""
    size = len(items.number) + 1

    def work(_ids, texts):
        n = np.zeros(size, np.int64)
        for t in texts:
            n += np.bincount(np.array([items.number.get(w, 0) for w in words_of(t)], np.int64), minlength=size)
        at = np.flatnonzero(n)
        return at, n[at]
    counts = np.zeros(size, np.int64)
    for r in (map_batches(id_and_text(docs), "w long, n long", work)
              .groupBy("w").agg(F.sum("n").alias("n")).collect()):
        counts[r.w] = r.n
    return rare_seeds(items, counts, int(counts.sum()))


def contaminated(docs: DataFrame, benchmark: DataFrame, item_col: str = "item_id") -> DataFrame:
    """One row per document and test item found in it."""
    found = None
    for items in _blocks(benchmark, item_col):
        seeds = fit_seeds(docs, items)

        def work(ids, texts, seeds=seeds):
            rows = [(d, seeds.items.ids[i], *rest) for d, t in zip(ids, texts)
                    for i, *rest in find_items(t, seeds)]
            return list(zip(*rows)) or [[]] * 7
        part = map_batches(id_and_text(docs), "doc_id long, item_id long, score double, equal_words long, "
                           "start_word long, end_word long, places long", work)
        found = part if found is None else found.unionByName(part)
    return found


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows, with all their columns, in which no test item of ``GRAM`` words or more is found
    (one or two words in common are no contamination)."""
    names = docs.columns
    at = names.index("text") if "text" in names else [n.lower() for n in names].index("text")
    kept = docs
    for items in _blocks(benchmark, "item_id"):
        seeds = replace(fit_seeds(docs, items), short={})

        def run(batches, seeds=seeds):
            for b in slices(batches):
                texts = b.column(at).to_pylist()
                yield b.filter(pa.array([not find_items(t or "", seeds) for t in texts], pa.bool_()))
        kept = kept.mapInArrow(run, kept.schema)
    return kept
