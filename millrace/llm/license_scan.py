"""License scan: exact base phrases and fuzzy short-notice search (operator 8).

Notices are compared on normalised words (A-Z lowered, everything but digits,
letters and non-ASCII taken as a break, one space between words). A notice of
length L may hold ``errors(L)`` edits. Cut into one piece more than that, at
least one piece of every admissible copy must be untouched, so an Aho-Corasick
search for the pieces finds all candidate places; the ``regex`` library's
bounded-error matching then verifies the edits around each seed and gives the
span. Notices are short and fixed, so the work is linear in the text.

Defined results: a null or empty text has no words, no labels and score 0; null
ids are kept; repeated rows give repeated results; overlapping finds of one
label are merged to the best one (ties: the first).
"""

from __future__ import annotations

import functools
import re

import ahocorasick
import regex
from pyspark.sql import DataFrame

from ._batches import Cover, id_and_text, map_batches

# Base phrases and their labels.
BASE_PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: Notices of the fuzzy search, as normalised words.
NOTICES: list[tuple[str, str]] = [
    ("apache-2.0", "licensed under the apache license version 2 0"),
    ("apache-2.0", "spdx license identifier apache 2 0"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy"),
    ("mit", "licensed under the mit license"),
    ("mit", "spdx license identifier mit"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee"),
    ("isc", "licensed under the isc license"),
    ("bsd", "redistribution and use in source and binary forms"),
    ("bsd-2-clause", "spdx license identifier bsd 2 clause"),
    ("bsd-3-clause", "spdx license identifier bsd 3 clause"),
    ("gpl", "gnu general public license"),
    ("gpl-2.0", "gnu general public license version 2"),
    ("gpl-3.0", "gnu general public license version 3"),
    ("lgpl", "gnu lesser general public license"),
    ("agpl", "gnu affero general public license"),
    ("cc-by", "licensed under cc by 4 0"),
    ("cc-by", "creative commons attribution"),
    ("cc-by-3.0", "creative commons attribution 3 0 unported"),
    ("cc-by-4.0", "creative commons attribution 4 0 international"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-nc", "creative commons attribution noncommercial"),
    ("cc-by-nd", "creative commons attribution noderivatives"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("cc-by-sa", "creative commons attribution sharealike"),
    ("cc0", "creative commons zero v1 0 universal"),
    ("cc0", "licensed under cc0 1 0"),
    ("mpl", "mozilla public license"),
    ("mpl-2.0", "mozilla public license version 2 0"),
    ("epl-2.0", "eclipse public license version 2 0"),
    ("bsl-1.0", "boost software license version 1 0"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("zlib", "this software is provided as is without any express or implied warranty"),
    ("wtfpl", "do what the fuck you want to public license"),
    ("odbl", "open data commons open database license"),
    ("ofl-1.1", "sil open font license version 1 1"),
    ("reserved", "all rights reserved"),
]


def errors(length: int) -> int:
    """Edits allowed in a notice: one for every 14 characters, at least one."""
    return max(1, length // 14)


# \x00-\x2F \x3A-\x60 \x7B-\x7F after lowering; bytes from 0x80 are parts of words.
_TABLE = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
    for b in range(256))
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_CAPITALS = {c: c + 32 for c in range(65, 91)}


@functools.cache
def _seeds() -> ahocorasick.Automaton:
    """Every notice cut into errors + 1 pieces: piece -> [(notice, offset in notice)]."""
    pieces: dict[str, list[tuple[int, int]]] = {}
    for k, (_, notice) in enumerate(NOTICES):
        parts = errors(len(notice)) + 1
        cuts = [len(notice) * i // parts for i in range(parts + 1)]
        for a, b in zip(cuts, cuts[1:]):
            pieces.setdefault(notice[a:b], []).append((k, a))
    found = ahocorasick.Automaton()
    for piece, places in pieces.items():
        found.add_word(piece, (len(piece), places))
    found.make_automaton()
    return found


@functools.cache
def _patterns() -> list:
    return [regex.compile(r"(?be)(?<!\S)(?:%s){e<=%d}(?!\S)" % (regex.escape(n, literal_spaces=True), errors(len(n))))
            for _, n in NOTICES]


def fuzzy_notices(joined: str) -> list[tuple[int, int, int, int]]:
    """(notice, start, end, edits) in a normalised text; best non-overlapping per notice."""
    windows: dict[int, set[tuple[int, int]]] = {}
    for end, (size, places) in _seeds().iter(joined):
        for k, offset in places:
            n = len(NOTICES[k][1])
            slack = errors(n)
            at = end - size + 1 - offset
            windows.setdefault(k, set()).add((max(0, at - slack), min(len(joined), at + n + slack)))
    out = []
    for k, spots in windows.items():
        hits = set()
        for a, b in spots:
            # A copy may only start and end at word ends, so look at them from outside.
            m = _patterns()[k].search(joined, max(0, a - 1), min(len(joined), b + 1))
            if m and (m.start() == 0 or joined[m.start() - 1] == " ") and \
                    (m.end() == len(joined) or joined[m.end()] == " "):
                hits.add((sum(m.fuzzy_counts), m.start(), m.end()))
        taken = Cover(len(joined))
        for e, a, b in sorted(hits):
            if not taken.hits(a, b):
                taken.add(a, b)
                out.append((k, a, b, e))
    return _versions(out)


_FAMILY = [re.sub("[0-9]", "#", n) for _, n in NOTICES]


def _versions(finds: list[tuple[int, int, int, int]]) -> list[tuple[int, int, int, int]]:
    """Of notices that differ in digits only, the nearest at each place (several, if they are as near)."""
    families: dict[str, list] = {}
    for f in finds:
        families.setdefault(_FAMILY[f[0]], []).append(f)
    out = []
    for family, own in families.items():
        if _FAMILY.count(family) == 1:
            out += own
            continue
        # By place: finds that overlap are one place.
        place: list = []
        for f in sorted(own, key=lambda f: f[1:3]) + [None]:
            if place and (f is None or f[1] >= max(x[2] for x in place)):
                least = min(x[3] for x in place)
                out += [x for x in place if x[3] == least]
                place = []
            place.append(f)
    return out


def scan_text(text: str) -> dict:
    """Words, base places and fuzzy finds of one text; word numbers count from 0."""
    words = text.encode("utf-8").translate(_TABLE).split()
    joined = b" ".join(words).decode("utf-8")
    padded = f" {joined} "
    places, labels = [], set()
    for phrase, label in BASE_PHRASES.items():
        needle, at, last, word = f" {phrase} ", -1, 0, 0
        while (at := padded.find(needle, at + 1)) >= 0:
            word += padded.count(" ", last, at)         # words before it, counted once
            last = at
            places.append(word)
            labels.add(label)
    finds, last, word = [], 0, 0
    for k, a, b, e in sorted(fuzzy_notices(joined), key=lambda x: x[1]):
        word += joined.count(" ", last, a)
        last = a
        finds.append({"label": NOTICES[k][0], "edits": e, "first_word": word, "n_words": joined.count(" ", a, b) + 1,
                      "similarity": 1.0 - e / len(NOTICES[k][1])})
    if finds:                               # spans in the text itself, only where something is found
        spots = [m.span() for m in _WORD.finditer(text.translate(_CAPITALS))]
        for f in finds:
            f["start"] = spots[f["first_word"]][0]
            f["end"] = spots[f["first_word"] + f["n_words"] - 1][1]
        finds.sort(key=lambda f: (f["start"], f["label"], f["end"]))
    return {"n_words": len(words), "places": places, "base": sorted(labels),
            "labels": sorted(labels | {f["label"] for f in finds}), "finds": finds,
            "score": 1.0 if places else max((f["similarity"] for f in finds), default=0.0)}


def scan_licenses(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: word count, base places, labels, score and the notices with spans and edits."""
    def work(ids, texts):
        r = [scan_text(t) for t in texts]
        return [ids, [x["n_words"] for x in r], [len(x["places"]) for x in r],
                [min(x["places"], default=None) for x in r], [max(x["places"], default=None) for x in r],
                [",".join(x["base"]) for x in r], [",".join(x["labels"]) for x in r],
                [x["score"] for x in r], [x["finds"] for x in r]]
    return map_batches(
        id_and_text(df, id_col, text_col),
        "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, "
        "labels string, score double, notices array<struct<label:string,edits:int,first_word:long,"
        "n_words:long,similarity:double,start:long,end:long>>", work)
