"""License scan: fuzzy search for short notices in whole texts.

Texts become words of letters and digits. Notices are searched with up to a few edits. By the
pigeonhole principle a notice with k edits, cut in k + 1 pieces, has one piece unharmed, so an
exact search for all pieces of all notices at once finds every candidate. The regex library's
bounded-error matching then verifies the edits around each candidate and gives the span.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from heapq import heappop, heappush

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Phrases whose words must stand consecutively, and their labels. ``scan`` takes these where none are named.
PHRASES = {
    "the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

# The base phrases of ``op4_license_scan``.
BASE = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

# Notices that are searched with edits, their labels and the edits allowed.
NOTICES = {
    "released under the mit license": ("mit", 3),
    "permission is hereby granted free of charge to any person obtaining a copy": ("mit", 6),
    "licensed under the apache license version 2": ("apache-2", 4),
    "unless required by applicable law or agreed to in writing software": ("apache-2", 6),
    "attribution noncommercial": ("cc-by-nc", 2),
    "redistribution and use in source and binary forms with or without modification": ("bsd", 6),
    "gnu general public license": ("gpl", 2),
    "gnu lesser general public license": ("lgpl", 3),
    "mozilla public license": ("mpl", 2),
    "this is free and unencumbered software released into the public domain": ("unlicense", 6),
    "licensed under the creative commons attribution": ("cc-by", 4),
    "all rights reserved": ("all-rights-reserved", 1),
}

# A stretch is so many times its notice at most.
JOINED = 4

_WORDS = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
FOUND = "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, " \
    "spans array<struct<label: string, start: long, end: long, edits: int>>"


def words(text: str) -> bytes:
    """The words of a text, lower-cased A-Z, a space before and after each."""
    found = text.encode("utf-8", "surrogatepass").translate(_WORDS).split()
    return b" " + b" ".join(found) + b" " if found else b" "


def places(text: bytes, phrase: str) -> list[int]:
    """The starts of the phrase's words in ``words`` of a text, as bytes, neighbours that share a word included."""
    needle, found, at = b" " + phrase.encode() + b" ", [], -1
    while (at := text.find(needle, at + 1)) >= 0:
        found.append(at)
    return found


@dataclass(frozen=True)
class Piece:
    notice: str
    offset: int  # of the piece in its notice


class Scanner:
    """Finds notices with edits. Holds an automaton over all pieces and a fuzzy pattern for each notice."""

    def __init__(self, notices: dict[str, tuple[str, int]]):
        import ahocorasick
        import regex

        self.notices = notices
        self.patterns = {n: regex.compile(rf"(?b)(?:{regex.escape(n)}){{e<={edits}}}") for n, (_, edits) in notices.items()}
        seeds: dict[str, list[Piece]] = {}
        for notice, (_, edits) in notices.items():
            for low, high in pieces(len(notice), edits):
                seeds.setdefault(notice[low:high], []).append(Piece(notice, low))
        self.automaton = ahocorasick.Automaton()
        for seed, owners in seeds.items():
            self.automaton.add_word(seed, (len(seed), owners))
        self.automaton.make_automaton()

    def candidates(self, text: str) -> dict[str, list[tuple[int, int]]]:
        """For each notice the stretches of the text that can hold it, overlapping ones joined up to ``JOINED``
        times the notice, so that a stretch takes a bounded time however many there are in a row."""
        found: dict[str, list[tuple[int, int]]] = {}
        for end, (size, owners) in self.automaton.iter(text):
            for piece in owners:
                edits = self.notices[piece.notice][1]
                low = max(0, end + 1 - size - piece.offset - edits)
                high = min(len(text), end + 1 - size - piece.offset + len(piece.notice) + edits)
                spans = found.setdefault(piece.notice, [])
                if spans and low <= spans[-1][1] and max(high, spans[-1][1]) - min(low, spans[-1][0]) <= JOINED * len(piece.notice):
                    spans[-1] = (min(low, spans[-1][0]), max(high, spans[-1][1]))
                else:
                    spans.append((low, high))
        return found

    def search(self, text: str) -> list[tuple[str, int, int, int, float]]:
        """Label, start, end, edits and likeness of each verified notice.

        Of overlapping matches of a notice the one with fewest edits counts, of equal ones the first; what a
        stretch has before and after it is searched again.
        """
        found = []
        for notice, spans in self.candidates(text).items():
            matches: list[tuple[int, int, int, int, int]] = []

            def look(low: int, high: int) -> None:
                if match := self.patterns[notice].search(text, low, high):
                    heappush(matches, (sum(match.fuzzy_counts), match.start(), match.end(), low, high))

            for low, high in spans:
                look(low, high)
            taken: list[tuple[int, int]] = []
            while matches:
                edits, start, end, low, high = heappop(matches)
                at = bisect_left(taken, (start, end))
                over = [t for t in taken[max(0, at - 1):at + 1] if t[0] < end and start < t[1]]
                if over:
                    look(low, min(over[0][0], high))
                    look(max(over[-1][1], low), high)
                else:
                    taken.insert(at, (start, end))
                    found.append((self.notices[notice][0], start, end, edits, 1 - edits / len(notice)))
                    look(low, start)
                    look(end, high)
        return sorted(found, key=lambda f: f[1:3])


def pieces(length: int, edits: int) -> list[tuple[int, int]]:
    """``edits`` + 1 pieces of about one length that make up the notice: one of them has no edit in it."""
    cuts = [length * k // (edits + 1) for k in range(edits + 2)]
    return list(zip(cuts, cuts[1:]))


@lru_cache(maxsize=4)
def scanner(notices: tuple) -> Scanner:
    return Scanner(dict(notices))


def scan_text(text: str | None, base: dict[str, str], search: Scanner, phrases: dict[str, str] | None = None) -> tuple:
    """One row of ``scan``."""
    plain = words(text or "")
    counts, first, last, labels = 0, None, None, set()
    for phrase, label in base.items():
        if found := places(plain, phrase):
            counts += len(found)
            labels.add(label)
            low, high = plain.count(b" ", 0, found[0]), plain.count(b" ", 0, found[-1])
            first, last = low if first is None else min(first, low), high if last is None else max(last, high)
    spans = search.search(plain.decode("utf-8", "surrogatepass"))
    exact = labels | {label for phrase, label in (phrases or {}).items() if places(plain, phrase)}
    score = 1.0 if exact else max((s[4] for s in spans), default=0.0)
    every = exact | {s[0] for s in spans}
    n_words = plain.count(b" ") - 1
    return (n_words, counts, first, last, ",".join(sorted(labels)), ",".join(sorted(every)), score,
            [{"label": s[0], "start": s[1], "end": s[2], "edits": s[3]} for s in spans])


_TYPES = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(),
          pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("edits", pa.int32())]))]


def scan(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", base: dict[str, str] | None = None,
         notices: dict[str, tuple[str, int]] | None = None, phrases: dict[str, str] | None = None) -> DataFrame:
    """One row per document: ``doc_id`` and the columns of ``FOUND``.

    ``n_base`` counts every place of every base phrase; ``first_word`` and ``last_word`` are the
    smallest and largest start, null if there is none. ``labels`` holds the base labels, those of
    ``phrases``, which stand in a text word by word but are no base, and those of notices found with
    edits; ``spans`` are places in the words joined by spaces. ``score`` is the best likeness, 1 for
    a base phrase or one of ``phrases``, 0 for nothing. A null or empty text has no words.
    Rows that repeat an id are scanned each for itself, null ids stay null, other columns are
    ignored. An empty table gives an empty result.
    """
    base = PHRASES if base is None else base
    known = tuple((NOTICES if notices is None else notices).items())

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = scanner(known)
        for batch in batches:
            rows = [scan_text(value.as_py(), base, search, phrases) for value in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array([r[k] for r in rows], t) for k, t in enumerate(_TYPES)]],
                names=["doc_id", *[part.split(" ")[0] for part in
                                   ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans")]])

    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        scanned, f"doc_id {dict(docs.dtypes)[doc_id]}, {FOUND}")
