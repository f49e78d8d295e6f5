"""Operator 11, license scans: fuzzy search of short license notices.

A text is reduced to its words (ASCII letters in lower case), joined by single blanks.  A notice that
may hold k edits is cut into k + 1 pieces; k edits leave at least one piece whole, so every occurrence
holds an exact piece.  One automaton finds the pieces of all notices; around each hit the ``regex``
library's bounded-error matching looks for the whole notice, counts its edits and gives the span.
Notices start and end at word ends, and a notice's ``fixed`` start bears no edits.

Defined results: null or empty text: no words, no spans, score 0.  Repeated rows: one result each.
A null doc_id stays null.  Of overlapping finds of one notice the one with fewest edits stays, then the
leftmost; finds of different notices may overlap.  Extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import spans


class Notice(NamedTuple):
    label: str
    fixed: str          # words that must stand unchanged at the start, with a blank after them
    rest: str           # words that may hold edits
    edits: int          # characters inserted, deleted or replaced, at most

    @property
    def text(self) -> str:
        return self.fixed + self.rest


#: The phrases of the base rule; their unedited occurrences are the base places.
BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
#: Notices searched by default: words in lower case, one blank between.
NOTICES = (
    Notice("gpl", "gnu ", "general public license", 3),
    Notice("apache", "", "apache license", 1),
    Notice("cc-by", "", "cc by", 0),
    Notice("mit", "mit ", "license", 1),
    Notice("lgpl", "gnu ", "lesser general public license", 3),
    Notice("agpl", "gnu ", "affero general public license", 3),
    Notice("mpl", "", "mozilla public license", 2),
    Notice("epl", "", "eclipse public license", 2),
    Notice("bsd", "bsd ", "license", 1),
    Notice("bsd", "", "redistribution and use in source and binary forms with or without modification", 7),
    Notice("mit", "", "permission is hereby granted free of charge to any person obtaining a copy", 7),
    Notice("cc-by", "", "creative commons attribution", 3),
    Notice("cc-by-sa", "", "cc by sa", 0),
    Notice("cc-by-nc", "", "cc by nc", 0),
    Notice("cc0", "", "cc0", 0),
)

_WORD_BYTES = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256)).lower()
_WORD = re.compile(r"[0-9A-Za-z\x80-\U0010FFFF]+")


def pieces(text: str, n: int) -> list[tuple[int, str]]:
    """(offset, piece) of ``text`` cut into n pieces whose lengths differ by one at most."""
    cuts = [len(text) * i // n for i in range(n + 1)]
    return [(a, text[a:b]) for a, b in zip(cuts, cuts[1:])]


class Finder:
    """The automaton of all pieces and one bounded-error pattern per notice."""

    def __init__(self, notices: tuple[Notice, ...]) -> None:
        self.notices = notices
        self.patterns = [regex.compile(f"(?b) {regex.escape(n.fixed, special_only=True, literal_spaces=True)}(?:{regex.escape(n.rest, special_only=True, literal_spaces=True)}){{e<={n.edits}}} ") for n in notices]
        self.automaton = ahocorasick.Automaton()
        seeds: dict[str, list[tuple[int, int]]] = {}
        for k, notice in enumerate(notices):
            for offset, piece in pieces(notice.text, notice.edits + 1):
                seeds.setdefault(piece, []).append((k, offset))
        for piece, owners in seeds.items():
            self.automaton.add_word(piece, (len(piece), owners))
        self.automaton.make_automaton()

    def find(self, line: str) -> list[tuple[int, int, int, int]]:
        """(start, end, notice, edits) in a line of words between single blanks, by start."""
        places = {(k, end + 1 - size - offset) for end, (size, owners) in self.automaton.iter(line) for k, offset in owners}
        found = set()
        for k, at in places:
            notice = self.notices[k]
            most = notice.edits
            m = self.patterns[k].search(line, max(0, at - 1 - most), at + len(notice.text) + most + 1)
            if m:
                found.add((k, sum(m.fuzzy_counts), m.start() + 1, m.end() - 1))
        kept: list[tuple[int, int, int, int]] = []
        for k in {f[0] for f in found}:
            taken = np.zeros(len(line) + 1, bool)
            for _, edits, a, b in sorted(f for f in found if f[0] == k):
                if not taken[a:b].any():
                    taken[a:b] = True
                    kept.append((a, b, k, edits))
        return sorted(kept)


@lru_cache(4)
def _finder(notices: tuple[Notice, ...]) -> Finder:
    return Finder(notices)


SCHEMA = "doc_id long, n_words long, spans array<struct<label string, notice string, start long, end long, first_word long, last_word long, edits int>>"


def scan(docs: DataFrame, notices: tuple[Notice, ...] = NOTICES) -> DataFrame:
    """(doc_id, n_words, spans): each find with its code points (end exclusive), words and edits."""
    notices = tuple(Notice(*n) for n in notices)

    def one(raw: bytes, finder: Finder) -> tuple[int, list]:
        words = raw.translate(_WORD_BYTES).split()
        line = (b" " + b" ".join(words) + b" ").decode()
        finds = finder.find(line)
        if not finds:
            return len(words), []
        places = [m.span() for m in _WORD.finditer(raw.decode())]
        out, at, seen = [], 0, 0
        for a, b, k, edits in finds:            # blanks before a, counted on from the find before
            seen += line.count(" ", at, a)
            at = a
            last = seen - 1 + line.count(" ", a, b)
            out.append({"label": notices[k].label, "notice": notices[k].text, "start": places[seen - 1][0], "end": places[last][1],
                        "first_word": seen - 1, "last_word": last, "edits": edits})
        return len(words), out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = _finder(notices)
        kind = pa.list_(pa.struct([("label", pa.string()), ("notice", pa.string()), ("start", pa.int64()), ("end", pa.int64()),
                                   ("first_word", pa.int64()), ("last_word", pa.int64()), ("edits", pa.int32())]))
        for c in spans.chunks(batches):
            raw = c.buf.tobytes()
            rows = [one(raw[a:b], finder) for a, b in zip(c.off[:-1].tolist(), c.off[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([c.ids, pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], kind)], ["doc_id", "n_words", "spans"])

    return spans.texts_of(docs).mapInArrow(run, SCHEMA)


def digests(scanned: DataFrame) -> DataFrame:
    """Per document the base places, the labels and a score: 1 less the share of edited characters of its best find."""
    base = F.filter("spans", lambda s: (s["edits"] == 0) & s["notice"].isin(list(BASE)))
    label = F.create_map(*(F.lit(x) for pair in BASE.items() for x in pair))
    joined = lambda labels: F.array_join(F.array_sort(F.array_distinct(labels)), ",")
    best = F.array_max(F.transform("spans", lambda s: 1 - s["edits"] / F.length(s["notice"])))
    firsts = F.transform("_base", lambda s: s["first_word"])
    return scanned.withColumn("_base", base).select(
        "doc_id", "n_words", F.size("_base").cast("long").alias("n_base"),
        F.array_min(firsts).alias("first_word"), F.array_max(firsts).alias("last_word"),
        joined(F.transform("_base", lambda s: F.element_at(label, s["notice"]))).alias("base_labels"),
        joined(F.transform("spans", lambda s: s["label"])).alias("labels"),
        F.coalesce(best, F.lit(0.0)).alias("score"))
