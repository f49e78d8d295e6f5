"""Operator 6, token counts by section through offset mapping.

Each whole document is encoded once.  The byte lengths of its tokens give every token's span, the spans
meet the section bounds in one sorted interval join, and ``rule`` places a token that crosses a bound:
``start`` (section of its first character), ``end`` (of its last) or ``majority`` (of most of its
characters, the earlier one at a tie).  A token that starts inside a character belongs to that character.

Defined results: null or empty text: one section 0 from 0 to 0 with no tokens.  Sections cover the text:
a bound outside it or repeated is ignored.  Repeated rows: counted each.  Extra columns are ignored.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import spans
from .bpe import public_path

RULES = ("start", "end", "majority")


@lru_cache(2)
def _encoder(path: str):
    import public_tokenizers
    import tiktoken
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    lengths = np.zeros(max(ranks.values()) + 1, np.int64)
    for token, i in ranks.items():
        lengths[i] = len(token)
    return tiktoken.Encoding("sections", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}), lengths


def place(first: np.ndarray, last: np.ndarray, starts: np.ndarray, rule: str) -> np.ndarray:
    """The section of each token, from its first and last character and the sections' sorted starts."""
    a, b = (np.searchsorted(starts, x, side="right") - 1 for x in (first, last))
    if rule == "start":
        return a
    if rule == "end":
        return b
    out = a.copy()
    for i in np.flatnonzero(a != b):           # only tokens that cross a bound
        inside = starts[a[i] + 1:b[i] + 1]
        out[i] = a[i] + np.argmax(np.diff([first[i], *inside, last[i] + 1]))
    return out


def attribute(sectioned: DataFrame, rule: str = "majority", path: str | None = None) -> DataFrame:
    """One row per document and section of (doc_id, text, bounds); bounds: code points at which sections start.
    Without a column ``bounds`` the sections are the text's lines; a line break ends the line before it."""
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    lines = "bounds" not in sectioned.columns
    path = path or public_path("byte_bpe_50k.tiktoken")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, lengths = _encoder(path)
        for batch in batches:
            all_bounds, at = ([] if lines else batch.column(2).to_pylist()), 0
            for c in spans.chunks([batch]):
                cols: list[list[np.ndarray]] = [[], [], [], [], []]
                raw = c.buf.tobytes()
                for i, (lo, hi) in enumerate(zip(c.off[:-1].tolist(), c.off[1:].tolist(), strict=True)):
                    points = spans.code_points(c.buf[lo:hi])
                    n = int(points[-1])
                    if lines:
                        inner = points[np.flatnonzero(c.buf[lo:hi] == 10) + 1]
                        starts = np.concatenate([[0], inner[inner < n]])
                    else:
                        starts = np.array(sorted({0, *(x for x in all_bounds[at] or () if x is not None and 0 < x < n)}), np.int64)
                        at += 1
                    ends = np.cumsum(lengths[np.array(encoder.encode_ordinary(raw[lo:hi].decode()), np.int64)]) if hi > lo else np.zeros(0, np.int64)
                    begins = np.concatenate([[0], ends[:-1]])[:len(ends)].astype(np.int64)
                    section = place(points[begins + 1] - 1, points[ends] - 1, starts, rule) if len(ends) else ends
                    for col, x in zip(cols, (np.full(len(starts), i), np.arange(len(starts)), starts, np.append(starts[1:], n), np.bincount(section, minlength=len(starts))), strict=True):
                        col.append(x)
                rows = [np.concatenate(x).astype(np.int64) for x in cols]
                yield pa.RecordBatch.from_arrays([c.ids.take(pa.array(rows[0])), *map(pa.array, rows[1:])], ["doc_id", "section", "start", "end", "n_tokens"])

    return sectioned.select("doc_id", "text", *([] if lines else ["bounds"])).mapInArrow(run, "doc_id long, section long, start long, end long, n_tokens long")


def by_line(docs: DataFrame) -> DataFrame:
    """Sections of a document are its lines: (doc_id, text), whose line starts the encoding task finds itself."""
    return spans.texts_of(docs)


def by_field(rows: DataFrame, key: str, fields: list[str], separator: str = "\n") -> DataFrame:
    """One document per row from several columns, each a section; null fields are empty."""
    parts = [F.coalesce(F.col(f).cast("string"), F.lit("")) for f in fields]
    lengths = [F.length(p) + len(separator) for p in parts]
    bounds, total = [], F.lit(0)
    for n in lengths[:-1]:
        total = total + n
        bounds.append(total.cast("long"))
    return rows.select(F.col(key).cast("long").alias("doc_id"), F.concat_ws(separator, *parts).alias("text"), F.array(*bounds).cast("array<bigint>").alias("bounds"))
