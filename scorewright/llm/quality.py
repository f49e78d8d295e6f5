"""Operator 1, quality rules: hashed n-gram likelihood ratio of trusted texts against the corpus.

Two multinomials over hashed byte n-grams are counted: the corpus from every whole text, the target
from one half of a bounded sample of trusted texts (``most_labels`` ids, a parameter).  A text's score is its
mean log ratio per n-gram; one threshold, fixed from the scores of the other half and of untrusted texts,
decides every document.

Defined results: null or empty text: no words, base_failed, llr 0.  Repeated rows: one result each,
all alike.  A null doc_id stays null.  No trusted label at all: the target equals the corpus and only
the base rules decide.  Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import spans
from .spans import Chunk

N_BITS = 16
SYMBOLS = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", np.uint8))


class Model(NamedTuple):
    log_ratio: np.ndarray   # per bucket: log P(target) - log P(corpus)
    threshold: float


def grams(chunk: Chunk, n_bits: int = N_BITS) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the 3-byte and 4-byte grams of each text, and their text numbers."""
    b = chunk.buf.astype(np.uint64)
    out, docs = [], []
    for n in (3, 4):
        if len(b) < n:
            continue
        code = np.zeros(len(b) - n + 1, np.uint64)
        for i in range(n):
            code = (code << np.uint64(8)) | b[i:len(b) - n + 1 + i]
        at = np.arange(len(code))
        doc = np.repeat(np.arange(len(chunk.off) - 1), np.diff(chunk.off))[:len(code)]
        whole = at + n <= chunk.off[doc + 1]
        out.append((spans.mix(code * np.uint64(8) + np.uint64(n)) >> np.uint64(64 - n_bits))[whole].astype(np.int64))
        docs.append(doc[whole])
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(out), np.concatenate(docs)


def count_grams(docs: DataFrame, trusted: list[int], n_bits: int = N_BITS) -> tuple[np.ndarray, np.ndarray]:
    """(corpus, target) counts per bucket; each task adds up its own texts before the shuffle."""
    ids = pa.array(trusted, pa.int64())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, 1 << n_bits), np.int64)
        for c in spans.chunks(batches):
            g, doc = grams(c, n_bits)
            is_target = np.asarray(pa.compute.is_in(c.ids, ids).to_numpy(zero_copy_only=False), bool)
            total[0] += np.bincount(g, minlength=1 << n_bits)
            total[1] += np.bincount(g[is_target[doc]], minlength=1 << n_bits)
        at = np.flatnonzero(total[0])
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[0][at]), pa.array(total[1][at])], ["b", "n", "t"])

    counted = spans.texts_of(docs).mapInArrow(count, "b long, n long, t long").groupBy("b").agg(F.sum("n").alias("n"), F.sum("t").alias("t"))
    corpus, target = np.zeros(1 << n_bits), np.zeros(1 << n_bits)
    for r in counted.collect():          # at most 2 ** n_bits rows
        corpus[r.b], target[r.b] = r.n, r.t
    return corpus, target


def _llr(c: Chunk, log_ratio: np.ndarray) -> np.ndarray:
    g, doc = grams(c, int(len(log_ratio)).bit_length() - 1)
    n = np.bincount(doc, minlength=len(c.off) - 1)
    return np.bincount(doc, weights=log_ratio[g], minlength=len(c.off) - 1) / np.maximum(n, 1)


def cut_between(yes: np.ndarray, no: np.ndarray, keep_share: float) -> float:
    """The threshold from scores of trusted and other texts that the counts were not taken from.

    Among the cuts that keep ``keep_share`` of the trusted, the one that parts the two best; it lies halfway down to
    the next score of the others, and at least four standard deviations below the trusted mean, so that trusted
    texts not in the sample aren't cut off by the sample's own edge."""
    yes, no = np.sort(yes), np.sort(no)
    edges = yes[:max(1, int(len(yes) * (1 - keep_share)) + 1)]
    lost, caught = np.searchsorted(yes, edges) / len(yes), np.searchsorted(no, edges) / max(1, len(no))
    edge = edges[np.argmax(caught - lost)]
    below = no[no < edge]
    cut = (edge + below[-1]) / 2 if len(below) else edge
    return float(min(cut, yes.mean() - 4 * yes.std()))


def fit(docs: DataFrame, labels: DataFrame, most_labels: int = 20_000, keep_share: float = 0.998) -> Model:
    """Counts both multinomials and fixes the threshold on labelled texts that the target was not counted from.

    The trusted sample is dealt alternately, in its seeded order: one part is the target, the other one (with the
    untrusted sample) sets the threshold.  Labelled texts with fewer than 50 bytes say too little for that and are
    left out of it; they are judged like all others.  Without a text to set it by, only the base rules decide."""
    good = spans.smallest_by_hash(labels.where(F.col("quality") == 1), "doc_id", most_labels)
    bad = spans.smallest_by_hash(labels.where(F.col("quality") == 0), "doc_id", most_labels)
    held = good[1::2]
    corpus, target = count_grams(docs, good[::2])
    if not target.sum() or not held:
        return Model(np.zeros(len(corpus)), -np.inf)
    p = (corpus + 1) / (corpus.sum() + len(corpus))
    log_ratio = np.log((target + 100 * p) / (target.sum() + 100)) - np.log(p)   # the target is smoothed towards the corpus
    spark = docs.sparkSession
    marked = spark.createDataFrame([(i, 1) for i in held] + [(i, 0) for i in bad], "doc_id long, quality int")
    sample = spans.texts_of(docs).join(F.broadcast(marked), "doc_id", "left_semi")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for c in spans.chunks(batches):
            yield pa.RecordBatch.from_arrays([c.ids, pa.array(_llr(c, log_ratio)), pa.array(np.diff(c.off))], ["doc_id", "llr", "n"])

    rows = sample.mapInArrow(score, "doc_id long, llr double, n long").where("n >= 50").join(F.broadcast(marked), "doc_id").select("llr", "quality").toPandas()
    yes, no = rows.llr[rows.quality == 1].to_numpy(), rows.llr[rows.quality == 0].to_numpy()
    return Model(log_ratio, cut_between(yes, no, keep_share) if len(yes) else -np.inf)


def rules(c: Chunk) -> dict[str, np.ndarray]:
    """The counts of the base rules for each text."""
    n = len(c.off) - 1
    points = spans.code_points(c.buf)
    starts, ends, doc = spans.words(c)
    out = {"n_words": np.bincount(doc, minlength=n), "word_chars": np.bincount(doc, weights=points[ends] - points[starts], minlength=n).astype(np.int64)}
    marks = np.concatenate([[0], np.cumsum(SYMBOLS[c.buf])])
    out["n_symbols"] = marks[c.off[1:]] - marks[c.off[:-1]]

    lo, hi = spans.runs(c.buf != 10, c.off)
    before = np.searchsorted(starts, [lo, hi])
    has = before[1] > before[0]
    lo, hi = lo[has], hi[has]
    owner = spans.doc_of(c.off, lo)
    key = spans.join_hashes([spans.hash_spans(c.buf, lo, hi), owner.astype(np.uint64)])
    again = np.ones(len(key), bool)
    again[np.unique(key, return_index=True)[1]] = False
    out["n_dup_lines"] = np.bincount(owner[again], minlength=n)

    out["n_repeat_words"] = np.zeros(n, np.int64)
    if len(starts) > 5:
        h = spans.hash_spans(c.buf, starts, ends)
        m = len(h) - 4
        whole = np.flatnonzero(doc[:m] == doc[4:])
        key = spans.join_hashes([h[i:m + i][whole] for i in range(5)] + [doc[whole].astype(np.uint64)])
        order = np.argsort(key)
        same = key[order][1:] == key[order][:-1]
        twice = np.zeros(len(key), bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        step = np.zeros(len(h) + 1, np.int64)
        step[whole[twice]] += 1
        step[whole[twice] + 5] -= 1
        out["n_repeat_words"] = np.bincount(doc[np.cumsum(step)[:-1] > 0], minlength=n)
    return out


SCHEMA = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, llr double, kept boolean"


def judge(docs: DataFrame, model: Model) -> DataFrame:
    """One row per document: the base counts, the score and the verdict."""
    log_ratio, threshold = model

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for c in spans.chunks(batches):
            r = rules(c)
            failed = (r["n_words"] < 10) | (100 * r["n_repeat_words"] > 20 * r["n_words"])
            llr = _llr(c, log_ratio)
            cols = [c.ids, *(pa.array(r[k].astype(np.int64)) for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"))]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(failed), pa.array(llr), pa.array(~failed & (llr >= threshold))],
                                             [x.split()[0] for x in SCHEMA.split(", ")])

    return spans.texts_of(docs).mapInArrow(run, SCHEMA)
