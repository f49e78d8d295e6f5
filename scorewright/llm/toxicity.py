"""Operator 7, toxicity by compression distance.

Two zstandard dictionaries are trained, one on toxic and one on ordinary text, and each window of a few
words is compressed with both: the bytes that the toxic dictionary saves over the ordinary one are the
window's distance.  The dictionaries are trained on what tells the classes apart: the stretches of the
sampled texts made of character n-grams that one class has many times as often as the other.  Both get the
same common dictionary and the same lead-in behind that, so they differ in nothing else; the lead-in
starts every window, without which zstandard stores so short an input as it is.

A document's largest and mean distances make its score through a logistic fit on labelled texts that the
dictionaries haven't seen, shifted so that the calibrated threshold falls on ``threshold``.  Sample bounds are
parameters; every window of every whole text is scored.

Defined results: null or empty text: no windows, the lowest evidence.  Repeated rows: one result each.  Without labels of
both classes every score is 0.  A null doc_id is scored and not held out.  Extra columns are ignored (``keep_clean`` returns them).
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import spans

WINDOW_WORDS = 4
GRAMS = (5, 8)
LEVEL = 9
LEAD = bytes(range(128, 192))
THRESHOLD = 0.7


class Model(NamedTuple):
    toxic: bytes             # raw dictionary contents
    ordinary: bytes
    weights: np.ndarray      # of the standardised features, the intercept last
    mean: np.ndarray
    scale: np.ndarray


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _words(text: bytes) -> list[bytes]:
    return text.decode(errors="replace").lower().encode().split()


def _windows(words: list[bytes]) -> list[bytes]:
    return [LEAD + b" " + b" ".join(words[i:i + WINDOW_WORDS]) + b" " for i in range(0, len(words), WINDOW_WORDS)]


def _compressor(content: bytes) -> zstandard.ZstdCompressor:
    params = zstandard.ZstdCompressionParameters.from_level(LEVEL, window_log=15, write_content_size=False, write_checksum=False, write_dict_id=False, format=zstandard.FORMAT_ZSTD1_MAGICLESS)
    return zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT), compression_params=params)


def features(texts: list[bytes], model: Model) -> np.ndarray:
    """Per text: largest distance, mean of the three largest, of all, share of large ones, log of the number of windows."""
    toxic, ordinary = _compressor(model.toxic).compress, _compressor(model.ordinary).compress
    out = np.zeros((len(texts), 5))
    for i, text in enumerate(texts):
        d = np.array([len(ordinary(w)) - len(toxic(w)) for w in _windows(_words(text))], float)
        if len(d):
            top = np.sort(d)[::-1]
            out[i] = top[0], top[:3].mean(), d.mean(), (d >= 4).mean(), np.log1p(len(d))
    return out


def scores(texts: list[bytes], model: Model | None) -> np.ndarray:
    if model is None:
        return np.zeros(len(texts))
    z = np.hstack([(features(texts, model) - model.mean) / model.scale, np.ones((len(texts), 1))]) @ model.weights
    return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def _grams(word: bytes) -> set[bytes]:
    padded = b" " + word + b" "
    return {padded[i:i + n] for n in GRAMS for i in range(len(padded) - n + 1)}


def _apart(texts: list[list[bytes]], own: Counter, other: Counter, n_other: int, share: float, lift: float = 12.0) -> list[bytes]:
    """Of each text, the stretches of its words that this class has far more often."""
    marks = {g for g, n in own.items() if n >= max(3, share * len(texts)) and n / len(texts) >= lift * (other[g] + 0.5) / max(n_other, 1)}
    known, out = {}, []
    for words in texts:
        kept = []
        for w in words:
            if w not in known:
                padded = b" " + w + b" "
                inside = np.zeros(len(padded), bool)
                for n in GRAMS:
                    for i in range(len(padded) - n + 1):
                        if padded[i:i + n] in marks:
                            inside[i:i + n] = True
                known[w] = bytes(np.frombuffer(padded, np.uint8)[inside])
            if known[w]:
                kept.append(known[w])
        out += [b"".join(kept[i:i + 8]) for i in range(0, len(kept), 8)]
    return out


def _dictionary(samples: list[bytes], size: int) -> bytes:
    try:
        return zstandard.train_dictionary(size, samples, level=LEVEL).as_bytes()
    except zstandard.ZstdError:               # too few samples to train on: their most common ones
        return b"".join(s for s, _ in reversed(Counter(samples).most_common()))[-size:]


def _distinct(texts: list[bytes]) -> list[list[bytes]]:
    """Words of the texts, without texts that share rare words with one before: copies count once."""
    seen, out = set(), []
    for t in texts:
        words = _words(t)
        rare = sorted(set(words), key=lambda w: (-len(w), w))[:6]
        keys = {b" ".join(rare[i:i + 2]) for i in (0, 2, 4) if rare[i:i + 2]}
        if not keys & seen:
            out.append(words)
        seen |= keys
    return out


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.5) -> np.ndarray:
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p) + 1e-6)[:, None]).T @ x + ridge * np.eye(len(w)), x.T @ (p - y) + ridge * w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit(docs: DataFrame, labels: DataFrame, most_toxic: int = 2_000, most_ordinary: int = 6_000, most_chars: int = 20_000,
        size: int = 2_048, share: float = 0.01, threshold: float = THRESHOLD) -> Model | None:
    """Learns from at most so many labelled texts of at most so many characters, none of them held out."""
    usable = labels.where(~held_out(F.col("doc_id")))
    ids = [(i, t) for t, n in ((1, most_toxic), (0, most_ordinary)) for i in spans.smallest_by_hash(usable.where(F.col("toxic") == t), "doc_id", n)]
    marked = docs.sparkSession.createDataFrame(ids, "doc_id long, toxic int")
    rows = spans.texts_of(docs).where(F.length("text") <= most_chars).join(F.broadcast(marked), "doc_id").dropDuplicates(["doc_id"]).select("doc_id", "toxic", "text").toPandas()
    rows = rows.assign(order=[zlib.crc32(b"order%d" % i) for i in rows.doc_id]).sort_values(["order", "doc_id"])
    learn, check = rows[rows.order % 3 != 0], rows[rows.order % 3 == 0]
    by = [[t.encode() for t in learn.text[learn.toxic == k]] for k in (0, 1)]
    if not by[0] or not by[1] or check.toxic.nunique() < 2:
        return None
    plain, toxic = map(_distinct, by)
    counts = []
    for texts in (plain, toxic):
        c: Counter = Counter()
        for words in texts:
            c.update(set().union(*map(_grams, set(words))))
        counts.append(c)
    common = _dictionary([b" ".join(w[i:i + 4]) + b" " for w in plain[:400] for i in range(0, min(len(w), 60), 4)], 2 * size)
    t = _dictionary(_apart(toxic, counts[1], counts[0], len(plain), share), size)
    o = _dictionary(_apart(plain, counts[0], counts[1], len(toxic), share), size)
    o = (o + common)[:len(t)].rjust(len(t), b"\0") if len(o) < len(t) else o[-len(t):]         # equal lengths: equal distances to what follows
    model = Model(t + common + LEAD, o + common + LEAD, np.zeros(6), np.zeros(5), np.ones(5))
    x, y = features([s.encode() for s in check.text], model), check.toxic.to_numpy(float)
    mean, scale = x.mean(0), x.std(0) + 1e-9
    z = np.hstack([(x - mean) / scale, np.ones((len(x), 1))])
    w = _logistic(z, y)
    # the cut that separates the checked texts best becomes the threshold
    raw = z @ w
    cuts = np.unique(raw)
    cuts = (cuts[1:] + cuts[:-1]) / 2 if len(cuts) > 1 else cuts
    caught, wrong = (np.array([(raw[y == k] >= c).mean() for c in cuts]) for k in (1, 0))
    w[-1] += np.log(threshold / (1 - threshold)) - cuts[np.argmax(caught - 3 * wrong)]
    return model._replace(weights=w, mean=mean, scale=scale)


def _texts(c: spans.Chunk) -> list[bytes]:
    raw = c.buf.tobytes()
    return [raw[a:b] for a, b in zip(c.off[:-1].tolist(), c.off[1:].tolist(), strict=True)]


def judge(docs: DataFrame, model: Model | None, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every whole text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for c in spans.chunks(batches):
            yield pa.RecordBatch.from_arrays([c.ids, pa.array(scores(_texts(c), model))], ["doc_id", "score"])

    scored = spans.texts_of(docs).mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"))


def keep_clean(docs: DataFrame, model: Model | None, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, all columns, whose text scores below the threshold."""
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t.encode() for t in pc.fill_null(batch.column(at), "").to_pylist()]
            yield batch.filter(pa.array(scores(texts, model) < threshold))

    return docs.mapInArrow(run, docs.schema)
