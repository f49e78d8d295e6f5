"""Operator 4, secret scans: fixed patterns, and Markov models of random strings and ordinary identifiers.

Every stretch of identifier characters that the patterns leave over, also the rest of a run that a pattern
takes a part of, is scored from ``SHORTEST`` characters on by the mean log-likelihood ratio per character of two second-order character models.  They are trained from labelled samples of bounded
size (``most_samples`` strings a class): random strings are the secrets the patterns find in sampled
texts, with strings drawn from the usual alphabets; ordinary ones are the sampled texts' words, alone and
joined in the usual ways, and digits.  A sampled word that a first model, of the words shorter than ``SHORTEST``,
takes for random is not ordinary.  The threshold lies above every ordinary training string.

Spans are code points, end exclusive.  Defined results: null or empty text: no spans.  Repeated rows: one
result each.  Empty table: only the drawn strings train the models.  Extra columns are ignored.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import spans

KINDS = ("assign", "access", "hex", "random")
_KEY = re.compile(rb"password|passwd|secret|token|api_?key", re.I)
_ASSIGN = re.compile(rb"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I)
_ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
_RUN = re.compile(rb"[A-Za-z0-9+/_=-]{20,}")
_HEX = np.isin(np.arange(256), np.frombuffer(b"0123456789abcdef", np.uint8))
_IDENTIFIER = np.isin(np.arange(256), np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-", np.uint8))
ALPHABETS = ["0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", "abcdefghijklmnopqrstuvwxyz0123456789",
             "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-"]
LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
_CODE = np.zeros(256, np.int64)
for _i, _c in enumerate(LETTERS):
    _CODE[ord(_c)] = _i + 1                       # 0: before the string
SHORTEST = 12

Span = tuple[int, int, int]                       # start byte, kind, end byte


class Model(NamedTuple):
    log_ratio: np.ndarray                         # [before last, last, next]
    threshold: float


def base_spans(text: bytes) -> list[Span]:
    """The three fixed patterns, leftmost and non-overlapping each."""
    out, at = [], 0
    while k := _KEY.search(text, at):
        m = _ASSIGN.match(text, k.start())
        at = m.end() if m else k.start() + 1
        if m and m.end(1) - m.start(1) >= 8:
            out.append((m.start(), 0, m.end()))
    if b"AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 16]
    return out


def long_runs(letters: np.ndarray, off: np.ndarray, shortest: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of marked letters, of a least length, that stay within one text."""
    starts, ends = spans.runs(letters, off)
    keep = ends - starts >= shortest
    return starts[keep], ends[keep]


def score(strings: list[bytes], log_ratio: np.ndarray) -> np.ndarray:
    """Mean log-likelihood ratio per character of each string."""
    out = np.zeros(len(strings))
    for i, s in enumerate(strings):
        x = np.concatenate([[0, 0], _CODE[np.frombuffer(s, np.uint8)]])
        out[i] = log_ratio[x[:-2], x[1:-1], x[2:]].mean() if len(s) else 0.0
    return out


def _scan(c: spans.Chunk, model: Model | None) -> list[list[Span]]:
    """Spans of each text in byte positions of that text."""
    raw, n = c.buf.tobytes(), len(c.off) - 1
    low = raw.lower()
    found: list[list[Span]] = [[] for _ in range(n)]
    if b"AKIA" in raw or any(k in low for k in (b"passw", b"secret", b"token", b"api")):
        for i in range(n):
            found[i] += base_spans(raw[c.off[i]:c.off[i + 1]])
    for a, b in zip(*long_runs(_HEX[c.buf], c.off, 32), strict=True):
        i = int(spans.doc_of(c.off, a))
        found[i].append((int(a - c.off[i]), 2, int(b - c.off[i])))
    if model is not None:
        free = _IDENTIFIER[c.buf]
        for start, base in zip(c.off, found):
            for a, _, b in base:
                free[start + a:start + b] = False
        starts, ends = long_runs(free, c.off, SHORTEST)
        llr = score([raw[a:b] for a, b in zip(starts, ends, strict=True)], model.log_ratio)
        for a, b in zip(starts[llr >= model.threshold], ends[llr >= model.threshold], strict=True):
            i = int(spans.doc_of(c.off, a))
            found[i].append((int(a - c.off[i]), 3, int(b - c.off[i])))
    return [sorted(x) for x in found]


def _samples(docs: DataFrame, most_docs: int) -> DataFrame:
    """(secret, string) of a bounded number of texts, those of least seeded hash of doc_id."""
    ids = spans.smallest_by_hash(docs, "doc_id", most_docs)
    chosen = docs.sparkSession.createDataFrame([(i,) for i in ids], "doc_id long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for c in spans.chunks(batches):
            raw, rows = c.buf.tobytes(), set()
            for i, spans_ in enumerate(_scan(c, None)):
                text = raw[c.off[i]:c.off[i + 1]]
                for a, kind, b in spans_:
                    value = _ASSIGN.match(text[a:b])[1] if kind == 0 else text[a:b]
                    rows |= {(True, r) for r in _RUN.findall(value)}
                    text = text[:a] + b" " * (b - a) + text[b:]
                rows |= {(False, w) for w in re.findall(rb"[A-Za-z0-9+/_=-]{4,}", text)}
            yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in rows], pa.bool_()), pa.array([s.decode() for _, s in rows], pa.string())], ["secret", "string"])

    return spans.texts_of(docs).join(F.broadcast(chosen), "doc_id", "left_semi").mapInArrow(run, "secret boolean, string string")


def _counts(strings: list[bytes]) -> np.ndarray:
    n = len(LETTERS) + 1
    out = np.zeros(n ** 3)
    for s in strings:
        x = np.concatenate([[0, 0], _CODE[np.frombuffer(s, np.uint8)]])
        np.add.at(out, (x[:-2] * n + x[1:-1]) * n + x[2:], 1)
    return out.reshape(n, n, n)


def _log_p(counts: np.ndarray) -> np.ndarray:
    """Second-order model that falls back to first order and to the letters' frequencies."""
    zero = counts.sum((0, 1)) + 0.5
    zero /= zero.sum()
    first = counts.sum(0) + 20 * zero
    first /= first.sum(-1, keepdims=True)
    second = counts + 20 * first
    return np.log(second / second.sum(-1, keepdims=True))


def fit(docs: DataFrame, most_docs: int = 2_000, most_samples: int = 5_000, seed: int = 11) -> Model:
    """Both models and the threshold, from bounded labelled samples."""
    found = spans.texts_of(docs).transform(_samples, most_docs)
    secret = [s.encode() for s in spans.smallest_by_hash(found.where("secret"), "string", most_samples)]
    words = sorted(spans.smallest_by_hash(found.where("not secret"), "string", most_samples))
    rng = random.Random(seed)
    drawn = ["".join(rng.choices(a, k=rng.randint(SHORTEST, 64))).encode() for a in ALPHABETS for _ in range(most_samples // len(ALPHABETS))]

    def trained(words: list[str]) -> tuple[np.ndarray, float, float]:
        """The log ratio, the highest score of an ordinary string, and the score that 95 % of the random ones reach."""
        plain = [w.encode() for w in words]
        for _ in range(most_samples if words else 0):
            parts = [rng.choice(words) for _ in range(rng.randint(2, 5))]
            plain.append(rng.choice(["_".join(parts), "-".join(parts), "/".join(parts), "".join(p.capitalize() for p in parts), "".join(parts), "_".join(parts).upper(), "_".join(parts) + str(rng.randint(0, 2030))]).encode())
        plain += ["".join(rng.choices("0123456789", k=rng.randint(4, 24))).encode() for _ in range(most_samples // 10 if words else 0)]
        log_ratio = _log_p(_counts(secret + drawn)) - _log_p(_counts(plain))
        ordinary = score([s for s in plain if len(s) >= SHORTEST], log_ratio)
        odd = np.sort(score(secret + drawn, log_ratio))
        return log_ratio, float(ordinary.max()) if len(ordinary) else 0.0, float(odd[len(odd) // 20])

    log_ratio, top, usual = trained([w for w in words if len(w) < SHORTEST])
    likely = score([w.encode() for w in words], log_ratio) >= max(top, usual)
    log_ratio, top, usual = trained([w for w, x in zip(words, likely, strict=True) if len(w) < SHORTEST or not x])
    return Model(log_ratio.astype(np.float32), top + max(0.05, 0.25 * (usual - top)))


def scan(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, spans: array of kind, start, end) of every whole text, by start, then kind as listed."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
        for c in spans.chunks(batches):
            rows = []
            for i, found in enumerate(_scan(c, model)):
                if found:
                    points = spans.code_points(c.buf[c.off[i]:c.off[i + 1]])
                    found = [{"kind": KINDS[k], "start": int(points[a]), "end": int(points[b])} for a, k, b in found]
                rows.append(found)
            yield pa.RecordBatch.from_arrays([c.ids, pa.array(rows, pa.list_(kind))], ["doc_id", "spans"])

    return spans.texts_of(docs).mapInArrow(run, "doc_id long, spans array<struct<kind:string,start:long,end:long>>")


def digests(scanned: DataFrame) -> DataFrame:
    def joined(c):
        return F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    base = F.filter("spans", lambda s: s["kind"] != "random")
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    return scanned.select("doc_id", count("assign"), count("access"), count("hex"), F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"), count("random"))


def redact(docs: DataFrame, model: Model, mark: str = "[SECRET]") -> DataFrame:
    """``docs``, all columns, with each run of spans in the text replaced; n_chars, if there, follows the text."""
    text_at, chars_at = docs.columns.index("text"), docs.columns.index("n_chars") if "n_chars" in docs.columns else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(text_at).to_pylist()
            done = 0
            for c in spans.chunks([batch.select([text_at, text_at])]):
                raw = c.buf.tobytes()
                for i, found in enumerate(_scan(c, model)):
                    if found:
                        text, out, at = raw[c.off[i]:c.off[i + 1]], [], 0
                        for a, _, b in found:
                            if a >= at:
                                out += [text[at:a], mark.encode()]
                            at = max(at, b)
                        texts[done + i] = b"".join([*out, text[at:]]).decode()
                done += len(c.off) - 1
            cols = list(batch.columns)
            cols[text_at] = pa.array(texts, pa.string()).cast(cols[text_at].type)
            if chars_at is not None:
                cols[chars_at] = pa.array([c if t is None else len(t) for t, c in zip(texts, cols[chars_at].to_pylist(), strict=True)], cols[chars_at].type)
            yield pa.RecordBatch.from_arrays(cols, schema=batch.schema)

    return docs.mapInArrow(run, docs.schema)
