"""Byte-buffer helpers shared by the batch operators of this folder.

A ``Chunk`` is a run of whole texts laid end to end in one UTF-8 buffer, so that words, lines and
n-grams of many documents are found with a few numpy passes.  A null text counts as empty.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import materialize

CHUNK_BYTES = 2 << 20
SPACES = np.zeros(256, bool)
SPACES[[9, 10, 11, 12, 13, 32]] = True
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_BASE_INV = np.uint64(pow(int(_BASE), -1, 1 << 64))
_BYTE_VALUES = np.random.default_rng(20240607).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)


class Chunk(NamedTuple):
    ids: pa.Array          # the documents' ids as they came, nulls included
    buf: np.ndarray        # uint8, all texts end to end
    off: np.ndarray        # int64, text i is buf[off[i]:off[i + 1]]


def prepare(spark: SparkSession, rows_per_batch: int = 500) -> None:
    """Small Arrow batches, so that a batch of long texts fits a Python worker."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows_per_batch))


def texts_of(docs: DataFrame) -> DataFrame:
    """doc_id and text only, under fixed types: other columns, whatever their names, stay out."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column; nulls are empty."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0]:off[-1]], off - off[0]


def chunks(batches: Iterable[pa.RecordBatch], most: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """Cuts (doc_id, text) batches into chunks of whole texts of about ``most`` bytes."""
    for batch in batches:
        buf, off = buffers(batch.column(1))
        lo = 0
        while lo < len(off) - 1:
            hi = max(lo + 1, int(np.searchsorted(off, off[lo] + most, side="right")) - 1)
            yield Chunk(batch.column(0).slice(lo, hi - lo), buf[off[lo]:off[hi]], off[lo:hi + 1] - off[lo])
            lo = hi


def doc_of(off: np.ndarray, positions: np.ndarray) -> np.ndarray:
    return np.searchsorted(off, positions, side="right") - 1


def runs(inside: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of True that stay within one text."""
    fresh = np.zeros(len(inside) + 1, bool)
    fresh[off] = True
    before = np.empty(len(inside), bool)
    before[:1] = False
    before[1:] = inside[:-1]
    after = np.empty(len(inside), bool)
    after[-1:] = False
    after[:-1] = inside[1:]
    starts = np.flatnonzero(inside & (~before | fresh[:-1]))
    ends = np.flatnonzero(inside & (~after | fresh[1:])) + 1
    return starts, ends


def words(chunk: Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and text numbers of the words ``[^\\x20\\x09-\\x0D]+``."""
    starts, ends = runs(~SPACES[chunk.buf], chunk.off)
    return starts, ends, doc_of(chunk.off, starts)


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def hash_spans(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span, from one prefix sum over the buffer."""
    sums = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum(_BYTE_VALUES[buf] * _powers(_BASE, len(buf)), out=sums[1:])
    unit = _powers(_BASE_INV, len(buf) + 1)
    return mix((sums[ends] - sums[starts]) * unit[starts] + (ends - starts).astype(np.uint64))


def join_hashes(parts: list[np.ndarray]) -> np.ndarray:
    """Order-dependent hash of several hashes per row."""
    out = np.zeros(len(parts[0]), np.uint64)
    for p in parts:
        out = mix(out * _BASE + p)
    return out


def code_points(buf: np.ndarray) -> np.ndarray:
    """Number of code points before each byte (length + 1 entries)."""
    out = np.zeros(len(buf) + 1, np.int64)
    np.cumsum((buf & 0xC0) != 0x80, out=out[1:])
    return out


def smallest_by_hash(frame: DataFrame, column: str, n: int, seed: int = 17) -> list:
    """The n values of least seeded hash: a bounded, repeatable sample for fitting a model."""
    key = F.col(column)
    picked = frame.select(key.alias("v")).where(key.isNotNull()).distinct().orderBy(F.xxhash64("v", F.lit(seed)), "v").limit(n)
    return [r[0] for r in picked.collect()]


#: Rows of ids up to which a join by id broadcasts them; beyond it both sides are shuffled.
BROADCAST_ROWS = 1_000_000


def small_side(frame: DataFrame, most_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``frame`` marked for broadcast if its counted rows are few; it should be a written table of narrow rows."""
    return F.broadcast(frame) if frame.limit(most_rows + 1).count() <= most_rows else frame


def numbered(frame: DataFrame, by: list[Column], name: str) -> DataFrame:
    """``frame`` with each row's place, from 0, in the order ``by``.

    Ranges of the order are numbered apart; only their row counts meet, one a shuffle partition."""
    part = f"{name} part"
    ranged = materialize(frame.repartitionByRange(*by).withColumn(part, F.spark_partition_id()), "ranged")
    counts = ranged.groupBy(part).agg(F.count(F.lit(1)).alias("rows"))
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(part, F.coalesce(F.sum("rows").over(before), F.lit(0)).alias(f"{name} start"))
    row = F.row_number().over(Window.partitionBy(part).orderBy(*by))
    return ranged.join(F.broadcast(starts), part).withColumn(name, F.col(f"{name} start") + row - 1).drop(part, f"{name} start")
