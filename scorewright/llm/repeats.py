"""Operator 2, suffix-array dedup: bytes covered by a 50-byte string of a document with a smaller doc_id go.

Sorting every suffix would shuffle each text fifty times.  It is enough to sort the suffixes at anchors: of
the ``GRAM``-byte strings in a 50-byte window the one of least hash is the window's anchor, so equal
windows have equal anchors at equal places, and an anchor's windows lie in one short stretch around it.

Two passes.  The first counts the anchors of all texts by a hash of a few bytes (``shared``) and answers each
text with one bit per anchor: whether it stands anywhere else.  A chance collision of hashes only sends a
stretch for nothing.  The second pass sends the stretches of those anchors alone.  Stretches that a smaller document of the same
chunk has are removed there, only its own copy travels on.  Splitters sampled from the anchors' leading bytes
range-partition the rest.  A bucket sorts by three-way multikey quicksort, eight bytes a step: groups within one
document are dropped at once, the others go on to the next bytes, and what is equal on all 50 is removed from
every document but the smallest.  Equal leading bytes are always in one bucket, so nothing is compared across
buckets but for leading strings counted more than ``hot_docs`` times: their windows travel one by one, spread by
their whole content, so no bucket holds them all.

The first pass numbers anchors by task and block, so ``docs`` should be read the same way when a task is
repeated, as a table is; if it is not, the job fails rather than losing matches.

Defined results: null or empty text: 0 bytes, nothing removed.  A null doc_id comes after all others.
Equal doc_ids are not smaller than each other; repeated rows get one result each.  Texts of any length are cut
into overlapping pieces for the search.  Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from . import spans

LENGTH = 50
GRAM = 20
CHUNK_BYTES = 1 << 19
#: Bytes of stretches that a task holds before it compresses and sends them.
HELD_BYTES = 8 << 20
BUCKET_BYTES = 8 << 20
#: Bytes of text whose anchors a task notes before it sends their hashes, and that one bucket of hashes stands for.
NOTED_BYTES = 16 << 20
#: Bits of an anchor's hash beyond those that number the anchors: one in 2 ** SPARE_BITS collides.
SPARE_BITS = 12
#: Anchors with more holders than this send their windows one by one.
HOT_DOCS = 20_000
#: The removals are broadcast to the texts only up to this size; beyond it both are shuffled.
BROADCAST_BYTES = 32 << 20
_LAST = np.iinfo(np.int64).max
_POSITION = np.uint64(23)
#: Places of the eight-byte words that make up a leading string, and a whole window.
_STEPS = (*range(0, GRAM - 8, 8), GRAM - 8)
_WINDOW_STEPS = (*range(0, LENGTH - 8, 8), LENGTH - 8)


def _words8(buf: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on, as one number that sorts like them; zeros past the end."""
    padded = np.concatenate([buf, np.zeros(8, np.uint8)])
    return np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(padded, 8)[:len(buf)]).view(">u8").ravel().astype(np.uint64)


def anchors(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Stretches of consecutive windows with one anchor: text number, first window, last window, anchor."""
    n = len(buf)
    if n < LENGTH:
        return (np.zeros(0, np.int64),) * 4
    w = _words8(buf)
    h = np.zeros(n - GRAM + 1, np.uint64)
    for k in _STEPS:
        h = h * np.uint64(0x9E3779B97F4A7C15) + w[k:k + len(h)] * np.uint64(0xD6E8FEB86659FD93)
    h = spans.mix(h)
    key = (h >> _POSITION << _POSITION) | np.arange(len(h), dtype=np.uint64)
    span, have = LENGTH - GRAM + 1, 1
    while 2 * have <= span:
        key, have = np.minimum(key[:-have], key[have:]), 2 * have
    if have < span:
        key = np.minimum(key[:have - span], key[span - have:])
    start = np.arange(len(key))
    doc = np.repeat(np.arange(len(off) - 1), np.diff(off))[:len(key)]
    whole = start + LENGTH <= off[doc + 1]
    start, doc, at = start[whole], doc[whole], (key[whole] & np.uint64((1 << 23) - 1)).astype(np.int64)
    if not len(start):
        return (np.zeros(0, np.int64),) * 4
    new = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1]) | (doc[1:] != doc[:-1])]))
    return doc[new], start[new], start[np.append(new[1:], len(start)) - 1], at[new]


def _lead(buf: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The leading GRAM bytes at each anchor."""
    return np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(buf, GRAM)[at]).view(f"S{GRAM}").ravel()


def merged(row: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of the intervals of each row, in order."""
    if not len(row):
        return row, start, end
    order = np.lexsort((start, row))
    base = row[order].astype(np.int64) << 36
    s, e = base + start[order], np.maximum.accumulate(base + end[order])
    new = np.concatenate([[True], s[1:] > e[:-1]])
    first = np.flatnonzero(new)
    r = row[order][first]
    return r, s[first] - (r.astype(np.int64) << 36), e[np.append(first[1:], len(e)) - 1] - (r.astype(np.int64) << 36)


def _spans_by_row(row: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
    """Rows with removals, and their runs packed as pairs of int64."""
    row, start, end = merged(row, start, end)
    rows, first = np.unique(row, return_index=True)
    return rows, [np.stack([s, e], 1).astype(np.int64).tobytes() for s, e in zip(np.split(start, first[1:]), np.split(end, first[1:]), strict=True)] if len(rows) else []


def _pieces(ids: np.ndarray, c: spans.Chunk) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """(bytes, offsets, position in the text) of a chunk, or of the overlapping pieces of one long text."""
    if len(c.buf) <= 1.5 * CHUNK_BYTES:
        yield c.buf, c.off, 0
        return
    for at in range(0, len(c.buf) - LENGTH + 1, CHUNK_BYTES):
        part = c.buf[at:at + CHUNK_BYTES + LENGTH - 1]
        yield part, np.array([0, len(part)]), at


def _pack(docs: np.ndarray, keys: np.ndarray, buf: np.ndarray, row: np.ndarray, lo: np.ndarray, hi: np.ndarray, at: np.ndarray, base: int, off: np.ndarray) -> bytes:
    """Stretches of one bucket as one block."""
    used, index = np.unique(row, return_inverse=True)
    size = hi - lo + LENGTH
    ends = np.cumsum(size)
    text = buf[np.arange(ends[-1]) + np.repeat(lo - (ends - size), size)]
    head = np.array([len(used), len(row), len(text)], np.int64)
    parts = [head, docs[used], keys[used], index.astype(np.uint32), (lo - off[row] + base).astype(np.int64), size.astype(np.uint8), (at - lo).astype(np.uint8), text]
    return b"".join(p.tobytes() for p in parts)


def _flush(held: dict[int, list[bytes]]) -> tuple[list[int], list[bytes]]:
    """The held blocks of each bucket, compressed together."""
    numbers = sorted(held)
    return numbers, [zstandard.ZstdCompressor(level=3).compress(b"".join(held[b])) for b in numbers]


def _unpack(compressed: list[bytes]) -> tuple[np.ndarray, ...]:
    """(doc, key, row, position, size, anchor offset, text) of all blocks; row numbers the blocks' documents."""
    cols: list[list[np.ndarray]] = [[] for _ in range(7)]
    rows = 0
    for some in compressed:
        raw, at = zstandard.ZstdDecompressor().decompress(some), 0
        while at < len(raw):
            n_docs, n, n_text = (int(x) for x in np.frombuffer(raw, np.int64, 3, at))
            at += 24
            for col, (kind, count) in zip(cols, [(np.int64, n_docs), (np.int64, n_docs), (np.uint32, n), (np.int64, n), (np.uint8, n), (np.uint8, n), (np.uint8, n_text)], strict=True):
                x = np.frombuffer(raw, kind, count, at)
                at += x.nbytes
                col.append(x.astype(np.int64) + rows if kind == np.uint32 else x)
            rows += n_docs
    return tuple(np.concatenate(c) for c in cols)


def multikey_sort(word: np.ndarray, at: np.ndarray, steps: tuple[int, ...], group: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Three-way multikey quicksort of the strings ``word[at + steps]`` within each group, all groups at once:
    (entries equal to one of another document, their numbers of equal strings, the smallest doc of each).

    A round splits every group by its middle entry's word into smaller, equal and larger; only the equal part
    goes on to the next word.  Groups within one document leave at once."""
    places = np.array(steps)
    depth = np.zeros(len(at), np.int64)
    left = np.argsort(group, kind="stable")
    group = group[left]
    found, numbers, owners, given = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], 0
    while len(left):
        first = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
        number = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(left))))
        d = doc[left]
        least = np.minimum.reduceat(d, first)
        several = (least != np.maximum.reduceat(d, first))[number]
        end = several & (depth[left] == len(places))
        found.append(left[end])
        numbers.append(number[end] + given)
        owners.append(least[number[end]])
        given += len(first)
        go = several & ~end
        left, number = left[go], number[go]
        if not len(left):
            break
        first = np.flatnonzero(np.concatenate([[True], number[1:] != number[:-1]]))
        size = np.diff(np.append(first, len(left)))
        w = word[at[left] + places[depth[left]]]
        pivot = np.repeat(w[first + size // 2], size)
        side = (w >= pivot).astype(np.int64) + (w > pivot)
        depth[left[side == 1]] += 1
        group = 3 * number + side
        order = np.argsort(group, kind="stable")
        left, group = left[order], group[order]
    return np.concatenate(found), np.concatenate(numbers), np.concatenate(owners)


def bucket_removals(blocks: list[bytes]) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """(doc, key, packed runs) that the stretches of one bucket remove."""
    doc, key, row, position, size, offset, text = _unpack(blocks)
    begin = np.cumsum(size.astype(np.int64)) - size
    word = _words8(text)
    none = np.zeros(0, np.int64), np.zeros(0, np.int64), []
    left, group, _ = multikey_sort(word, begin + offset, _STEPS, np.zeros(len(row), np.int64), doc[row])
    if not len(left):
        return none
    # equal stretches: only those of the smallest document go on, the others go as a whole
    last = begin[left] + size[left] - 8
    same = np.lexsort([size[left], offset[left], *(word[np.minimum(begin[left] + k, last)] for k in range(0, 2 * LENGTH - GRAM, 8)), group])
    cols = [x[left[same]] for x in (size, offset)] + [word[np.minimum(begin[left[same]] + k, last[same])] for k in range(0, 2 * LENGTH - GRAM, 8)] + [group[same]]
    new = np.ones(len(same), bool)
    new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in cols])
    owner = doc[row[left[same]]]
    copy = owner > np.minimum.reduceat(owner, np.flatnonzero(new))[np.cumsum(new) - 1]
    whole = left[same[copy]]
    left, group = left[same[~copy]], group[same[~copy]]
    out = [(row[whole], position[whole], position[whole] + size[whole])]
    windows = size[left].astype(np.int64) - LENGTH + 1
    step = np.arange(windows.sum()) - np.repeat(np.cumsum(windows) - windows, windows)
    of = np.repeat(left, windows)
    group = np.repeat(group, windows) * 64 + (offset[of] - step)
    at = begin[of] + step
    kept, _, least = multikey_sort(word, at, _WINDOW_STEPS, group, doc[row[of]])
    of, step = of[kept], step[kept]
    if len(of):
        gone = doc[row[of]] > least
        of, step = of[gone], step[gone]
        out.append((row[of], position[of] + step, position[of] + step + LENGTH))
    rows, packed = _spans_by_row(*(np.concatenate(x) for x in zip(*out, strict=True)))
    return doc[rows], key[rows], packed


def _keyed(docs: DataFrame) -> DataFrame:
    """(doc, key, text): null ids last; key tells rows of one doc_id with different texts apart."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(int(_LAST))).alias("doc"), F.xxhash64(text).alias("key"), text.alias("text"))


def _lead_hash(buf: np.ndarray, at: np.ndarray) -> np.ndarray:
    """64-bit hash of the leading GRAM bytes at each anchor."""
    lead = np.lib.stride_tricks.sliding_window_view(buf, GRAM)[at]
    return spans.join_hashes([np.ascontiguousarray(lead[:, k:k + 8]).view(np.uint64).ravel() for k in _STEPS])


def _planes(x: np.ndarray) -> bytes:
    """Unsigned numbers, byte plane after byte plane, so that high zero bytes compress to nothing."""
    return x.view(np.uint8).reshape(len(x), x.itemsize).T.tobytes()


def _from_planes(raw: bytes, kind: type, n: int, at: int) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8, size * n, at).reshape(size, n).T).view(kind).ravel()


def shared(keyed: DataFrame, total: int, hot_docs: int) -> DataFrame:
    """(doc, key, n_shared, bits) of the texts with an anchor that stands anywhere else, too.  bits: one bit per anchor of the text
    in order, then as many again that tell the hot ones.

    Tasks send sorted hashes by range, a few bytes each, with the anchor's number in its block of ``NOTED_BYTES``; a range counts
    them and answers each block with the numbers found twice or more; a block turns its answers into bits of its texts."""
    width = min(48, SPARE_BITS + max(1, total // 8).bit_length())
    n_buckets = 1 + total // NOTED_BYTES
    names = ["bucket", "noted", "hashes", "docs"]

    def sent(noted: int, held: list[tuple[np.ndarray, ...]]) -> Iterator[pa.RecordBatch]:
        docs, keys, counts, hashes = (np.concatenate(x) for x in zip(*held, strict=True))
        some = counts > 0
        if not some.any():
            return
        h = hashes >> np.uint64(64 - width)
        order = np.argsort(h, kind="stable")
        h = h[order]
        bucket = ((h >> np.uint64(max(0, width - 24))) * np.uint64(n_buckets) >> np.uint64(min(24, width))).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
        packer = zstandard.ZstdCompressor(level=1)
        table = np.stack([docs[some], keys[some], counts[some]]).astype(np.int64).tobytes()
        yield pa.RecordBatch.from_arrays([pa.array([noted % n_buckets]), pa.array([noted]), pa.nulls(1, pa.binary()), pa.array([packer.compress(table)], pa.binary())], names)
        ends = np.append(first[1:], len(h))
        for i in range(0, len(first), 32):
            blocks = []
            for lo, hi in zip(first[i:i + 32], ends[i:i + 32], strict=True):
                steps = np.diff(h[lo:hi], prepend=np.uint64(0))
                blocks.append(packer.compress(np.array([hi - lo], np.int64).tobytes() + _planes(steps) + _planes(order[lo:hi].astype(np.uint32))))
            yield pa.RecordBatch.from_arrays([pa.array(bucket[first[i:i + 32]]), pa.array(np.full(len(blocks), noted)), pa.array(blocks, pa.binary()), pa.nulls(len(blocks), pa.binary())], names)

    def note(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        noted = TaskContext.get().partitionId() << 32
        held: list[tuple[np.ndarray, ...]] = []
        size = 0
        for batch in batches:
            seen = 0
            for c in spans.chunks([batch.select([0, 2])], CHUNK_BYTES):
                docs = c.ids.to_numpy()
                keys = batch.column(1).slice(seen, len(docs)).to_numpy()
                seen += len(docs)
                counts = np.zeros(len(docs), np.int64)
                hashes = [np.zeros(0, np.uint64)]
                for part, off, _ in _pieces(docs, c):
                    row, _, _, at = anchors(part, off)
                    if len(row):
                        counts += np.bincount(row, minlength=len(docs))
                        hashes.append(_lead_hash(part, at))
                held.append((docs, keys, counts, np.concatenate(hashes)))
                size += len(c.buf)
                if size >= NOTED_BYTES:
                    yield from sent(noted, held)
                    noted, held, size = noted + 1, [], 0
        if held:
            yield from sent(noted, held)

    def count(rows: pd.DataFrame) -> pd.DataFrame:
        tables = rows[rows["docs"].notna()]
        out = [pd.DataFrame({"noted": tables["noted"], "numbers": None, "hot": None, "docs": tables["docs"]})]
        sent_rows = rows[rows["hashes"].notna()]
        hashes, numbers = [], []
        for block in sent_rows["hashes"]:
            raw = zstandard.ZstdDecompressor().decompress(block)
            n = int(np.frombuffer(raw, np.int64, 1)[0])
            hashes.append(np.cumsum(_from_planes(raw, np.uint64, n, 8)))
            numbers.append(_from_planes(raw, np.uint32, n, 8 + 8 * n))
        if hashes:
            h = np.concatenate(hashes)
            order = np.argsort(h, kind="stable")
            first = np.flatnonzero(np.concatenate([[True], h[order][1:] != h[order][:-1]]))
            holders = np.empty(len(h), np.int64)
            size = np.diff(np.append(first, len(h)))
            holders[order] = np.repeat(size, size)
            each = np.split(holders, np.cumsum([len(x) for x in hashes])[:-1])
            packed = [[np.sort(x[n > least]).tobytes() for x, n in zip(numbers, each, strict=True)] for least in (1, hot_docs)]
            found = pd.DataFrame({"noted": sent_rows["noted"].to_numpy(), "numbers": packed[0], "hot": packed[1], "docs": None})
            out.append(found[found["numbers"].str.len() > 0])
        return pd.concat(out)

    def answer(rows: pd.DataFrame) -> pd.DataFrame:
        tables = rows["docs"].dropna().tolist()
        if len(tables) != 1:
            raise RuntimeError("the documents were read in another order when a task was repeated")
        docs, keys, counts = np.frombuffer(zstandard.ZstdDecompressor().decompress(tables[0]), np.int64).reshape(3, -1)
        flags = np.zeros((2, int(counts.sum())), np.uint8)
        for mark, column in zip(flags, ("numbers", "hot"), strict=True):
            for packed in rows[column].dropna():
                mark[np.frombuffer(packed, np.uint32)] = 1
        ends = np.cumsum(counts)
        n_shared = np.add.reduceat(flags[0], ends - counts, dtype=np.int64)
        some = np.flatnonzero(n_shared)
        bits = [np.packbits(flags[:, ends[i] - counts[i]:ends[i]], axis=1).tobytes() for i in some]
        return pd.DataFrame({"doc": docs[some], "key": keys[some], "n_shared": n_shared[some], "bits": bits})

    counted = keyed.mapInArrow(note, "bucket long, noted long, hashes binary, docs binary").groupBy("bucket").applyInPandas(count, "noted long, numbers binary, hot binary, docs binary")
    answers = counted.groupBy("noted").applyInPandas(answer, "doc long, key long, n_shared long, bits binary")
    return answers.groupBy("doc", "key").agg(F.max("n_shared").alias("n_shared"), F.max("bits").alias("bits"))      # repeated rows have equal bits


def _flags(row: np.ndarray, before: np.ndarray, bits: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(shared, hot) of a piece's anchors; ``before``: anchors of each text in earlier pieces, brought up to date."""
    half = np.diff(off) // 2
    n = np.bincount(row, minlength=len(half))
    number = np.arange(len(row)) - (np.cumsum(n) - n)[row] + before[row]
    before += n
    if (before > 8 * half).any():
        raise RuntimeError("two texts of one document and one key")
    at = 8 * off[:-1][row] + number
    flags = np.unpackbits(bits).astype(bool)
    return flags[at], flags[at + 8 * half[row]]


def _sample(found: DataFrame, buckets: int, most_docs: int) -> np.ndarray:
    """Splitters from the shared anchors of a bounded number of texts, those of least seeded hash of doc_id."""
    ids = spans.smallest_by_hash(found, "doc", max(most_docs, buckets))
    chosen = found.sparkSession.createDataFrame([(i,) for i in ids], "doc long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits, ends = spans.buffers(batch.column(2))
            seen = 0
            for c in spans.chunks([batch.select([0, 1])], CHUNK_BYTES):
                own = ends[seen:seen + len(c.ids) + 1]
                seen += len(c.ids)
                before = np.zeros(len(c.ids), np.int64)
                for part, off, _ in _pieces(np.zeros(0), c):
                    row, _, _, at = anchors(part, off)
                    if len(row):
                        kept, _ = _flags(row, before, bits[own[0]:own[-1]], own - own[0])
                        yield pa.RecordBatch.from_arrays([pa.array([x.ljust(GRAM, b"\0") for x in np.unique(_lead(part, at[kept])).tolist()], pa.binary())], ["lead"])

    leads = found.join(F.broadcast(chosen), "doc", "left_semi").select("doc", "text", "bits").mapInArrow(run, "lead binary")
    drawn = np.sort(np.array([bytes(x) for x in spans.smallest_by_hash(leads, "lead", max(20_000, 20 * buckets))] or [b""], f"S{GRAM}"))
    return np.unique(drawn[np.linspace(0, len(drawn) - 1, buckets + 1).astype(np.int64)[1:-1]])


def _sized(table: DataFrame, column: str) -> DataFrame:
    """A written table, marked for broadcast if its counted bytes are few."""
    size = table.agg(F.sum(F.octet_length(column) + 32)).first()[0] or 0
    return F.broadcast(table) if size <= BROADCAST_BYTES else table


def removals(keyed: DataFrame, most_docs: int = 500, hot_docs: int = HOT_DOCS) -> DataFrame:
    """(doc, key, spans): the runs of bytes to remove, packed, in one or more rows per document."""
    total = keyed.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    answers = materialize(shared(keyed, total, hot_docs), "shared")
    n_shared = answers.agg(F.sum("n_shared")).first()[0] or 0
    found = keyed.join(_sized(answers.select("doc", "key", "bits"), "bits"), ["doc", "key"]).select("doc", "key", "text", "bits")
    cuts = _sample(found, 1 + n_shared * 2 * LENGTH // BUCKET_BYTES, most_docs)
    n_buckets = len(cuts) + 1
    schema = "bucket long, doc long, key long, own binary, block binary"
    names = ["bucket", "doc", "key", "own", "block"]

    def sent(held: dict[int, list[bytes]]) -> Iterator[pa.RecordBatch]:
        numbers, blocks = _flush(held)
        held.clear()
        for i in range(0, len(blocks), 32):          # small batches: the other side copies each as a whole
            some = blocks[i:i + 32]
            unset = pa.array(np.zeros(len(some), np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(numbers[i:i + 32], pa.int64()), unset, unset, pa.nulls(len(some), pa.binary()), pa.array(some, pa.binary())], names)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[bytes]] = {}
        waiting = 0
        for batch in batches:
            bits, ends = spans.buffers(batch.column(3))
            seen = 0
            for c in spans.chunks([batch.select([0, 2])], CHUNK_BYTES):
                docs = c.ids.to_numpy()
                keys = batch.column(1).slice(seen, len(docs)).to_numpy()
                own = ends[seen:seen + len(docs) + 1]
                seen += len(docs)
                before = np.zeros(len(docs), np.int64)
                for part, off, base in _pieces(docs, c):
                    row, lo, hi, at = anchors(part, off)
                    if not len(row):
                        continue
                    kept, many = _flags(row, before, bits[own[0]:own[-1]], own - own[0])
                    row, lo, hi, at, many = (x[kept] for x in (row, lo, hi, at, many))
                    if not len(row):
                        continue
                    lead = _lead(part, at)
                    if many.any():                   # windows of hot leading strings go one by one
                        count = np.where(many, hi - lo + 1, 1)
                        step = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
                        row, lo, hi, at, lead, many = (np.repeat(x, count) for x in (row, lo, hi, at, lead, many))
                        lo = lo + step
                        hi = np.where(many, lo, hi)
                    same = spans.hash_spans(part, lo, hi + LENGTH)
                    order = np.argsort(same)
                    first = np.flatnonzero(np.concatenate([[True], same[order][1:] != same[order][:-1]]))
                    least = np.empty(len(same), np.int64)
                    least[order] = np.repeat(np.minimum.reduceat(docs[row][order], first), np.diff(np.append(first, len(order))))
                    gone = docs[row] > least
                    rows, packed = _spans_by_row(row[gone], lo[gone] - off[row[gone]] + base, hi[gone] + LENGTH - off[row[gone]] + base)
                    if len(rows):
                        yield pa.RecordBatch.from_arrays([pa.array(keys[rows] % n_buckets), pa.array(docs[rows]), pa.array(keys[rows]), pa.array(packed, pa.binary()), pa.nulls(len(rows), pa.binary())], names)
                    bucket = np.searchsorted(cuts, lead, side="right") if len(cuts) else np.zeros(len(lead), np.int64)
                    if many.any():
                        bucket = np.where(many, (same % np.uint64(n_buckets)).astype(np.int64), bucket)
                    stay = np.flatnonzero(~gone)
                    stay = stay[np.lexsort((lead[stay], bucket[stay]))]
                    for part_rows in np.split(stay, np.flatnonzero(np.diff(bucket[stay])) + 1):
                        if len(part_rows):
                            block = _pack(docs, keys, part, row[part_rows], lo[part_rows], hi[part_rows], at[part_rows], base, off)
                            held.setdefault(int(bucket[part_rows[0]]), []).append(block)
                            waiting += len(block)
                    if waiting >= HELD_BYTES:
                        yield from sent(held)
                        waiting = 0
        if held:
            yield from sent(held)

    def settle(rows: pd.DataFrame) -> pd.DataFrame:
        own = rows[rows["own"].notna()]
        out = [pd.DataFrame({"doc": own["doc"], "key": own["key"], "spans": own["own"]})]
        blocks = rows["block"].dropna().tolist()
        if blocks:
            doc, key, packed = bucket_removals(blocks)
            out.append(pd.DataFrame({"doc": doc, "key": key, "spans": packed}))
        return pd.concat(out)

    return found.mapInArrow(find, schema).groupBy("bucket").applyInPandas(settle, "doc long, key long, spans binary")


def cut(docs: DataFrame, hot_docs: int = HOT_DOCS) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept) of every whole text; kept: the remaining bytes."""
    keyed = _keyed(docs)
    found = materialize(removals(keyed, hot_docs=hot_docs), "removals")
    gone = found.groupBy("doc", "key").agg(F.collect_list("spans").alias("spans"))       # runs within one text
    if (found.agg(F.sum(F.octet_length("spans") + 32)).first()[0] or 0) <= BROADCAST_BYTES:
        gone = F.broadcast(gone)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buf, off = spans.buffers(batch.column(1))
            removed, runs, kept = [], [], []
            for i, packed in enumerate(batch.column(2)):
                raw = buf[off[i]:off[i + 1]]
                if not packed.is_valid:
                    removed.append(0), runs.append(0), kept.append(raw.tobytes())
                    continue
                pairs = np.concatenate([np.frombuffer(x.as_buffer(), np.int64) for x in packed]).reshape(-1, 2)
                _, s, e = merged(np.zeros(len(pairs), np.int64), pairs[:, 0], pairs[:, 1])
                edge = np.zeros(len(raw) + 1, np.int64)
                edge[s] += 1
                edge[e] -= 1
                removed.append(int((e - s).sum())), runs.append(len(s)), kept.append(raw[np.cumsum(edge[:-1]) == 0].tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.diff(off)), pa.array(removed, pa.int64()), pa.array(runs, pa.int64()), pa.array(kept, pa.binary())],
                                             ["doc", "n_bytes", "n_removed", "n_spans", "kept"])

    joined = keyed.join(gone, ["doc", "key"], "left").select("doc", "text", "spans")
    out = joined.mapInArrow(run, "doc long, n_bytes long, n_removed long, n_spans long, kept binary")
    return out.select(F.when(F.col("doc") != F.lit(int(_LAST)), F.col("doc")).alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept")


def digests(kept: DataFrame) -> DataFrame:
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
