"""Operator 13, ranked lexical search with a document FP-tree and branch-and-bound.

One pass over the documents writes each one's length and its vector of term counts, restricted to the
items' terms; from that table come N, L and the terms' document frequencies.  Each task then orders its
vectors by falling frequency and lays them in a trie, where documents share paths.  A node keeps the
largest count of every term below it and the least m, which bound the score of all documents below: the
score rises with a count and falls with m.  Each item walks the trie depth first, best bound first, and
leaves out subtrees whose bound lies below its 20th best score so far.  The tasks' best rows are ranked
once more over all tasks.  Bounds and scores are 64-bit integers, so nothing is lost to rounding.

The items' terms are sent to every task: items are cut into blocks by a hash of item_id, each of about
``block_bytes`` of text, and the documents are read once per block.  A trie holds about
``TREE_POSTINGS`` counts; a task builds one after another and keeps only the items' best rows.

Defined results: a null text has no terms and, like a text without terms, does not count in N.  Texts of
one item_id, different rows included, make up one item; equal rows count once; a null item_id is an item of
its own.  Every row of documents is a document, repeated ids included; a null doc_id comes after all
others.  Items that no document holds a term of have no rows.  Extra columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, IntegerType, LongType, StructType

from scorewright.session import materialize

from . import spans

TOP = 20
BLOCK_BYTES = 8 << 20
TREE_POSTINGS = 2_000_000
LEAF = 64
_WORD_BYTES = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256)).lower()


def terms_of(raw: bytes) -> list[bytes]:
    """The terms of a UTF-8 text: runs of digits, ASCII letters in lower case and all other code points."""
    return raw.translate(_WORD_BYTES).split()


class Item(NamedTuple):
    terms: np.ndarray       # int64, ranks of its terms by falling document frequency
    weights: np.ndarray     # int64, w times the term's occurrences in the item


def item_blocks(items: DataFrame, block_bytes: int = BLOCK_BYTES) -> Iterator[list[tuple]]:
    """(item_id, terms with repeats) of all items, a bounded block at a time."""
    rows = items.select(F.col("item_id").alias("i"), F.col("text").cast("string").alias("t")).where("t IS NOT NULL").distinct()
    total = rows.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    blocks = max(1, math.ceil(total / block_bytes))
    if blocks > 1:
        rows = materialize(rows.withColumn("b", F.pmod(F.xxhash64("i"), F.lit(blocks))), "items")
    for b in range(blocks):
        found: dict = {}
        for r in (rows.where(F.col("b") == b) if blocks > 1 else rows).collect():      # about block_bytes
            found.setdefault(r.i, []).extend(terms_of(r.t.encode()))
        yield sorted(found.items(), key=lambda e: (e[0] is None, e[0]))


def vectors(docs: DataFrame, terms: list[bytes]) -> DataFrame:
    """(doc_id, n, terms, counts) of every document with a term; the vector holds only ``terms``, by their place."""
    place = {t: i for i, t in enumerate(terms)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for c in spans.chunks(batches):
            raw, keep, lengths, found, counts, off = c.buf.tobytes(), [], [], [], [], [0]
            for i, (a, b) in enumerate(zip(c.off[:-1].tolist(), c.off[1:].tolist(), strict=True)):
                words = terms_of(raw[a:b])
                if words:
                    vector = Counter(map(place.get, words))
                    vector.pop(None, None)
                    keep.append(i)
                    lengths.append(len(words))
                    found.extend(vector.keys())
                    counts.extend(vector.values())
                    off.append(len(found))
            offsets = pa.array(off, pa.int32())
            yield pa.RecordBatch.from_arrays([c.ids.take(pa.array(keep, pa.int64())), pa.array(lengths, pa.int64()), pa.ListArray.from_arrays(offsets, pa.array(found, pa.int32())),
                                              pa.ListArray.from_arrays(offsets, pa.array(counts, pa.int32()))], ["doc_id", "n", "terms", "counts"])

    return spans.texts_of(docs).mapInArrow(run, "doc_id long, n long, terms array<int>, counts array<int>")


def document_frequencies(table: DataFrame, n_terms: int) -> np.ndarray:
    """Documents that hold each term; each task adds up its own first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n_terms, np.int64)
        for batch in batches:
            total += np.bincount(batch.column(0).flatten().to_numpy(), minlength=n_terms)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["t", "df"])

    df = np.zeros(n_terms, np.int64)
    for r in table.select("terms").mapInArrow(run, "t long, df long").groupBy("t").agg(F.sum("df").alias("df")).collect():     # at most n_terms rows
        df[r.t] = r.df
    return df


def gain(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """What a count adds per unit of weight: rises with tf, falls with m."""
    return (1_000_000_000 * tf) // (1000 * tf + 12 * m)


class Tree:
    """Trie of frequency-ordered vectors: a node is a range of documents that share a path.

    A node of at most ``LEAF`` documents, or of equal vectors, is a leaf; neighbouring small children form one leaf."""

    def __init__(self, off: np.ndarray, terms: np.ndarray, tf: np.ndarray, m: np.ndarray, n_terms: int) -> None:
        doc = np.repeat(np.arange(len(m)), np.diff(off))
        within = np.lexsort((terms, doc))
        paths = terms[within].astype(">u4")
        keys = [paths[a:b].tobytes() for a, b in zip(off[:-1].tolist(), off[1:].tolist(), strict=True)]
        self.order = np.array(sorted(range(len(keys)), key=keys.__getitem__), np.int64)
        self.m = m[self.order]
        place = np.empty(len(m), np.int64)
        place[self.order] = np.arange(len(m))
        self.size = len(m)
        key = terms.astype(np.int64) * self.size + place[doc]
        by = np.argsort(key)
        self.key, self.tf = key[by], tf[by].astype(np.int64)
        self.gain = gain(self.tf, self.m[self.key % self.size])

        shared = np.zeros(max(len(m) - 1, 0), np.int64)         # path length that neighbours have in common
        for i in range(len(shared)):
            a, b = keys[self.order[i]], keys[self.order[i + 1]]
            if a == b:
                shared[i] = 1 << 40
            else:
                least = min(len(a), len(b))
                x = np.frombuffer(a, np.uint8, least) != np.frombuffer(b, np.uint8, least)
                shared[i] = (int(x.argmax()) if x.any() else least) // 4
        self.lo, self.hi, depth, parent = [0], [len(m)], [0], [0]
        self.children: list[range] = []
        node = 0
        while node < len(self.lo):                              # breadth first, children side by side
            lo, hi = self.lo[node], self.hi[node]
            inner = shared[lo:hi - 1]
            first = len(self.lo)
            if hi - lo > LEAF and inner.min() < 1 << 40:
                start = lo
                cuts = [*(np.flatnonzero(inner == inner.min()) + lo + 1).tolist(), hi]
                for i, cut in enumerate(cuts):
                    if i + 1 == len(cuts) or cuts[i + 1] - start > LEAF:
                        self.lo.append(start)
                        self.hi.append(cut)
                        depth.append(depth[node] + 1)
                        parent.append(node)
                        start = cut
            self.children.append(range(first, len(self.lo)))
            node += 1
        nodes = len(self.lo)
        self.nodes = nodes
        self.least_m = np.array([self.m[a:b].min() for a, b in zip(self.lo, self.hi, strict=True)], np.int64)
        leaf_at = np.zeros(self.size, np.int64)
        for i, below in enumerate(self.children):
            if not below:
                leaf_at[self.lo[i]:self.hi[i]] = i
        level, up = np.array(depth), np.array(parent)
        term, leaf = self.key // self.size, leaf_at[self.key % self.size]
        carried, most, every = np.zeros(0, np.int64), np.zeros(0, np.int64), []
        for d in range(int(level.max()), -1, -1):               # maxima of the leaves, then of the nodes above
            own = level[leaf] == d
            at, top = _maxima(np.concatenate([term[own] * nodes + leaf[own], carried]), np.concatenate([self.tf[own], most]))
            every.append((at, top))
            carried, most = (at // nodes) * nodes + up[at % nodes], top
        at, top = (np.concatenate(x) for x in zip(*every, strict=True))
        by = np.argsort(at)
        self.node_key, self.node_tf = at[by], top[by]

    def bounds(self, item: Item, nodes: np.ndarray) -> np.ndarray:
        """No document below a node scores more for the item."""
        want = item.terms[:, None] * self.nodes + nodes[None, :]
        at = np.minimum(np.searchsorted(self.node_key, want), len(self.node_key) - 1)
        tf = np.where(self.node_key[at] == want, self.node_tf[at], 0)
        return (item.weights[:, None] * gain(tf, self.least_m[nodes][None, :])).sum(0)

    def scores(self, item: Item, node: int) -> tuple[np.ndarray, np.ndarray]:
        """(document places, scores) of a leaf's documents that hold a term of the item."""
        lo, hi = self.lo[node], self.hi[node]
        starts = np.searchsorted(self.key, item.terms * self.size + lo)
        sizes = np.searchsorted(self.key, item.terms * self.size + hi) - starts
        at = np.repeat(starts - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
        total = np.zeros(hi - lo, np.int64)
        np.add.at(total, self.key[at] % self.size - lo, self.gain[at] * np.repeat(item.weights, sizes))
        got = np.flatnonzero(total)
        return got + lo, total[got]


def _maxima(key: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(key):
        return key, value
    by = np.argsort(key, kind="stable")
    key, value = key[by], value[by]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    return key[first], np.maximum.reduceat(value, first)


class Best:
    """The best rows of one item so far: highest score first, then least doc_id, nulls last."""

    def __init__(self, top: int) -> None:
        self.top, self.floor = top, 1
        self.score, self.null, self.doc = np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64)

    def add(self, score: np.ndarray, null: np.ndarray, doc: np.ndarray) -> None:
        able = score >= self.floor
        if able.any():
            score, null, doc = np.concatenate([self.score, score[able]]), np.concatenate([self.null, null[able]]), np.concatenate([self.doc, doc[able]])
            by = np.lexsort((doc, null, -score))[:self.top]
            self.score, self.null, self.doc = score[by], null[by], doc[by]
            if len(by) == self.top:
                self.floor = int(self.score[-1])


def walk(tree: Tree, item: Item, best: Best, doc: np.ndarray, null: np.ndarray) -> None:
    """Depth-first branch and bound; ``doc`` and ``null`` are the ids by place in the tree."""
    stack = [(int(tree.bounds(item, np.zeros(1, np.int64))[0]), 0)]
    while stack:
        bound, node = stack.pop()
        if bound < best.floor:
            continue
        below = tree.children[node]
        if not below:
            at, score = tree.scores(item, node)
            best.add(score, null[at], doc[at])
            continue
        bounds = tree.bounds(item, np.arange(below.start, below.stop))
        for i in np.argsort(bounds, kind="stable").tolist():    # the best bound is popped first
            if bounds[i] >= best.floor:
                stack.append((int(bounds[i]), below.start + i))


def search(table: DataFrame, items: list[Item], n_docs: int, n_terms: int, rank: np.ndarray, top: int = TOP) -> DataFrame:
    """(item, doc_id, score): each task's best rows per item; ``n_docs`` and ``n_terms`` are N and L."""
    distinct = len(rank)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(top) for _ in items]

        def grow(held: list[pa.RecordBatch]) -> None:
            t = pa.Table.from_batches(held).combine_chunks()
            ids = t.column("doc_id").combine_chunks()
            lists = t.column("terms").combine_chunks()
            off = lists.offsets.to_numpy().astype(np.int64)
            terms = rank[lists.flatten().to_numpy()]
            tf = t.column("counts").combine_chunks().flatten().to_numpy()
            m = np.array([75 + (25 * n * n_docs) // n_terms for n in t.column("n").to_pylist()], np.int64)
            tree = Tree(off - off[0], terms, tf, m, distinct)
            null = np.asarray(ids.is_null())[tree.order]
            doc = ids.fill_null(0).to_numpy(zero_copy_only=False)[tree.order]
            for item, b in zip(items, best, strict=True):
                walk(tree, item, b, doc, null)

        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += len(batch.column("terms").flatten())
            if size >= TREE_POSTINGS:
                grow(held)
                held, size = [], 0
        if held:
            grow(held)
        sizes = [len(b.score) for b in best]
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(np.arange(len(items), dtype=np.int32), sizes)), pa.array(np.concatenate([b.doc for b in best]), mask=np.concatenate([b.null for b in best])),
                                          pa.array(np.concatenate([b.score for b in best]))], ["item", "doc_id", "score"])

    few = 4 * table.sparkSession.sparkContext.defaultParallelism      # long tasks: a floor found early spares more
    return table.where(F.size("terms") > 0).coalesce(few).mapInArrow(run, "item int, doc_id long, score long")


def rank_documents(docs: DataFrame, items: DataFrame, top: int = TOP, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(item_id, rank, doc_id, score): each item's best documents of all."""
    spark, kind, out = docs.sparkSession, items.schema["item_id"].dataType, None
    for block in item_blocks(items, block_bytes):
        terms = sorted({t for _, found in block for t in found})
        table = materialize(vectors(docs, terms), "vectors")
        total = table.agg(F.count(F.lit(1)).alias("n"), F.sum("n").alias("l")).first()
        df = document_frequencies(table, len(terms))
        order = np.argsort(-df, kind="stable")
        rank = np.empty(len(terms), np.int64)
        rank[order] = np.arange(len(terms))
        place = {t: i for i, t in enumerate(terms)}
        asked, ids = [], []
        for item_id, found in block:
            counts = Counter(place[t] for t in found)
            held = {t: c for t, c in counts.items() if df[t]}
            if held:
                w = {t: math.floor(1000 * math.log((2 * total.n + 2) / (2 * int(df[t]) + 1))) for t in held}
                asked.append(Item(rank[list(held)], np.array([w[t] * c for t, c in held.items()], np.int64)))
                ids.append((len(ids), item_id))
        if not asked:
            continue
        one = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        best = search(table, asked, total.n, total.l, rank, top).withColumn("rank", F.row_number().over(one)).where(F.col("rank") <= top)
        names = spark.createDataFrame(ids, _named(kind))            # as many rows as the block has items
        best = best.join(F.broadcast(names), "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
        out = best if out is None else out.unionByName(best)
    return out if out is not None else spark.createDataFrame([], _named(kind).add("rank", IntegerType()).add("doc_id", LongType()).add("score", LongType())).drop("item")


def _named(kind):
    from pyspark.sql.types import IntegerType, StructType
    return StructType().add("item", IntegerType()).add("item_id", kind)


ORACLE = r"""
WITH words AS (
  SELECT row_number() OVER () AS d, doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM documents),
asked AS (
  SELECT item_id, term, count(*) AS q FROM (
    SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM (SELECT DISTINCT item_id, text FROM benchmark)) GROUP BY ALL),
sizes AS (SELECT d, any_value(doc_id) AS doc_id, count(*) AS n FROM words GROUP BY d),
total AS (SELECT count(*) AS docs, sum(n)::BIGINT AS len FROM sizes),
norms AS (SELECT d, doc_id, 100 - 25 + (25 * n * docs) // len AS m FROM sizes, total),
tfs AS (SELECT d, term, count(*) AS tf FROM words WHERE term IN (SELECT term FROM asked) GROUP BY ALL),
weights AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM tfs, total GROUP BY term, docs),
scored AS (
  SELECT item_id, doc_id, d, sum(q * w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score
  FROM asked JOIN tfs USING (term) JOIN weights USING (term) JOIN norms USING (d) GROUP BY ALL)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id ASC NULLS LAST) AS rank FROM scored WHERE score > 0)
WHERE rank <= 20
"""
