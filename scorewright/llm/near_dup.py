"""Operator 5, MinHash near-duplicates by tensored banding, every candidate verified on its full set.

A document's set is its distinct shingles of so many words; documents with equal sets are one node from the
start.  Each node gets two collections, A and B, of ``halves`` half keys, each of ``ROWS`` minhashes; a table
key is a pair (A_i, B_j).  So 2 * halves * ROWS minhashes serve halves ** 2 tables of 2 * ROWS rows.  The number
of halves follows from the least similarity: there, a pair misses all tables with probability below ``MISSED``
(12 halves at 0.85, 16 at 0.8).  Only half keys that two nodes share are paired into table keys, which leaves
most texts without any.

Buckets are never expanded into rows of pairs.  First the least node of a bucket is paired with the others: a
likely pair, whose set sizes allow it and at least ``likely`` of whose minhashes agree (a pair at the least
similarity fails that with probability below ``UNLIKELY``), ties its two nodes into one family.  Buckets
that still span several families are searched inside tasks: their nodes of other families than the bucket's largest meet
all nodes of that one once, and each other bucket by bucket, in blocks of at most ``BLOCK`` nodes against
each other, for likely pairs of different families; a task gives out only a spanning forest of them, at most
a row a node.  So the two nodes of every likely pair are in one family.  Each member's full set travels once
to its family's block (to several, if a family has more than ``2 * SET_BLOCK`` shingles).  There a prefix
index finds the candidates (two sets similar enough share one of their rarest shingles), candidates not yet
joined are compared on the full sets, and only the links that join components leave the task.  So no pair
that can link goes untested, and rows grow with nodes, never with pairs.

Vertices are doc_ids: rows of one doc_id with different texts are one vertex.  Defined results: no words:
n_shingles 0, a component of its own.  A null doc_id: component_id null, kept true (no id to link by).
Repeated rows: equal results each.  Extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from . import spans

ROWS = 3
#: Nodes of a bucket that one block compares (about 1 MB of signatures).
BLOCK = 8_192
#: Shingles of a family that one side of a block holds (8 bytes each).
SET_BLOCK = 1_000_000
MISSED, UNLIKELY = 3e-5, 1e-6
SHINGLE_WORDS = 3
PERCENT = 85
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


class Rule(NamedTuple):
    words: int                                    # of a shingle
    percent: int                                  # least similarity
    halves: int
    likely: int


@lru_cache
def rule(words: int = SHINGLE_WORDS, percent: int = PERCENT) -> Rule:
    """What counts as similar, with the table count and the signature bound that follow from the percent."""
    p = percent / 100
    halves = 1
    while 1 - (1 - (1 - p ** ROWS) ** halves) ** 2 >= MISSED:
        halves += 1
    m, likely, fails = 2 * halves * ROWS, 0, 0.0
    while likely < m and (fails := fails + math.comb(m, likely) * p ** likely * (1 - p) ** (m - likely)) < UNLIKELY:
        likely += 1
    return Rule(words, percent, halves, likely)


@lru_cache
def _minhashes(m: int) -> tuple[np.ndarray, np.ndarray]:
    """Masks and odd factors of m minhashes."""
    rng = np.random.default_rng(20250102)
    return rng.integers(0, 1 << 63, m, dtype=np.uint64), rng.integers(0, 1 << 63, m, dtype=np.uint64) | np.uint64(1)


def shingle_sets(c: spans.Chunk, size: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all texts of a chunk, end to end, and where each text's begin."""
    c = c._replace(buf=_LOWER[c.buf])
    n = len(c.off) - 1
    starts, ends, doc = spans.words(c)
    h = spans.hash_spans(c.buf, starts, ends)
    count = np.bincount(doc, minlength=n)
    m = max(0, len(h) - size + 1)
    whole = np.flatnonzero(doc[:m] == doc[len(doc) - m:])
    keys, owners = [spans.join_hashes([h[i:m + i][whole] for i in range(size)])], [doc[whole]]
    first = np.concatenate([[0], np.cumsum(count)])
    for k in range(1, size):          # shorter texts: the whole sequence as one
        short = np.flatnonzero(count == k)
        keys.append(spans.join_hashes([h[first[short] + i] for i in range(k)] + [np.full(len(short), k, np.uint64)]) if len(short) else np.zeros(0, np.uint64))
        owners.append(short)
    key, owner = np.concatenate(keys), np.concatenate(owners)
    order = np.lexsort((key, owner))
    key, owner = key[order], owner[order]
    fresh = np.ones(len(key), bool)
    fresh[1:] = (key[1:] != key[:-1]) | (owner[1:] != owner[:-1])
    key, owner = key[fresh], owner[fresh]
    return key, np.searchsorted(owner, np.arange(n + 1))


def _digests(key: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit digests of each set."""
    out = []
    for salt in (0x5851F42D4C957F2D, 0x14057B7EF767814F):
        sums = np.zeros(len(key) + 1, np.uint64)
        np.cumsum(spans.mix(key ^ np.uint64(salt)), out=sums[1:])
        out.append((sums[at[1:]] - sums[at[:-1]]).view(np.int64))
    return out[0], out[1]


SKETCH = "doc_id long, s1 long, s2 long, n long, halves array<long>, signature binary"


def sketches(docs: DataFrame, like: Rule) -> DataFrame:
    """(doc_id, s1, s2, n, halves, signature) of every whole text: set digests, set size, its 2 * halves half
    keys and one byte of each minhash."""
    halves_, (xor, mul) = like.halves, _minhashes(2 * like.halves * ROWS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for c in spans.chunks(batches):
            key, at = shingle_sets(c, like.words)
            size = np.diff(at)
            some = np.flatnonzero(size)
            halves, signature = np.zeros((len(size), 2 * halves_), np.uint64), np.zeros((len(size), 2 * halves_ * ROWS), np.uint8)
            if len(some):
                for i in range(2 * halves_):
                    least = [np.minimum.reduceat((key ^ xor[f]) * mul[f], at[:-1][some]) for f in range(i * ROWS, (i + 1) * ROWS)]
                    halves[some, i] = spans.join_hashes(least)
                    for k, x in enumerate(least):
                        signature[some, i * ROWS + k] = (spans.mix(x) & np.uint64(0xFF)).astype(np.uint8)
            s1, s2 = _digests(key, at)
            flat = pa.ListArray.from_arrays(pa.array(np.arange(len(size) + 1) * 2 * halves_, pa.int32()), pa.array(halves.view(np.int64).ravel()))
            yield pa.RecordBatch.from_arrays([c.ids, pa.array(s1), pa.array(s2), pa.array(size), flat, pa.array([x.tobytes() for x in signature], pa.binary())], [x.split()[0] for x in SKETCH.split(", ")])

    return spans.texts_of(docs).mapInArrow(run, SKETCH)


def _sets(docs: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """(node, family, shingles, members) of the wanted (node, s1, s2, family, shingles): the sorted shingle hashes, packed."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()                   # repeated rows: a set once a task
        for batch in batches:
            at_row = 0
            for c in spans.chunks([batch]):
                n = len(c.off) - 1
                key, at = shingle_sets(c, words)
                s1, s2 = _digests(key, at)
                part = batch.slice(at_row, n)
                at_row += n
                fits = np.flatnonzero((s1 == part.column(2).to_numpy()) & (s2 == part.column(3).to_numpy()))
                rows = np.array([i for i, node in zip(fits, c.ids.take(pa.array(fits)).to_pylist(), strict=True) if not (node in seen or seen.add(node))], np.int64)
                take = pa.array(rows)
                yield pa.RecordBatch.from_arrays([c.ids.take(take), part.column(4).take(take), part.column(5).take(take),
                                                  pa.array([key[at[i]:at[i + 1]].tobytes() for i in rows], pa.binary())], ["node", "family", "shingles", "members"])

    found = spans.texts_of(docs).join(spans.small_side(wanted.withColumnRenamed("node", "doc_id")), "doc_id").select("doc_id", "text", "s1", "s2", "family", "shingles")
    return found.mapInArrow(run, "node long, family long, shingles long, members binary")


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of the nodes of an edge list (u, v) that reach a lesser one; component: the least of those.

    Large-star and small-star steps: each node's neighbours are tied to the least of them."""
    now, before = materialize(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges"), None
    while True:
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least).where("u <> v").distinct()
        now = materialize(small, "edges")
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            return now.groupBy("u").agg(F.min("v").alias("component")).withColumnRenamed("u", "node")
        before = state


def _fits(a: str, b: str, percent: int) -> Column:
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def _buckets(nodes: DataFrame, halves: int) -> DataFrame:
    """(key, node, n, pivot) of the tables' buckets that hold several nodes; pivot: the least of them."""
    half = nodes.select("node", "n", F.posexplode("halves").alias("i", "x")).withColumn("half", F.xxhash64("i", "x"))
    shared = half.groupBy("half").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).where("lo < hi").select("half")
    met = half.join(shared, "half").groupBy("node", "n").agg(F.collect_list(F.struct("i", "half")).alias("h"))       # at most 2 * halves each
    side = lambda lo: F.filter("h", lambda x: (x["i"] < halves) if lo else (x["i"] >= halves))
    keys = met.select("node", "n", F.explode(side(True)).alias("a"), side(False).alias("bs")).select("node", "n", "a", F.explode("bs").alias("b"))
    keys = materialize(keys.select(F.xxhash64("a.half", "b.half").alias("key"), "node", "n"), "keys")
    pivots = keys.groupBy("key").agg(F.min("node").alias("pivot"), F.max("node").alias("hi")).where("pivot < hi").select("key", "pivot")
    return keys.join(pivots, "key")


def _bytes_of(column: pa.Array) -> np.ndarray:
    """Rows of equally long binary values as a matrix."""
    return spans.buffers(column)[0].reshape(len(column), -1)


def _likely(pairs: DataFrame, nodes: DataFrame, like: Rule) -> DataFrame:
    """Distinct pairs (u, v) that sizes and signatures allow to be similar."""
    end = lambda c: nodes.select(F.col("node").alias(c), F.col("n").alias(f"n{c}"), F.col("signature").alias(f"s{c}"))
    joined = pairs.select("u", "v").distinct().join(end("u"), "u").join(end("v"), "v").where(_fits("nu", "nv", like.percent)).select("u", "v", "su", "sv")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield batch.select([0, 1]).filter(pa.array((_bytes_of(batch.column(2)) == _bytes_of(batch.column(3))).sum(1) >= like.likely))

    return joined.mapInArrow(run, "u long, v long")


def _blocks(batches: Iterator[pa.RecordBatch], keys: int = 3) -> Iterator[pa.Table]:
    """The rows of each block, whole: runs of equal values of the first ``keys`` columns of sorted batches."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [batch.column(i).to_numpy() for i in range(keys)]
        change = np.logical_or.reduce([c[1:] != c[:-1] for c in cols])
        cuts = [0, *(np.flatnonzero(change) + 1).tolist(), batch.num_rows]
        for lo, hi in zip(cuts, cuts[1:]):
            if held and any(held[-1].column(i)[-1].as_py() != cols[i][lo] for i in range(keys)):
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(lo, hi - lo))
    if held:
        yield pa.Table.from_batches(held)


def _columns(block: pa.Table, at: range) -> list[np.ndarray]:
    return [block.column(i).combine_chunks().to_numpy() for i in at]


def _edges(found: list[tuple[int, int]]) -> pa.RecordBatch:
    pairs = np.array(found, np.int64).reshape(-1, 2)
    return pa.RecordBatch.from_arrays([pa.array(np.maximum(pairs[:, 0], pairs[:, 1])), pa.array(np.minimum(pairs[:, 0], pairs[:, 1]))], ["u", "v"])


def _crossed(rows: DataFrame, slots: Column) -> DataFrame:
    """Rows with (a, b, slot): each node once for every block of two slots that it is in."""
    rows = rows.withColumn("slots", slots).withColumn("slot", F.pmod(F.xxhash64("node"), F.col("slots")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("slots") - 1))).drop("slots")
    return rows.withColumns({"a": F.least("slot", "other"), "b": F.greatest("slot", "other")}).drop("other")


def _forest(node: np.ndarray, n: np.ndarray, component: np.ndarray, slot: np.ndarray, crossed: bool, signature: np.ndarray, like: Rule) -> list[tuple[int, int]]:
    """A spanning forest of one block's likely pairs of different families."""
    family, out = np.arange(len(node)), []
    for i in range(len(node) - 1):
        j = slice(i + 1, None)
        ok = (component[j] != component[i]) & (family[j] != family[i]) & (100 * np.minimum(n[j], n[i]) >= like.percent * np.maximum(n[j], n[i]))
        if crossed:
            ok &= slot[j] != slot[i]
        at = np.flatnonzero(ok) + i + 1
        if len(at):
            at = at[(signature[at] == signature[i]).sum(1) >= like.likely]
            new, first = np.unique(family[at], return_index=True)
            if len(new):
                out += [(int(node[i]), int(node[k])) for k in at[first]]
                family[np.isin(family, new)] = family[i]
    return out


def _tied(rows: DataFrame, nodes: DataFrame, like: Rule) -> DataFrame:
    """(u, v): a spanning forest of the likely pairs of different components in each group of rows (key, node, n, component, members)."""
    slots = F.when(F.col("members") <= BLOCK, 1).otherwise(F.ceil(F.col("members") * 2 / BLOCK)).cast("int")
    rows = _crossed(rows, slots).join(nodes.select("node", "signature"), "node")
    rows = rows.select("key", "a", "b", "node", "n", "component", "slot", "signature").repartition("key", "a", "b").sortWithinPartitions("key", "a", "b", "node")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches):
            if block.num_rows > 1:
                cols = _columns(block, range(1, 7))
                yield _edges(_forest(*cols[2:6], cols[0][0] != cols[1][0], _bytes_of(block.column(7).combine_chunks()), like))

    return rows.mapInArrow(run, "u long, v long")


def _families(buckets: DataFrame, label: DataFrame, nodes: DataFrame, like: Rule) -> DataFrame:
    """(u, v): edges that tie the nodes of likely pairs of different families (node, component) together, for the
    buckets that span several families.

    The family with most nodes in a bucket is its host, the other nodes are visitors.  A visitor meets all nodes of
    its host once, however many buckets they share, so a large family is not repeated for each; only
    visitors of one bucket are compared bucket by bucket."""
    rest = buckets.join(label, "node", "left").select("key", "node", "n", F.coalesce("component", "node").alias("component"))
    shares = rest.groupBy("key", "component").agg(F.count(F.lit(1)).alias("share"))
    apart = shares.groupBy("key").agg(F.max(F.struct("share", "component")).alias("most"), F.count(F.lit(1)).alias("families")).where("families > 1").select("key", F.col("most.component").alias("host"))
    visitors = materialize(rest.join(apart, "key").where("component <> host"), "visitors")
    several = visitors.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count(F.lit(1)).alias("members")).where("lo < hi").select("key", "members")
    met = visitors.select(F.col("host").alias("key"), "node", "n", F.bitwise_not("host").alias("component")).distinct()      # never the host's number
    hosts = met.groupBy("key").agg(F.count(F.lit(1)).alias("guests"))
    own = nodes.select("node", "n").join(label, "node", "left").select(F.coalesce("component", "node").alias("key"), "node", "n")
    own = own.join(hosts.select("key"), "key", "left_semi").withColumn("component", F.col("key"))
    both = materialize(met.unionByName(own), "hosts")
    sizes = both.groupBy("key").agg(F.count(F.lit(1)).alias("members"))
    edges = _tied(both.join(sizes, "key"), nodes, like).union(_tied(visitors.drop("host").join(several, "key"), nodes, like))
    return edges.distinct()


def block_links(node: np.ndarray, component: np.ndarray, slot: np.ndarray, crossed: bool, sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """The links of one block that join its components: exact on the full sets (sorted distinct hashes).

    Two sets similar enough share ``percent`` of the greater one's size at least, so they share one of the
    size - ceil(percent * size / 100) + 1 rarest members of each (rarity within the block)."""
    size = np.array([len(s) for s in sets])
    owner, off = np.repeat(np.arange(len(sets)), size), np.concatenate([[0], np.cumsum(size)])
    _, token, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    rare = np.lexsort((token, count[token], owner))
    rank = np.arange(len(token)) - off[owner]                   # place among its set's members, rarest first
    prefix = rare[rank <= (size - -(-percent * size // 100))[owner]]
    prefix = prefix[count[token[prefix]] > 1]
    mine, tokens = owner[prefix], token[prefix]
    begin = np.searchsorted(mine, np.arange(len(sets) + 1))
    by = np.argsort(tokens, kind="stable")
    held, holders = tokens[by], mine[by]
    root, out = np.unique(component, return_inverse=True)[1], []
    for i in range(1, len(sets)):
        want = tokens[begin[i]:begin[i + 1]]
        lo = np.searchsorted(held, want)
        n = np.searchsorted(held, want, side="right") - lo
        j = np.unique(holders[np.repeat(lo - np.cumsum(n) + n, n) + np.arange(n.sum())])
        j = j[(j < i) & (100 * np.minimum(size[j], size[i]) >= percent * np.maximum(size[j], size[i]))]
        if crossed:
            j = j[slot[j] != slot[i]]
        while len(j := j[root[j] != root[i]]):
            some, j = j[:64], j[64:]
            theirs = np.concatenate([sets[k] for k in some])
            at = np.minimum(np.searchsorted(sets[i], theirs), size[i] - 1)
            both = np.add.reduceat(sets[i][at] == theirs, np.concatenate([[0], np.cumsum(size[some])[:-1]]), dtype=np.int64)
            for k in some[100 * both >= percent * (size[some] + size[i] - both)]:
                if root[k] != root[i]:
                    root[root == root[k]] = root[i]
                    out.append((int(node[i]), int(node[k])))
    return out


def _join_families(docs: DataFrame, nodes: DataFrame, families: DataFrame, like: Rule) -> DataFrame:
    """(u, v): the links within families (node, family) that join components."""
    rows = families.join(nodes.select("node", "n", "s1", "s2"), "node")
    sizes = families.join(nodes.select("node", "n"), "node").groupBy("family").agg(F.sum("n").alias("shingles"))
    wanted = materialize(rows.join(sizes, "family").select("node", "s1", "s2", "family", "shingles"), "members")
    slots = F.when(F.col("shingles") <= 2 * SET_BLOCK, 1).otherwise(F.ceil(F.col("shingles") / SET_BLOCK)).cast("int")
    blocks = _crossed(_sets(docs, wanted, like.words), slots).select("family", "a", "b", "node", "slot", "members")
    blocks = blocks.repartition("family", "a", "b").sortWithinPartitions("family", "a", "b", "node")
    percent = like.percent

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches):
            if block.num_rows > 1:
                _, a, b, node, slot = _columns(block, range(5))
                sets = [np.frombuffer(x.as_buffer(), np.uint64) for part in block.column(5).chunks for x in part]
                yield _edges(block_links(node, node, slot, a[0] != b[0], sets, percent))

    return blocks.mapInArrow(run, "u long, v long")


def links(docs: DataFrame, nodes: DataFrame, like: Rule) -> DataFrame:
    """(node, component) of the nodes with links."""
    buckets = materialize(_buckets(nodes, like.halves), "buckets")
    stars = buckets.where("node > pivot").select(F.col("node").alias("u"), F.col("pivot").alias("v"))
    likely = materialize(_likely(stars, nodes, like), "likely")
    tied = materialize(components(likely), "families")
    more = materialize(_families(buckets, tied, nodes, like), "likely")
    if not more.isEmpty():
        tied = materialize(components(likely.union(more)), "families")
    families = tied.withColumnRenamed("component", "family").union(tied.select(F.col("component").alias("node"), "component").distinct())
    return materialize(components(materialize(_join_families(docs, nodes, families, like), "links")), "components")


def classes(docs: DataFrame, words: int = SHINGLE_WORDS, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), one row per input row."""
    like = rule(words, percent)
    rows = materialize(sketches(docs, like), "sketches")
    some = rows.where("n > 0 and doc_id is not null")
    nodes = some.groupBy("s1", "s2").agg(F.min(F.struct(F.col("doc_id").alias("node"), "n", "halves", "signature")).alias("x")).select("x.*", "s1", "s2")
    nodes = materialize(nodes, "nodes")
    label = links(docs, nodes, like)
    least = nodes.select("s1", "s2", "node").join(label, "node", "left").select("s1", "s2", F.coalesce("component", "node").alias("component"))
    placed = rows.select("doc_id", "s1", "s2", F.col("n").alias("n_shingles")).join(least, ["s1", "s2"], "left")
    placed = materialize(placed.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0), F.coalesce("component", "doc_id")).otherwise(F.col("doc_id")).alias("component_id")), "placed")
    # a doc_id whose rows lie in several components ties them together
    ties = placed.where("doc_id is not null").groupBy("doc_id").agg(F.min("component_id").alias("v"), F.max("component_id").alias("u")).where("u > v").select("u", "v")
    if not ties.isEmpty():
        many = placed.where("doc_id is not null").join(ties.select(F.col("u").alias("component_id")).union(ties.select(F.col("v").alias("component_id"))).distinct(), "component_id", "left_semi")
        tied = components(many.select(F.col("doc_id").alias("u"), F.col("component_id").alias("v")))
        placed = placed.join(tied.withColumnRenamed("node", "component_id"), "component_id", "left").withColumn("component_id", F.coalesce("component", "component_id")).drop("component")
    return placed.select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))


def keep_one(docs: DataFrame, placed: DataFrame) -> DataFrame:
    """``docs``, all columns whatever their names, without the documents that are not kept, and each kept doc_id in
    one row.  A null doc_id stays, as often as it is there."""
    free = lambda name: next(n for k in range(len(docs.columns) + 1) if (n := f"{name} {k}") not in docs.columns)
    gone_id, twice_id, row = free("gone id"), free("twice id"), free("row")
    key = docs["doc_id"].cast("long")
    gone = materialize(placed.where(~F.col("kept")).select(F.col("doc_id").alias(gone_id)).distinct(), "gone")
    twice = materialize(placed.where(F.col("kept") & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col("doc_id").alias(twice_id)), "twice")
    left = docs.join(spans.small_side(gone), key == F.col(f"`{gone_id}`"), "left_anti")
    if twice.isEmpty():
        return left
    marked, same = spans.small_side(twice), F.col("doc_id").cast("long") == F.col(f"`{twice_id}`")
    one = left.join(marked, same, "left_semi").withColumn(row, F.row_number().over(Window.partitionBy("doc_id").orderBy("text"))).where(F.col(f"`{row}`") == 1).drop(row)
    return left.join(marked, same, "left_anti").unionByName(one)


ORACLE = r"""
WITH RECURSIVE texts AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN []::VARCHAR[] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s
  FROM texts),
items AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets),
pairs AS (
  SELECT a.doc_id AS u, b.doc_id AS v FROM items a JOIN items b ON a.x = b.x AND a.doc_id < b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
links AS (SELECT u, v FROM pairs UNION SELECT v, u FROM pairs),
reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION SELECT r.a, l.v FROM reach r JOIN links l ON r.b = l.u)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, c.component_id, s.doc_id = c.component_id AS kept
FROM sets s JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY a) c ON s.doc_id = c.a
"""
