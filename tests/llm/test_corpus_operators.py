"""Operators that compare documents: 2, 3, 5 and 10, and the pipeline, against plain-Python versions."""

import hashlib
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from scorewright.llm import fingerprints, mixing, near_dup, repeats, spans

from .conftest import SCHEMA, WORD, nasty_rows, prose, table


def brute_repeats(rows):
    """Straight from the definition: strings of smaller ids first."""
    out, seen, waiting, last = [], set(), [], object()
    for i, text, *_ in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        b = (text or "").encode()
        if i != last:
            seen.update(waiting)
            waiting, last = [], i
        gone, strings = np.zeros(len(b), bool), [b[j:j + 50] for j in range(len(b) - 49)]
        for j, s in enumerate(strings):
            if s in seen:
                gone[j:j + 50] = True
        waiting += strings
        runs = int((gone & ~np.concatenate([[False], gone[:-1]])).sum()) if len(b) else 0
        out.append((i, len(b), int(gone.sum()), runs, hashlib.sha256(bytes(np.frombuffer(b, np.uint8)[~gone])).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("parts", [1, 7])
def test_repeats_equal_brute_force(docs, nasty, parts):
    assert table(repeats.digests(repeats.cut(docs.repartition(parts)))) == brute_repeats(nasty)


def test_repeats_in_many_small_buckets_and_hot_passages(spark, monkeypatch):
    monkeypatch.setattr(repeats, "BUCKET_BYTES", 2_000)
    monkeypatch.setattr(repeats, "BROADCAST_BYTES", 0)
    rng = random.Random(9)
    line = prose(rng, 14)
    rows = [(i, prose(rng, rng.randint(1, 60)) + "\n" + line + "\n" + prose(rng, 5), "en", "s", 0) for i in range(80)] + nasty_rows(4, 20)
    assert table(repeats.digests(repeats.cut(spark.createDataFrame(rows, SCHEMA).repartition(6)))) == brute_repeats(rows)


@pytest.mark.parametrize("hot_docs", [3, 30])
def test_repeats_of_hot_leading_strings(spark, hot_docs):
    rng = random.Random(12)
    line = prose(rng, 20)
    rows = [(i % 50, prose(rng, rng.randint(1, 40)) + line + prose(rng, 5), "en", "s", 0) for i in range(60)] + [(None, line, None, None, None), (90, "ab" * 400, None, None, None), (91, "ab" * 90, None, None, None)]
    assert table(repeats.digests(repeats.cut(spark.createDataFrame(rows, SCHEMA).repartition(5), hot_docs))) == brute_repeats(rows)


def test_multikey_sort_finds_the_strings_of_several_documents():
    rng = np.random.default_rng(4)
    buf = rng.integers(97, 99, 3000, dtype=np.uint8)
    at, doc, group = rng.integers(0, 2900, 900), rng.integers(0, 40, 900), rng.integers(0, 3, 900)
    strings = [(g, buf[a:a + 16].tobytes()) for g, a in zip(group, at)]
    holders = {}
    for s, d in zip(strings, doc):
        holders.setdefault(s, set()).add(int(d))
    kept, number, least = repeats.multikey_sort(repeats._words8(buf), at, (0, 8), group, doc)
    assert sorted(kept.tolist()) == [i for i, s in enumerate(strings) if len(holders[s]) > 1]
    assert all(min(holders[strings[i]]) == least[k] for k, i in enumerate(kept))
    assert len({(n, strings[i]) for n, i in zip(number, kept)}) == len(set(number.tolist())) == len({strings[i] for i in kept})


def test_repeats_in_pieces_of_a_long_text(spark, monkeypatch):
    monkeypatch.setattr(repeats, "CHUNK_BYTES", 500)
    rng = random.Random(10)
    long = prose(rng, 600)
    rows = [(1, long, None, None, None), (2, prose(rng, 30) + long[700:1900] + prose(rng, 300), None, None, None), (0, "y" * 300, None, None, None), (3, "y" * 49, None, None, None), (4, "y" * 51, None, None, None)]
    frame = spark.createDataFrame(rows, SCHEMA)
    keyed = repeats._keyed(frame)

    # the size of a piece is read where the work runs: one process here
    got = {}
    for batch in [keyed.toPandas()]:
        for r in batch.itertuples():
            got[r.doc] = r.text.encode()
    blocks = []
    for doc, raw in got.items():
        buf = np.frombuffer(raw, np.uint8)
        chunk = repeats.spans.Chunk(None, buf, np.array([0, len(buf)]))
        for part, off, base in repeats._pieces(np.array([doc]), chunk):
            row, lo, hi, at = repeats.anchors(part, off)
            if len(row):
                blocks += repeats._flush({0: [repeats._pack(np.array([doc]), np.array([doc]), part, row, lo, hi, at, base, off)]})[1]
    docs, _, packed = repeats.bucket_removals(blocks)
    gone = {d: np.zeros(len(raw), bool) for d, raw in got.items()}
    for d, p in zip(docs, packed):
        for a, b in np.frombuffer(p, np.int64).reshape(-1, 2):
            gone[d][a:b] = True
    assert sorted((d, int(g.sum())) for d, g in gone.items()) == sorted((r[0], r[2]) for r in brute_repeats(rows))


def test_repeats_without_rows(nothing):
    assert repeats.cut(nothing).count() == 0


def test_knapsack_reaches_the_best_sum():
    rng = random.Random(3)
    for _ in range(200):
        lengths = sorted(rng.sample(range(1, 40), rng.randint(1, 6)))
        spare, budget = [rng.randint(0, 4) for _ in lengths], rng.randint(0, 120)
        take = mixing.knapsack(lengths, spare, budget)
        sums = {0}
        for n, c in zip(lengths, spare):
            sums = {s + n * k for s in sums for k in range(c + 1)}
        assert all(0 <= t <= c for t, c in zip(take, spare))
        assert sum(t * n for t, n in zip(take, lengths)) == max(s for s in sums if s <= budget)


def test_targets():
    assert mixing.targets({"a": 100, "b": 100, None: 100}) == {"a": 50.0, "b": 100.0, None: 150.0}
    got = mixing.targets({"a": 1000, "b": 10, "c": 10})
    assert got["b"] == got["c"] == 30 and math.isclose(got["a"], 960)
    assert mixing.targets({}) == {} and mixing.targets({None: 0}) == {None: 0.0}


def test_targets_of_many_sources(spark):
    """As many sources as hosts, null among them, numbered in ranges: the targets of the plain form."""
    size = {f"host {i * i % 7919}é{i}": i % 13 * (1 + i % 5 * 40) for i in range(2500)} | {None: 77, "": 5}
    frame = spark.createDataFrame([(f"={s}" if s is not None else "null", s, n) for s, n in size.items()], "name string, source string, source_size long").repartition(7)
    for cycle, most in (((1, 2, 3), 3), ((5, 1), 1), ((1, 40), 2)):
        got = {r.source: r.target for r in mixing.source_targets(frame, cycle, most).collect()}
        want = mixing.targets(size, cycle, most)
        assert got == want and abs(sum(got.values()) - sum(size.values())) < 1e-6
        assert all(want[s] <= most * n for s, n in size.items())
    assert mixing.source_targets(frame.limit(0)).count() == 0
    places = spans.numbered(frame, [F.col("source").asc_nulls_last()], "place").orderBy("place").collect()
    assert [r.place for r in places] == list(range(len(size)))
    assert [r.source for r in places] == sorted(s for s in size if s is not None) + [None]


def test_mix(spark, docs, nasty, nothing):
    rows = mixing.mix(docs).collect()
    size = lambda t: len(WORD.findall(t or ""))
    assert sorted(((r.doc_id, r.source, r["size"]) for r in rows), key=repr) == sorted(((i, s, size(t)) for i, t, _, s, _ in nasty), key=repr)
    total = {}
    for _, t, _, s, _ in nasty:
        total[s] = total.get(s, 0) + size(t)
    goal, taken = mixing.targets(total), {}
    for r in rows:
        assert r.source_size == total[r.source] and math.isclose(r.target, goal[r.source])
        assert r.taken == r.times * r["size"] and 0 <= r.times <= 3
        taken[r.source] = taken.get(r.source, 0) + r.taken
    for s in total:           # as near as whole texts, each up to three times, can come
        reach, top = 1, round(goal[s])
        for n in (size(t) for _, t, _, x, _ in nasty if x == s):
            for _ in range(3):
                reach |= reach << n & (1 << top + 1) - 1
        assert reach.bit_length() - 3 <= taken[s] <= top
    again = mixing.mix(docs.repartition(5))
    assert table(again.select("doc_id", "source", "size", "taken")) == sorted(((r.doc_id, r.source, r["size"], r.taken) for r in rows), key=repr)
    assert mixing.mix(nothing).count() == 0
    kept = mixing.repeat_rows(docs, mixing.mix(docs))
    assert kept.columns == docs.columns
    once = {r.doc_id: r.times for r in rows if r.doc_id not in (None, 91)}
    count = {i: 0 for i in once}
    for r in kept.collect():
        if r.doc_id in count:
            count[r.doc_id] += 1
    assert count == once


def brute_classes(rows):
    sets = []
    for i, text, *_ in rows:
        w = [x for x in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if x]
        sets.append((i, {tuple(w[k:k + 3]) for k in range(len(w) - 2)} if len(w) > 2 else {tuple(w)} if w else set()))
    parent = {i: i for i, _ in sets if i is not None}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and b and i is not None and j is not None and 100 * len(a & b) >= 85 * len(a | b):
                x, y = sorted((root(i), root(j)))
                parent[y] = x
    return sorted(((i, len(s), None if i is None else root(i), i is None or root(i) == i) for i, s in sets), key=repr)


def test_classes_equal_brute_force(docs, nasty, nothing):
    assert table(near_dup.classes(docs)) == brute_classes(nasty)
    assert near_dup.classes(nothing).count() == 0


def near_family(rng, first, n, edits):
    base = prose(rng, 120).split(" ")
    rows = []
    for k in range(n):
        words = list(base)
        for _ in range(rng.randint(0, edits)):
            words[rng.randrange(len(words))] = f"z{rng.randrange(10**6)}"
        rows.append((first + k, " ".join(words), "en", "s", 0))
    return rows


@pytest.mark.parametrize("edits, block", [(3, 1024), (7, 8)])
def test_classes_of_large_families(spark, monkeypatch, edits, block):
    """Families around the threshold: buckets span components and are searched in blocks."""
    monkeypatch.setattr(near_dup, "BLOCK", block)
    rng = random.Random(edits)
    rows = near_family(rng, 0, 60, edits) + near_family(rng, 100, 40, edits) + [(200 + i, prose(rng, 9) + " " + "shared words in every one of these texts", "en", "s", 0) for i in range(40)]
    assert table(near_dup.classes(spark.createDataFrame(rows, SCHEMA))) == brute_classes(rows)


def test_links_of_a_block_equal_brute_force():
    """The prefix index misses no pair: the components joined are those of all pairs, and a forest leaves the block."""
    rng = random.Random(12)
    for percent in (80, 85, 95):
        for crossed in (False, True):
            base = [rng.randrange(1 << 60) for _ in range(60)]
            sets = []
            for _ in range(70):
                members = set(base[:rng.choice([40, 50, 60])]) | {rng.randrange(1 << 60) for _ in range(rng.randint(0, 12))}
                sets.append(np.array(sorted(members), np.uint64))
            sets += [np.array([rng.randrange(1 << 60)], np.uint64) for _ in range(3)] + [sets[0][:1], sets[0][:1]]
            node = np.arange(100, 100 + len(sets))
            component, slot = node.copy(), np.array([rng.randrange(2) for _ in sets])
            component[5] = component[3]
            found = near_dup.block_links(node, component, slot, crossed, sets, percent)
            want = [(i, j) for i in range(len(sets)) for j in range(i) if (not crossed or slot[i] != slot[j])
                    and 100 * len(np.intersect1d(sets[i], sets[j])) >= percent * len(np.union1d(sets[i], sets[j]))]

            def groups(pairs):
                group = {i: component[i] for i in range(len(sets))}
                for i, j in pairs:
                    lo, hi = sorted((group[i], group[j]))
                    group = {k: lo if g == hi else g for k, g in group.items()}
                return group
            assert groups([(u - 100, v - 100) for u, v in found]) == groups(want) and len(found) < len(sets)
            assert all(tuple(sorted((u - 100, v - 100), reverse=True)) in set(want) for u, v in found)


def test_families_larger_than_a_block(spark, monkeypatch):
    """Sets travel to several blocks of a family and no link is lost."""
    monkeypatch.setattr(near_dup, "SET_BLOCK", 1500)
    monkeypatch.setattr(near_dup, "BLOCK", 16)
    rng = random.Random(21)
    rows = near_family(rng, 0, 80, 8) + near_family(rng, 100, 30, 6)
    assert table(near_dup.classes(spark.createDataFrame(rows, SCHEMA))) == brute_classes(rows)


def test_components_of_a_chain(spark):
    chain = [(i, i + 1) for i in range(0, 40)] + [(100, 101), (103, 101), (7, 7)]
    rows = near_dup.components(spark.createDataFrame(chain, "u long, v long")).collect()
    assert {r.node: r.component for r in rows} == {**{i: 0 for i in range(1, 41)}, 101: 100, 103: 100}      # but for the least


def test_one_vertex_for_the_rows_of_a_doc_id(spark):
    rng = random.Random(1)
    a, b = prose(rng, 50), prose(rng, 50)
    rows = [(5, a, None, None, None), (5, b, None, None, None), (3, a, None, None, None), (4, b, None, None, None), (9, prose(rng, 50), None, None, None)]
    got = {(r.doc_id, r.component_id) for r in near_dup.classes(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {(5, 3), (3, 3), (4, 3), (9, 9)}


def test_keep_one(docs, nasty):
    placed = near_dup.classes(docs)
    left = near_dup.keep_one(docs, placed)
    assert left.columns == docs.columns
    want = [i for i, _, c, kept in brute_classes(nasty) if kept]
    ids = sorted((r.doc_id for r in left.collect()), key=repr)
    assert ids == sorted([*{i for i in want if i is not None}, *[None] * want.count(None)], key=repr)


def weighted_jaccard(a, b):
    a, b = ({w: x.count(w) for w in x} for x in (WORD.findall(a), WORD.findall(b)))
    keys = {*a, *b}
    return sum(min(a.get(w, 0), b.get(w, 0)) for w in keys) / sum(max(a.get(w, 0), b.get(w, 0)) for w in keys) if keys else 1.0


def test_fingerprints(docs, nasty, nothing):
    rows = fingerprints.compare(docs).collect()
    distinct = {}
    for i, text, *_ in nasty:
        distinct.setdefault((i, text or ""), 0)
        distinct[i, text or ""] += 1
    one = [(i, t) for i, t in distinct if not any(j == i and u != t for j, u in distinct)]      # ids of one text: their order is plain
    order = sorted(distinct, key=lambda x: (x[0] is not None, x[0] or 0))
    assert len(rows) == len(nasty)
    got = {}
    for r in rows:
        got.setdefault(r.doc_id, []).append(r)
    prints, errors = {}, []
    for i, text in one:
        at = order.index((i, text))
        after = order[(at + 1) % len(order)]
        r = got[i][0]
        assert len(got[i]) == distinct[i, text] and len({tuple(x) for x in got[i]}) == 1
        half = len(text) // 2
        edited = text[:len(text) - half] + after[1][:half]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert prints.setdefault(text, r.fingerprint) == r.fingerprint and prints.setdefault(edited, r.edited_fingerprint) == r.edited_fingerprint
        errors += [r.near_edited - weighted_jaccard(text, edited), r.near_next - weighted_jaccard(text, after[1])]
    assert abs(np.mean(errors)) < 0.03 and np.std(errors) < 0.12
    assert fingerprints.compare(nothing).count() == 0


def test_collision_rate_is_the_generalised_jaccard_similarity(spark):
    texts = ["a a a a b b c d", "a a b b b c e e e"]
    frame = spark.createDataFrame([(i, " ".join(f"{w}{k}" for w in t.split())) for k in range(400) for i, t in enumerate(texts, 2 * k)], "gid long, text string").repartition(4, "gid")
    m = {r.gid: r.m for r in fingerprints.sketch(frame, ["gid"]).collect()}
    rate = np.mean([x == y for k in range(400) for x, y in zip(m[2 * k], m[2 * k + 1])])
    assert abs(rate - weighted_jaccard(*texts)) < 0.02


def test_likeness_is_a_share_of_at_least_32_samples(spark):
    r = fingerprints.compare(spark.createDataFrame([(4, "one two three", None, None, None)], SCHEMA)).first()
    assert len(r.fingerprint) == len(r.edited_fingerprint) == 6 * fingerprints.K
    assert fingerprints.K >= 32 and 0.5 / fingerprints.K ** 0.5 < 0.09        # standard error at worst


def test_single_document(spark):
    r = fingerprints.compare(spark.createDataFrame([(4, "one two three", None, None, None)], SCHEMA)).first()
    assert r.edited_sha256 == hashlib.sha256(b"one two" + b"one tw").hexdigest() and r.near_next == 1.0
