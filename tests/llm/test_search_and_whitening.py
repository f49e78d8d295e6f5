"""Operators 11, 12 and 13 against plain-Python versions."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
import regex

from scorewright.llm import lexical_search, license_scan, queries, whitening

from .conftest import table

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


# ---------------------------------------------------------------- 11, license scans

def words11(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text or ""))


def base_places(text):
    w, out = words11(text), []
    for phrase, label in license_scan.BASE.items():
        p = phrase.split()
        out += [(i, label) for i in range(len(w) - len(p) + 1) if w[i:i + len(p)] == p]
    return len(w), out


NOTED = ["Released under the MIT License.", "gnu_general-PUBLIC\nlicense; GNU General Public License", "CC BY cc-by ccby Cc.By", "MITLicense mit license mit license", "the MIT Licence", "Apche License, Apache Licens",
         "GNU Genral Publik Lisense", "submit license, it license", "é CC BY", "éMIT license", "Permission is hereby granted, free of charge, to any persn obtaning a copy", "x" * 300, "license " * 500, "cc by " * 400,
         "mit lic ense", "Apache 2 License", "ſ cc by K", "the Mozila Public License and the Eclipse Public License", "\x00MIT\x7fLICENSE\x00", "gnu lesser general public license"]


def noted(spark, docs):
    given = docs.select("doc_id", "text", "lang", "source", "n_chars")
    return docs.unionByName(spark.createDataFrame([(i, t, "en", "s", 1) for i, t in enumerate(NOTED, 2000)], given.schema), allowMissingColumns=True)


def test_license_base_places_equal_brute_force(spark, docs, nasty):
    got = table(license_scan.digests(license_scan.scan(noted(spark, docs))).select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels"))
    want = []
    for i, text in [(r[0], r[1]) for r in nasty] + list(enumerate(NOTED, 2000)):
        n, places = base_places(text)
        at = [p for p, _ in places]
        want.append((i, n, len(at), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in places}))))
    assert got == sorted(want, key=repr)


def test_license_finds_equal_search_without_seeds(spark, docs, nasty):
    """A notice is found just where its bounded-error pattern matches the whole text; spans point into the raw text."""
    texts = dict(enumerate(NOTED, 2000))
    got = {r.doc_id: r.spans for r in license_scan.scan(noted(spark, docs)).where("doc_id >= 2000").collect()}
    finder = license_scan.Finder(license_scan.NOTICES)
    for i, text in texts.items():
        line = " " + " ".join(words11(text)) + " "
        want = {n.text for n, p in zip(finder.notices, finder.patterns) if p.search(line)}
        assert {s.notice for s in got[i]} == want
        for s in got[i]:
            said = words11(text[s.start:s.end])
            assert said == words11(text)[s.first_word:s.last_word + 1]
            assert (s.edits == 0) == (" ".join(said) == s.notice)
    labels = {r.doc_id: (r.labels, r.base_labels) for r in license_scan.digests(license_scan.scan(noted(spark, docs))).where("doc_id >= 2000").collect()}
    assert labels[2004] == ("mit", "") and labels[2005] == ("apache", "") and labels[2006] == ("gpl", "") and labels[2007] == ("", "") and labels[2010] == ("mit", "")


def test_license_pieces_keep_every_edited_notice():
    rng, finder = random.Random(5), license_scan.Finder(license_scan.NOTICES)
    for _ in range(400):
        k = rng.randrange(len(finder.notices))
        n = finder.notices[k]
        rest = list(n.rest)
        for _ in range(rng.randrange(n.edits + 1)):
            at = rng.randrange(len(rest))
            rest[at:at + 1] = rng.choice([[], ["q"], [rest[at], "q"]])
        line = " see " + n.fixed + "".join(rest) + " end "
        whole = regex.compile(finder.patterns[k].pattern).search(line)
        found = [f for f in finder.find(line) if f[2] == k]
        assert whole and found and found[0][3] <= n.edits and found[0][3] == sum(whole.fuzzy_counts)


def test_license_of_nothing(nothing):
    assert license_scan.digests(license_scan.scan(nothing)).count() == 0


# ---------------------------------------------------------------- 12, whitening

def brute_whitening(rows, most=32):
    kept = [(i, v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    length = Counter(len(v) for _, v in kept)
    dim = max(length, key=lambda d: (length[d], d))
    kept = [(i, v) for i, v in kept if len(v) == dim]
    x = [[math.floor(64 * c) + 1000000 for c in v] for _, v in kept]
    n, s = len(x), [sum(c) for c in zip(*x)]
    off = [[n * a - b for a, b in zip(r, s)] for r in x]
    c = np.array(off, float) / n
    e, u = np.linalg.eigh(c.T @ c / n)
    return kept, n, [sum(o * o for o in r) for r in off], c, e[::-1][:most], u[:, ::-1][:, :most], np.trace(c.T @ c / n)


VECTORS = "vec_id long, embedding array<float>, label int, n long, component int"


def cloud(n, dim, seed=4, scale=1.0):
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, dim)) * np.linspace(3, 1, dim) * scale + rng.standard_normal(dim) * 5
    return [(i, [float(np.float32(c)) for c in r]) for i, r in enumerate(x)]


def check_whitening(spark, rows, tolerance=1e-7):
    frame = spark.createDataFrame([(i, v, 1, 7, 9) for i, v in rows], VECTORS)
    packed, dim = whitening.pack(frame)
    model = whitening.fit(packed, dim)
    got = whitening.whiten(packed, dim, model).toPandas()
    kept, n, deviation, c, e, u, trace = brute_whitening(rows)
    k = len(model.values)
    assert len(got) == len(kept) * k
    assert np.allclose(model.values, e[:k], rtol=1e-10) and np.allclose(model.explained, e[:k] / trace, rtol=1e-8)
    assert np.allclose(np.abs(np.sum(model.vectors * u[:, :k], 0)), 1, atol=1e-9)
    sign = np.sign(np.sum(model.vectors * u[:, :k], 0))
    want = c @ (u[:, :k] * sign) / np.sqrt(e[:k])
    assert got.n.eq(n).all() and (got.identity_error <= 1e-4).all() and got.component.tolist() == list(range(1, k + 1)) * len(kept)
    have = [(repr(None if np.isnan(i) else int(i)), int(v), tuple(w)) for i, v, w in zip(got.vec_id.astype(float)[::k], got.deviation[::k], got.whitened.to_numpy().reshape(-1, k))]
    for (i, v, w), (j, x, y) in zip(sorted(have), sorted((repr(i), v, tuple(w)) for (i, _), v, w in zip(kept, deviation, want)), strict=True):
        assert (i, v) == (j, x) and np.allclose(w, y, atol=tolerance)
    return model


def test_whitening_equals_dense_eigenvectors(spark):
    rows = cloud(900, 64)
    bad = [(1, None), (2, [None] * 64), (3, [float("nan")] + [0.0] * 63), (4, [float("inf")] + [0.0] * 63), (None, rows[5][1]), (0, rows[0][1]), (0, rows[0][1]), (9, [1.0, 2.0]), (10, [])]
    model = check_whitening(spark, bad + rows)
    assert len(model.values) == 32 and model.passes > 12


def test_whitening_of_few_dimensions_and_low_rank(spark):
    assert len(check_whitening(spark, cloud(50, 3)).values) == 3
    rng = np.random.default_rng(2)
    flat = [(i, [float(a), float(2 * a), 0.0, 7.0]) for i, a in enumerate(rng.integers(-50, 50, 40))]
    assert len(check_whitening(spark, flat).values) == 1
    assert len(check_whitening(spark, cloud(20, 60), 1e-6).values) == 19


def test_whitening_of_nothing_and_of_equal_vectors(spark):
    for rows in ([], [(1, None)], [(1, [1.0, 2.0])], [(1, [1.0, 2.0])] * 5, [(1, [])]):
        packed, dim = whitening.pack(spark.createDataFrame([(i, v, 1, 7, 9) for i, v in rows], VECTORS))
        frame = whitening.whiten(packed, dim, whitening.fit(packed, dim))
        assert frame.count() == 0 and frame.columns[:3] == ["vec_id", "component", "n"]


def test_whitening_of_huge_entries_is_exact(spark):
    rows = [(i, [float(a), float(b)]) for i, (a, b) in enumerate([(1e30, 1), (-1e30, 2), (1e12, 3), (5, 4)])]
    packed, dim = whitening.pack(spark.createDataFrame([(i, v, 1, 7, 9) for i, v in rows], VECTORS))
    model = whitening.fit(packed, dim)
    got = whitening.whiten(packed, dim, model).where("component = 1").collect()
    assert model.wide and len(got) == 4 and all(r.deviation is None for r in got)
    assert model.sums == [sum(max(-(1 << 62), min(1 << 62, math.floor(64 * float(np.float32(v[0]))))) + 1000000 for _, v in rows), 640 + 4000000]


# ---------------------------------------------------------------- 13, ranked lexical search

def brute_ranking(docs, items, top=20):
    terms = [TERM.findall(lower(t or "")) for _, t in docs]
    n_docs, total = sum(bool(t) for t in terms), sum(map(len, terms))
    df = Counter(x for t in terms for x in set(t))
    asked = {}
    for i, t in dict.fromkeys(items):
        asked.setdefault(i, []).extend(TERM.findall(lower(t or "")))
    out = []
    for item, wanted in asked.items():
        scored = []
        for (d, _), have in zip(docs, terms):
            tf, score = Counter(have), 0
            m = 75 + (25 * len(have) * n_docs) // total if total else 0
            for w in wanted:
                if tf[w]:
                    score += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * ((10**9 * tf[w]) // (1000 * tf[w] + 12 * m))
            if score > 0:
                scored.append((-score, d is None, d or 0, d))
        out += [(item, rank, d, -s) for rank, (s, _, _, d) in enumerate(sorted(scored, key=lambda x: x[:3])[:top], 1)]
    return sorted(out, key=repr)


def items_for(nasty, rng):
    texts = [t for _, t, *_ in nasty if t]
    said = [(k, " ".join(rng.choice(texts).split(" ")[:40])) for k in range(12)]
    return said + [(12, None), (13, ""), (14, "nowhere-to-be-found Zzz"), (15, "the The THE the"), (None, "an or in"), (3, "more of item three"), (5, said[5][1]), (16, "Ünïcode İΣ 漢字 w1x")]


ITEMS = "item_id long, text string, score long"


@pytest.mark.parametrize("leaf,postings,block", [(64, 2_000_000, 8 << 20), (2, 300, 200)])
def test_ranking_equals_brute_force(spark, docs, nasty, monkeypatch, leaf, postings, block):
    for name, value in (("LEAF", leaf), ("TREE_POSTINGS", postings)):
        monkeypatch.setattr(lexical_search, name, value)
    items = items_for(nasty, random.Random(9))
    frame = spark.createDataFrame([(i, t, 1) for i, t in items], ITEMS)
    got = lexical_search.rank_documents(docs, frame, block_bytes=block)
    assert table(got.select("item_id", "rank", "doc_id", "score")) == brute_ranking([(i, t) for i, t, *_ in nasty], items)


def test_tree_bounds_and_pruning(monkeypatch):
    """Every node's bound covers its documents' scores; the walk skips subtrees and loses nothing."""
    monkeypatch.setattr(lexical_search, "LEAF", 4)
    rng = np.random.default_rng(8)
    vectors = [np.sort(rng.choice(60, size=rng.integers(1, 30), replace=False)) for _ in range(500)] + [np.arange(5)] * 30
    off = np.cumsum([0, *map(len, vectors)])
    terms = np.concatenate(vectors)
    tf, m = rng.integers(1, 9, len(terms)), rng.integers(75, 300, len(vectors))
    tree = lexical_search.Tree(off, terms, tf, m, 60)
    assert sorted(tree.order.tolist()) == list(range(len(vectors)))
    for _ in range(20):
        item = lexical_search.Item(rng.choice(60, 8, replace=False), rng.integers(1, 9000, 8))
        score = np.zeros(len(vectors), np.int64)
        for d, v in enumerate(vectors):
            for t, w in zip(item.terms, item.weights):
                at = np.flatnonzero(v == t)
                if len(at):
                    c = int(tf[off[d] + at[0]])
                    score[d] += int(w) * ((10**9 * c) // (1000 * c + 12 * int(m[d])))
        bounds = tree.bounds(item, np.arange(tree.nodes))
        for node in range(tree.nodes):
            assert bounds[node] >= score[tree.order[tree.lo[node]:tree.hi[node]]].max()
        seen = []
        leaf_scores = tree.scores
        monkeypatch.setattr(tree, "scores", lambda i, n: (seen.append(n), leaf_scores(i, n))[1])
        best = lexical_search.Best(20)
        lexical_search.walk(tree, item, best, tree.order, np.zeros(len(vectors), bool))
        monkeypatch.setattr(tree, "scores", leaf_scores)
        assert best.score.tolist() == sorted(score[score > 0].tolist(), reverse=True)[:20]
        assert len(seen) < sum(not c for c in tree.children)


def test_ranking_of_nothing(spark, docs, nothing):
    items = spark.createDataFrame([(1, "the an", 1)], ITEMS)
    assert lexical_search.rank_documents(nothing, items).count() == 0
    none = lexical_search.rank_documents(docs, items.limit(0))
    assert none.count() == 0 and none.columns == ["item_id", "rank", "doc_id", "score"]


def test_registered():
    assert {"op11_license_scan", "op12_whitening", "op13_lexical_search"} <= set(queries.QUERIES)

