"""The pipeline stage by stage, and the registered queries over the driver's tables."""

import math
import os
import random
import re

import pytest

import corpus_pipeline
from scorewright.llm import near_dup, queries, secret_scan

from .conftest import SCHEMA, nasty_rows, table
from .test_corpus_operators import brute_repeats

SF = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    rows = nasty_rows(6, 40) + [(900, "my token = \"0123456789abcdef0123\" stays hidden here", "en", "s1", 1)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    columns, seen = docs.columns, {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        seen[name] = docs.collect()
        assert docs.columns == columns or k == 4
    assert list(seen) == ["toxicity", "near_dedup", "secrets", "mixing", "bpe"]
    assert len(seen["toxicity"]) == len(rows)                     # labels of one class: nothing to learn from
    assert {r.doc_id for r in seen["near_dedup"]} == brute_kept(rows, 5, 80) and len(seen["secrets"]) == len(seen["near_dedup"])
    assert next(r.text for r in seen["secrets"] if r.doc_id == 900) == "my [SECRET]\" stays hidden here"
    assert len(seen["bpe"]) == len(seen["mixing"]) > 0
    assert table(corpus_pipeline.run(spark, str(tmp_path))) == table(docs)


def brute_kept(rows, words, percent):
    """doc_ids of rows (doc_id, text, ...) that are the least of their group; rows of one doc_id are one document."""
    sets = []
    for i, text, *_ in rows:
        w = [x for x in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if x]
        sets.append((i, {tuple(w[k:k + words]) for k in range(len(w) - words + 1)} or ({tuple(w)} if w else set())))
    group = {i: i for i, _ in sets}
    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and b and i is not None and j is not None and 100 * len(a & b) >= percent * len(a | b):
                lo, hi = sorted((group[i], group[j]))
                group = {x: lo if g == hi else g for x, g in group.items()}
    return {i for i, g in group.items() if i == g}


CLASHES = ("gone", "twice", "which row", "row", "gone id 0", "mix times 0", "n", "times", "mix doc_id", "mix times", "node", "key", "size", "score", "ids", "component_id", "kept")


def test_stages_with_clashing_names_and_nulls(spark, tmp_path):
    """Further columns, whatever their names, come through all stages but the last; nulls and repeats have the stated results."""
    rows = nasty_rows(11, 30)
    frame = spark.createDataFrame(rows, SCHEMA)
    for c in CLASHES:
        frame = frame.withColumn(c, frame["source"])
    frame.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, 1, 0), (2, 1, 1), (None, None, None)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    columns = docs.columns
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, str(tmp_path))
        if k < 4:
            assert out.columns == columns, name
            out.write.parquet(f"{tmp_path}/{k}")
            docs = spark.read.parquet(f"{tmp_path}/{k}")
            assert all(r["gone"] == r["source"] == r["kept"] for r in docs.collect())
    assert out.count() == docs.count() > 0


def test_stages_of_an_empty_table(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        assert out.count() == 0 and (out.columns == docs.columns or name == "bpe"), name
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_near_copies_between_80_and_85_percent_go(spark):
    """Copies with a fifth of their text appended or cut off: J = 0.83 for shingles of 3 and of 5 words."""
    rng = random.Random(8)
    long = [[f"w{rng.randrange(10**6)}" for _ in range(240)] for _ in range(12)]
    rows = [(i, " ".join(w[:200]), "en", "s0", 0) for i, w in enumerate(long)]
    rows += [(100 + i, " ".join(w), "en", "s0", 0) for i, w in enumerate(long[:6])] + [(200 + i, " ".join(w[:167]), "en", "s0", 0) for i, w in enumerate(long[6:])]
    rows += [(300 + i, " ".join(w[:155]), "en", "s0", 0) for i, w in enumerate(long[6:9])] + [(400, "a b c d", "en", "s0", 0), (401, "A b c  d", "en", "s0", 0)]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = {r.doc_id for r in corpus_pipeline.drop_near_copies(spark, docs, "").collect()}
    assert got == brute_kept(rows, 5, 80) and not any(100 <= i < 200 for i in got)
    assert {r.doc_id for r in near_dup.classes(docs).where("kept").collect()} == brute_kept(rows, 3, 85) >= {100, 101, 102, 103, 104, 105}


@pytest.mark.parametrize("percent", [80, 85, 95])
def test_tables_and_signature_bound_follow_the_percent(percent):
    like, p = near_dup.rule(5, percent), percent / 100
    m = 2 * near_dup.ROWS * like.halves
    assert 1 - (1 - (1 - p ** near_dup.ROWS) ** like.halves) ** 2 < near_dup.MISSED
    assert sum(math.comb(m, k) * p ** k * (1 - p) ** (m - k) for k in range(like.likely)) < near_dup.UNLIKELY


def test_signature_filter_loses_less_than_a_pair_in_a_million():
    lost = sum(math.comb(72, k) * 0.85 ** k * 0.15 ** (72 - k) for k in range(near_dup.rule().likely))
    assert near_dup.rule().halves == 12 and lost < 1e-6


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
def test_oracles_and_brute_force_on_driver_tables(spark):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in ("documents", "conversations", "benchmark"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    for name, sql in queries.ORACLE.items():
        frame = queries.QUERIES[name](spark, SF)
        want = con.sql(sql)
        assert frame.columns == want.columns
        assert table(frame) == sorted(want.fetchall(), key=repr), name
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert table(queries.op2_repeats(spark, SF)) == brute_repeats(rows)


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_each_query_returns_a_row_per_document(spark, name):
    frame = queries.QUERIES[name](spark, SF)
    key = frame.columns[0]
    ids = {r[0] for r in frame.select(key).collect()}
    table_ = spark.read.parquet(f"{SF}/{ {'conv_id': 'conversations', 'vec_id': 'embeddings', 'item_id': 'benchmark'}.get(key, 'documents')}.parquet")
    assert ids - {-7} == {r[0] for r in table_.select(key).collect()}


def test_operators_are_registered():
    assert [int(n[2:].split("_")[0]) for n in queries.QUERIES] == list(range(1, 14))
    assert near_dup.PERCENT == 85 and secret_scan.KINDS[:3] == ("assign", "access", "hex")
