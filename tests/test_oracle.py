"""Every registered query against its DuckDB oracle on the smallest driver tables."""

import os

import pytest

import __spark_entry__ as E
from scorewright.plans.queries import QUERIES
from tools.oracle_check import compare, duck

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    ok, ns, nd, _, _, detail = compare(spark, con, name, E.queries()[name], E.oracle_sql()[name], SF)
    assert ok, f"{name}: spark={ns} duck={nd} {detail}"


def test_unjudged_answers_of_a_long_conversation(spark, tmp):
    """Items are named by conversation and part, also beyond 1,000 of them; system and other turns come along."""
    roles = ("user", "assistant")
    turns = [(c, t, roles[t % 2], f"turn {t} of {c}") for c, n in ((5, 4004), (6, 4)) for t in range(n)]
    turns += [(6, -1, "system", "be brief"), (6, 9, "system", "later"), (7, 0, "system", None), (7, 1, "user", None), (7, 2, "tool", "x"), (8, 0, "system", "alone")]
    spark.createDataFrame(turns, spark.read.parquet(f"{SF}/conversations.parquet").schema).write.parquet(f"{tmp}/conversations.parquet")
    con = duck(tmp)
    con.execute(f"CREATE OR REPLACE VIEW conversations AS SELECT * FROM read_parquet('{tmp}/conversations.parquet/*.parquet')")
    for name in ("unjudged_answers", "answer_validity", "item_turns", "conversation_messages"):
        ok, ns, nd, _, _, detail = compare(spark, con, name, E.queries()[name], E.oracle_sql()[name], tmp)
        assert ok, f"{name}: spark={ns} duck={nd} {detail}"
    assert E.queries()["unjudged_answers"](spark, tmp).where("conversation = 5 AND part = 1000").count() == 4


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and df.columns == ["model_id", "judge_key", "judge_name", "criterion", "score"]


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(E.oracle_sql())
