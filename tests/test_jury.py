"""Jury strategies (FIXTURES 2.3) and judge expansion."""

import pytest

from scorewright.functions.scores import SCORE_COLS
from scorewright.operators.jury import expand_judges, judge_alias, jury_scores, parse_judges, resolve_strategy


def judges_df(spark, corrects, usable=None):
    usable = usable or [True] * len(corrects)
    data = []
    for i, (c, u) in enumerate(zip(corrects, usable)):
        vals = [c, 1.0, 0.5, 0.5, 0.5, 0.5, 0.1 * (i + 1)] if u else [None] * 7
        data.append((1, i + 1, u, *vals))
    schema = "a int, judge_pos int, usable boolean, " + ", ".join(f"{c} double" for c in SCORE_COLS)
    return spark.createDataFrame(data, schema)


def run(spark, corrects, strategy, usable=None):
    return jury_scores(judges_df(spark, corrects, usable), ["a"], strategy).collect()[0]


def test_vote_majority_keeps_only_correct_judges(spark):
    r = run(spark, [1.0, 1.0, 0.0], "vote")
    assert r["correct"] == 1.0 and r["final_score"] == pytest.approx(0.15)


@pytest.mark.parametrize("corrects", [[1.0, 0.0], [0.0, 0.0, 1.0], [0.6667, 0.6667]])
def test_vote_tie_or_minority_is_zero(spark, corrects):
    r = run(spark, corrects, "vote")
    assert all(r[c] == 0.0 for c in SCORE_COLS)


def test_vote_fractional_votes_for_neither(spark):
    r = run(spark, [1.0, 0.6667, 0.3333], "vote")
    assert r["correct"] == 1.0 and r["final_score"] == pytest.approx(0.1)


@pytest.mark.parametrize("corrects,expected", [([1.0, 1.0, 0.0], 2 / 3), ([1.0, 0.0], 0.5), ([0.0, 0.0, 1.0], 1 / 3),
                                               ([1.0, 0.6667, 0.3333], 2.0 / 3)])
def test_average(spark, corrects, expected):
    assert run(spark, corrects, "average")["correct"] == pytest.approx(expected)


def test_one_usable_of_three_and_none_usable(spark):
    r = run(spark, [1.0, 1.0, 1.0], "vote", usable=[False, True, False])
    assert r["correct"] == 1.0 and r["final_score"] == pytest.approx(0.2)
    r = run(spark, [1.0, 1.0], "vote", usable=[False, False])
    assert r["n_usable"] == 0 and all(r[c] is None for c in SCORE_COLS)


def test_vote_of_identical_judges_equals_single(spark):
    one = run(spark, [1.0], "average")
    three = spark.createDataFrame([(1, i, True, 1.0, 1.0, 0.5, 0.5, 0.5, 0.5, 0.1) for i in (1, 2, 3)],
                                  "a int, judge_pos int, usable boolean, "
                                  + ", ".join(f"{c} double" for c in SCORE_COLS))
    v = jury_scores(three, ["a"], "vote").collect()[0]
    assert all(v[c] == pytest.approx(one[c] if c != "final_score" else 0.1) for c in SCORE_COLS)


def test_strategy_and_judges_args(spark):
    assert resolve_strategy(["gpt-4o"], "vote") == "SingleJudge"
    assert resolve_strategy(["a", "b"], "average") == "average"
    with pytest.raises(ValueError):
        resolve_strategy(["a", "b"], "median")
    assert parse_judges(" GPT-4o, claude-3.5-sonnet ,") == ["gpt-4o", "claude-3.5-sonnet"]


def test_expand_judges_is_a_generator_not_a_join(spark):
    answers = spark.createDataFrame([(1,), (2,)], "a int")
    out = expand_judges(answers, ["gpt-4o", "claude"], {"claude": "claude-3-5-sonnet-x"})
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Generate" in plan
    got = sorted((r["a"], r["judge_pos"], r["judge_model"]) for r in out.collect())
    assert {r["judge_name"] for r in out.collect()} == {"gpt-4o", "claude"}          # results keep the configured name
    assert got == [(1, 1, "gpt-4o"), (1, 2, "claude-3-5-sonnet-x"), (2, 1, "gpt-4o"), (2, 2, "claude-3-5-sonnet-x")]


def test_judge_alias(spark):
    from pyspark.sql import functions as F
    df = spark.createDataFrame([("claude-3.5-sonnet",), ("gpt-4o",)], "n string")
    got = [r[0] for r in df.select(judge_alias(F.col("n"), {"claude-3.5-sonnet": "claude-3-5-sonnet-20241022"}))
           .collect()]
    assert got == ["claude-3-5-sonnet-20241022", "gpt-4o"]
