"""Verdict extraction, coercion, zeroing, normalisation and weighting (FIXTURES 2.1, 2.2)."""

import json

import pytest
from pyspark.sql import functions as F

from scorewright.functions.scores import CRITERIA, extract_block, sql_coerce
from scorewright.operators.scoring import number_judges, score_verdicts

FENCE = "```"


def block(tag, obj, ws="\n"):
    body = obj if isinstance(obj, str) else json.dumps(obj)
    return f"<{tag}>{ws}{FENCE}json{ws}{body}{ws}{FENCE}{ws}</{tag}>"


def scores(c, x, y, h, o, m):
    return {"Correct": c, "Complete": x, "Concise": y, "Helpful": h, "Honest": o, "Harmless": m}


def score(spark, response, round_=0):
    df = spark.createDataFrame([(1, response, round_)], "id int, response string, round int")
    return score_verdicts(df).collect()[0]


@pytest.mark.parametrize("response,usable", [
    ("intro " + block("results1", scores(1, 1, 3, 5, 5, 5)), True),
    (block("results1", scores(1, 1, 3, 5, 5, 5)) + block("results1", scores(0, 0, 0, 0, 0, 0)), True),
    ("no fence <results1>{\"Correct\": 1}</results1>", False),
    (block("results9", scores(1, 1, 3, 5, 5, 5)), False),
    ("<results1>\n```JSON\n{\"Correct\": 1}\n```\n</results1>", False),
    (block("results1", '{"Correct": 1, "Complete": '), False),
    (block("results1", '{"Correct": 1, "Complete": 1,}'), False),
    (block("results1", "{}"), False),
    ("Error during call: timeout", False),
    (block("results1", scores(1, 1, 3, 5, 5, 5), ws=" \n"), True),
])
def test_extraction_cases(spark, response, usable):
    assert score(spark, response)["usable"] is usable


def test_first_block_wins_and_nested_object(spark):
    r = score(spark, block("results1", scores(1, 1, 3, 5, 5, 5)) + block("results1", scores(0, 0, 0, 0, 0, 0)))
    assert r["final_score"] == 0.9167
    nested = block("results1", {"Correct": 1, "Complete": 1, "Concise": 3, "Helpful": {"a": 5, "b": 3},
                                "Honest": 5, "Harmless": 5})
    r = score(spark, nested)
    assert r["usable"] and r["helpful"] == 0.75


def test_duplicate_key_last_wins(spark):
    r = score(spark, block("results1", '{"Correct": 0, "Complete": 1, "Concise": 3, "Helpful": 5, '
                                       '"Honest": 5, "Harmless": 5, "Correct": 1}'))
    assert r["correct"] == 1.0


@pytest.mark.parametrize("raw,expected", [
    ("4", 4.0), ("4.5", 4.5), ("true", 1.0), ('"4"', 0.0), ("null", 0.0), (None, 0.0),
    ('[1, "x", 3]', 2.0), ("[]", 0.0),
    ('{"a": 1, "b": "x", "c": 4}', 2.5), ("{}", 0.0), ('{"a": {"z": 1}}', 0.0),
])
def test_coercion(spark, raw, expected):
    doc = '{"Other": 1}' if raw is None else '{"Concise": ' + raw + "}"
    df = spark.createDataFrame([(doc,)], "s string")
    got = df.select(F.expr(sql_coerce("element_at(try_variant_get(try_parse_json(s), '$', 'map<string,variant>'), 'Concise')")).alias("v")).collect()[0]["v"]
    assert got == expected


@pytest.mark.parametrize("raw,norm,final", [
    ((1, 1, 3, 5, 5, 5), (1, 1, 0.5, 1, 1, 1), 0.9167),
    ((1, 0, 2, 4, 3, 5), (1, 0, 0.25, 0.75, 0.5, 1), 0.5833),
    ((0, 1, 5, 5, 5, 5), (0, 0, 0, 0, 0, 0), 0.0),
    ((2, 1, 5, 5, 5, 5), (1, 0, 0, 0, 0, 0), 0.1667),
    ((1, 1, 7, 0.5, 1, 5), (1, 1, 1.5, 0, 0, 1), 0.75),
    ((0.5, 1, 5, 5, 5, 5), (0, 0, 0, 0, 0, 0), 0.0),
])
def test_normalisation_table(spark, raw, norm, final):
    r = score(spark, block("results1", scores(*raw)))
    assert tuple(r[c] for c in CRITERIA) == tuple(float(x) for x in norm)
    assert r["final_score"] == final


def test_round2_weights(spark):
    resp = block("results1", scores(1, 1, 3, 5, 5, 5)) + "\n" + block("results2", scores(0, 1, 5, 5, 5, 5))
    r = score(spark, resp, 2)
    assert tuple(r[c] for c in CRITERIA) == (0.6667, 0.6667, 0.3333, 0.6667, 0.6667, 0.6667)
    assert r["final_score"] == 0.6111


def test_round2_needs_both_blocks_and_bad_round(spark):
    assert score(spark, block("results1", scores(1, 1, 3, 5, 5, 5)), 2)["usable"] is False
    assert score(spark, block("results1", scores(1, 1, 3, 5, 5, 5)), 3)["usable"] is False


def test_failed_judge_renumbers(spark):
    good = block("results1", scores(1, 1, 3, 5, 5, 5))
    df = spark.createDataFrame([(1, 1, "bad", 0), (1, 2, good, 0), (1, 3, good, 0)],
                               "doc_id int, judge_pos int, response string, round int")
    out = {r["judge_pos"]: r["judge_key"] for r in number_judges(score_verdicts(df), ["doc_id"]).collect()}
    assert out == {2: "Judge 1", 3: "Judge 2"}


def test_scoring_plan_is_native_and_parses_once(spark):
    df = spark.createDataFrame([(1, block("results1", scores(1, 1, 3, 5, 5, 5)), 0)],
                               "id int, response string, round int")
    plan = score_verdicts(df).filter("usable")._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    # the usable filter stays above the generator: the parse below it runs once per row
    assert plan.index("Filter usable") < plan.index("Generate inline")


def test_extract_block_returns_variant(spark):
    df = spark.createDataFrame([(block("results1", scores(1, 1, 3, 5, 5, 5)),)], "r string")
    v = df.select(F.to_json(extract_block(F.col("r"), "results1")).alias("j")).collect()[0]["j"]
    assert json.loads(v)["Concise"] == 3


def test_optional_clamp(spark):
    df = spark.createDataFrame([(1, block("results1", scores(1, 1, 7, 5, 5, 5)), 0)], "id int, response string, round int")
    assert score_verdicts(df).collect()[0]["concise"] == 1.5
    assert score_verdicts(df, clamp=True).collect()[0]["concise"] == 1.0


def test_rescoring_replaces_scores(spark):
    df = spark.createDataFrame([(1, block("results1", scores(1, 1, 3, 5, 5, 5)), 0)], "id int, response string, round int")
    twice = score_verdicts(score_verdicts(df))
    assert twice.columns.count("usable") == 1 and twice.collect()[0]["final_score"] == 0.9167
