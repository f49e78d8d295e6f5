"""Routing, names, sizes and status functions."""

import pytest
from pyspark.sql import functions as F

from scorewright.functions import text as T


def one(spark, expr, value, schema="v string"):
    return spark.createDataFrame([(value,)], schema).select(expr(F.col("v")).alias("o")).collect()[0]["o"]


@pytest.mark.parametrize("name,provider,org", [
    ("gpt-4o", "openai", "openai"), ("o3-mini", "openai", "openai"), ("Claude-3-opus", "anthropic", "anthropic"),
    ("jais-70b", "inception", "inception"), ("Llama-3-70B", "inception", "unknown"), ("nanda-13b", None, "inception"),
    ("gemini-pro", "google", "google"), ("deepseek-v3", "deepseek", "deepseek"), ("mistral-saba", "mistral", "mistral"),
    ("grok-2", "xai", "xai"), ("orca", None, "openai"), ("qwen", None, "unknown"),
])
def test_provider_and_request_org(spark, name, provider, org):
    assert one(spark, T.route_provider, name) == provider
    assert one(spark, T.request_org, name) == org


@pytest.mark.parametrize("name,route", [("gpt-4o", "openai"), ("o1", "openai"), ("claude-3.5-sonnet", "anthropic"),
                                        ("jais-70b", "inception"), ("JAIS-70b", None), ("llama", None)])
def test_route_judge(spark, name, route):
    assert one(spark, T.route_judge, name) == route


def test_names(spark):
    assert one(spark, T.detect_license, "org/m") == "Open"
    assert one(spark, T.detect_license, "gpt-4o") == "Proprietary"
    assert one(spark, lambda c: T.model_path_parts(c)[0], "/models/org/m/") == "org"
    assert one(spark, lambda c: T.model_path_parts(c)[1], "/models/org/m/") == "m"
    assert one(spark, lambda c: T.model_path_parts(c)[0], "single") is None
    assert one(spark, lambda c: T.model_name_fields(c)[0], "org/m/extra") == "org"
    assert one(spark, lambda c: T.model_name_fields(c)[0], "claude-3") == "anthropic"
    assert one(spark, T.safe_name, "org/my model") == "org_my_model"


@pytest.mark.parametrize("p,bits", [("fp32", 32), ("Float16", 16), ("bf16", 16), ("bfloat16", 16), ("int8", 8),
                                    ("fp8", 32), ("4bit", 32), ("8bit", 32), ("UNK", 32)])
def test_precision_bits(spark, p, bits):
    assert one(spark, T.precision_bits, p) == bits


@pytest.mark.parametrize("params,expected", [("7", 7.0), ("0", 0.0), ("0.5", 0.465), ("7B", 0.465), ("", 0.465),
                                             (None, 0.465)])
def test_params_billion(spark, params, expected):
    # 999,605,160 bytes at bfloat16 -> 0.465... billion; digit strings are billions as given
    df = spark.createDataFrame([(params, 999605160, "bfloat16")], "p string, b bigint, pr string")
    got = df.select(T.params_billion(F.col("p"), F.col("b"), F.col("pr")).alias("o")).collect()[0]["o"]
    assert got == expected


def test_strip_unicode_and_status(spark):
    assert one(spark, T.strip, "  text\t\n") == "text"
    assert one(spark, T.status_category, "finished") == "finished"
    assert one(spark, T.status_category, "REJECTED") == "pending"
    assert one(spark, T.status_category, None) == "pending"
    assert one(spark, T.unknown_status, "REJECTED") is True
    assert one(spark, lambda c: T.parse_list(c, lower=True), " GPT-4o, Claude ,") == ["gpt-4o", "claude"]
    assert one(spark, T.hms, 3725.5, "v double") == "01:02:05.50"
    assert one(spark, lambda c: T.default_answer(c, F.lit("Proprietary")), "") == "ERROR"
    assert one(spark, lambda c: T.default_answer(c, F.lit("Open")), "") == "None"
