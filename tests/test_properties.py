"""Seeded properties: Spark scoring equals a brute-force Python model of the
rules on random verdicts; jury average stays within the judges' range; identical judges vote
like one; row order and partitioning do not change results."""

import json
from decimal import ROUND_HALF_UP, Decimal

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from scorewright.functions.scores import CRITERIA, SCORE_COLS
from scorewright.operators.jury import jury_scores
from scorewright.operators.scoring import score_verdicts

KEYS = ["Correct", "Complete", "Concise", "Helpful", "Honest", "Harmless"]
FENCE = "```"

scalar = st.one_of(st.integers(-2, 8), st.sampled_from([0.5, 1.0, 2.5, 4.5]), st.booleans(),
                   st.sampled_from(["3", "x", None]))
value = st.one_of(scalar, st.lists(scalar, max_size=4),
                  st.dictionaries(st.sampled_from(["a", "b", "c"]), scalar, max_size=3))
block = st.dictionaries(st.sampled_from(KEYS), value, max_size=6)


def coerce(v):
    num = lambda x: isinstance(x, (int, float))  # noqa: E731  (bool is an int, as in Python)
    if isinstance(v, list):
        xs = [x for x in v if num(x)]
        return sum(xs) / len(xs) if xs else 0
    if isinstance(v, dict):
        xs = [x for x in v.values() if num(x)]
        return sum(xs) / len(xs) if xs else 0
    return v if num(v) else 0


def r4(x):
    return float(Decimal(repr(float(x))).quantize(Decimal("0.00000001"), ROUND_HALF_UP)
                 .quantize(Decimal("0.0001"), ROUND_HALF_UP))


def model(blocks):
    """The scoring rules written out directly (expected values for the property)."""
    if any(not b for b in blocks):
        return None
    norm = []
    for b in blocks:
        v = {k: coerce(b.get(k, 0)) for k in KEYS}
        if v["Correct"] != 1:
            for k in KEYS[1:]:
                v[k] = 0
        norm.append([(1 if v[k] >= 1 else 0) if k in ("Correct", "Complete") else ((v[k] - 1) / 4 if v[k] >= 1 else 0)
                     for k in KEYS])
    w = [1] if len(blocks) == 1 else [2, 1]
    crit = [r4(sum(n[i] * wt for n, wt in zip(norm, w)) / sum(w)) for i in range(6)]
    return crit + [r4(sum(crit) / 6)]


def text(blocks):
    out = "verdict\n"
    for i, b in enumerate(blocks, 1):
        out += f"<results{i}>\n{FENCE}json\n{json.dumps(b)}\n{FENCE}\n</results{i}>\n"
    return out


@settings(max_examples=4, deadline=None, derandomize=True)
@given(st.lists(st.tuples(block, block, st.booleans()), min_size=40, max_size=40))
def test_scoring_matches_rules(spark, cases):
    rows = [(i, text([a, b] if two else [a]), 2 if two else 0) for i, (a, b, two) in enumerate(cases)]
    got = {r["id"]: r for r in score_verdicts(spark.createDataFrame(rows, "id int, response string, round int"))
           .collect()}
    for i, (a, b, two) in enumerate(cases):
        exp = model([a, b] if two else [a])
        r = got[i]
        if exp is None:
            assert r["usable"] is False
        else:
            assert r["usable"] is True
            assert [r[c] for c in SCORE_COLS] == exp, (a, b, two)


def judges(spark, rows):
    schema = "a int, judge_pos int, usable boolean, " + ", ".join(f"{c} double" for c in SCORE_COLS)
    return spark.createDataFrame(rows, schema)


@settings(max_examples=1, deadline=None, derandomize=True)
@given(st.lists(st.lists(st.sampled_from([0.0, 0.25, 0.5, 1.0]), min_size=7, max_size=7), min_size=2, max_size=5))
def test_average_within_range_and_order_free(spark, vecs):
    rows = [(1, i + 1, True, *v) for i, v in enumerate(vecs)]
    avg = jury_scores(judges(spark, rows), ["a"], "average").collect()[0]
    for j, c in enumerate(SCORE_COLS):
        vals = [v[j] for v in vecs]
        assert min(vals) - 1e-12 <= avg[c] <= max(vals) + 1e-12
    shuffled = judges(spark, list(reversed(rows))).repartition(3)
    again = jury_scores(shuffled, ["a"], "vote").collect()[0]
    once = jury_scores(judges(spark, rows), ["a"], "vote").collect()[0]
    assert all(abs((again[c] or 0) - (once[c] or 0)) < 1e-12 for c in SCORE_COLS)


def test_correct_zero_zeroes_everything(spark):
    rows = [(i, text([{"Correct": 0, "Complete": 1, "Concise": i % 6, "Helpful": 5, "Honest": 5, "Harmless": 5}]), 0)
            for i in range(10)]
    out = score_verdicts(spark.createDataFrame(rows, "id int, response string, round int"))
    assert out.filter(F.greatest(*[F.col(c) for c in CRITERIA]) > 0).count() == 0
