"""Averaging over judged files (FIXTURES 2.4): rosters, complete-case entries, averages,
counts, upsert."""

import json
import os

import pytest
from pyspark.sql import functions as F

from scorewright.operators import results as R
from scorewright.sources.files import read_judged

KEYS = ["Correct", "Complete", "Concise", "Helpful", "Honest", "Harmless", "Final Score"]


def sc(*vals):
    return dict(zip(KEYS, vals))


def entry(model, task, judges, jury=None):
    meta = {"SN.": 1, "Round": 0, "Model Name": model, "License": "Open", "Revision": "main",
            "Precision": "bfloat16", "Params": 0.5}
    if task is not None:
        meta["Task"] = task
    e = {"Meta": meta, "Test": {"Question 1": "q", "Answer 1": "a"}, "Model": {"Answer 1": "m"}}
    for i, (name, s) in enumerate(judges, 1):
        e[f"Judge {i}"] = {"Judge Name": name, "Judge Comments": "text", "3C3H Scores": s}
    if jury is not None:
        e["Jury"] = {"Strategy": "vote", "3C3H Scores": jury}
    return e


@pytest.fixture(scope="module")
def judged_dir(tmp_path_factory):
    d = tmp_path_factory.mktemp("judged")
    one = sc(1, 1, 1, 1, 1, 1, 1.0)
    files = {
        "org_a_main_bfloat16_answers_judged.json": [
            entry("org/a", "t1", [("alice", sc(1, 1, 0.5, 1, 1, 1, 0.9)), ("bob", sc(0, 0, 0, 0, 0, 0, 0))], one),
            entry("org/a", "t1", [("alice", sc(1, 1, "bad", 1, 1, 1, 0.6)), ("bob", one)], one),
            entry("org/a", "t2", [("alice", sc(1, 1, 1, None, 1, 1, 0.5)), ("bob", one)], one),
            entry("org/a", None, [("alice", sc(1, 1, 1, 1, 1, 1, 1.0)), ("bob", one)], one),
        ],
        "org_b_main_bfloat16_answers_judged.json": [
            entry("org/b", "t1", [("carol", one)]),
            entry("org/b", "t1", [("carol", sc(0, 0, 0, 0, 0, 0, 0.0))]),
        ],
        "org_c_main_bfloat16_answers_judged.json": [entry("org/c", "t1", []), entry("org/c", "t2", [])],
        "org_d_main_bfloat16_answers_judged.json": [],
        "org_e_main_bfloat16_answers.json": [entry("org/e", "t1", [])],
    }
    for name, data in files.items():
        with open(os.path.join(d, name), "w", encoding="utf-8") as f:
            json.dump(data, f)
    with open(os.path.join(d, "broken_answers_judged.json"), "w") as f:
        f.write("[{not json")
    return str(d)


@pytest.fixture(scope="module")
def res(spark, judged_dir):
    judged, entries = read_judged(spark, judged_dir)
    return judged, entries, R.model_results(judged, entries, "vote")


def test_roster_intersection_and_jury(res):
    judged, entries, _ = res
    assert R.expected_judges(R.file_summary(R.pack_judged(judged, entries))) == ["Judge 1"]


def test_criterion_averages(res):
    _, _, out = res
    wide = {r["file_id"]: r.asDict() for r in out["wide"].collect()}
    a = wide["org_a_main_bfloat16"]
    assert a["judge_name"] == "alice" and a["correct"] == 1.0
    assert a["concise"] == 0.5            # text value counts as 0 and in the denominator
    assert a["final_score"] == 0.8333     # entry with a null criterion is excluded
    b = wide["org_b_main_bfloat16"]
    assert b["judge_name"] == "carol" and b["final_score"] == 0.5
    c = wide["org_c_main_bfloat16"]
    assert c["judge_name"] == "Judge 1" and c["final_score"] is None
    assert "org_d_main_bfloat16" not in wide and "org_e_main_bfloat16" not in wide


def test_task_averages_skip_missing_task(res):
    _, _, out = res
    tasks = {(r["file_id"], r["task"]): r["score"] for r in out["tasks"].collect()}
    assert tasks == {("org_a_main_bfloat16", "t1"): 0.75, ("org_b_main_bfloat16", "t1"): 0.5}


def test_entry_counts(res):
    _, _, out = res
    counts = {r["file_id"]: (r["total_entries"], r["successful_entries"], r["failed_entries"], r["success_ratio"])
              for r in out["counts"].collect()}
    assert counts["org_a_main_bfloat16"] == (4, 3, 1, 0.75)
    assert counts["org_b_main_bfloat16"] == (2, 2, 0, 1.0)
    assert counts["org_c_main_bfloat16"] == (2, 0, 2, 0.0)
    for r in out["counts"].collect():
        assert r["successful_entries"] + r["failed_entries"] == r["total_entries"]


def test_meta_from_first_entry(res):
    _, _, out = res
    meta = {r["file_id"]: r["model_name"] for r in out["meta"].collect()}
    assert meta["org_a_main_bfloat16"] == "org/a"


def test_no_common_judge_is_an_error(spark, tmp):
    for name, judge in (("x_answers_judged.json", "p"), ("y_answers_judged.json", "q")):
        e = entry("m/" + name, "t", [(judge, sc(1, 1, 1, 1, 1, 1, 1.0))])
        e["Judge 2"] = e.pop("Judge 1") if name.startswith("y") else e["Judge 1"]
        if name.startswith("x"):
            e.pop("Judge 2")
        with open(os.path.join(tmp, name), "w") as f:
            json.dump([e], f)
    judged, entries = read_judged(spark, tmp)
    with pytest.raises(ValueError):
        R.expected_judges(R.file_summary(R.pack_judged(judged, entries)))
    with pytest.raises(Exception, match="no common judges"):
        R.model_results(judged, entries)["wide"].collect()


def test_upsert_last_wins_and_keeps_others(spark):
    old = spark.createDataFrame([("org/a", 0.1, 1), ("org/z", 0.9, 1)], "model_name string, score double, generation int")
    new = spark.createDataFrame([("org/a", 0.5, 1), ("org/a", 0.7, 2), ("org/b", 0.3, 1)],
                                "model_name string, score double, generation int")
    got = {r["model_name"]: r["score"] for r in R.upsert_results(old, new, ["model_name"]).collect()}
    assert got == {"org/a": 0.7, "org/b": 0.3, "org/z": 0.9}
    again = R.upsert_results(R.upsert_results(old, new, ["model_name"]), new, ["model_name"])
    assert {r["model_name"]: r["score"] for r in again.collect()} == got


def test_union_results_heterogeneous(spark):
    a = spark.createDataFrame([("m1", 1.0)], "model_name string, x double")
    b = spark.createDataFrame([("m2", "t")], "model_name string, y string")
    out = R.union_results([a, b])
    assert sorted(out.columns) == ["model_name", "x", "y"] and out.count() == 2


def test_assemble_results_json(spark, res):
    from scorewright.sources.sinks import results_json
    _, _, out = res
    assembled = R.assemble_results(out["wide"], out["tasks"], out["meta"])
    docs = {json.loads(r["value"])["Meta"]["Model Name"]: json.loads(r["value"]) for r in results_json(assembled).collect()}
    a = docs["org/a"]
    assert a["alice Scores"]["3C3H Scores"]["3C3H Score"] == 0.8333
    assert a["alice Scores"]["Tasks Scores"] == {"t1": 0.75}
    assert a["Meta"]["Success Ratio"] == 0.75


def test_landed_judged_gives_same_results(spark, judged_dir, res, tmp):
    from scorewright.sources.files import land_judged
    judged, entries = land_judged(spark, judged_dir, f"{tmp}/landed")
    again = R.model_results(judged, entries, "vote")
    key = lambda d: sorted((r["file_id"], r["judge_key"], r["final_score"]) for r in d["wide"].collect())
    assert key(again) == key(res[2])


def test_packed_verdicts_equal_numbered_judges_and_jury(spark):
    """The array form of H2 and E3-E5 gives what the row operators give, unusable verdicts and empty juries included."""
    from scorewright.functions.scores import SCORE_COLS
    from scorewright.operators import jury as J
    from scorewright.operators.scoring import number_judges
    rows = []
    for e in range(40):
        for j in (1, 2, 3):
            usable = (e * j) % 4 != 1 and e != 7
            base = float((e + j) % 3 != 0)
            rows.append((f"f{e % 3}", e, j, f"judge-{j}", usable, *([base] + [base * ((e * k + j) % 5) / 4 for k in range(1, 6)] + [base / j] if usable else [None] * 7)))
    scored = spark.createDataFrame(rows, "file_id string, ordinal bigint, judge_pos int, judge_name string, usable boolean, " + ", ".join(f"{c} double" for c in SCORE_COLS))
    entries = spark.createDataFrame([(f"f{e % 3}", e, "t") for e in range(41)], "file_id string, ordinal bigint, task string")
    keys = ["file_id", "ordinal"]
    for strategy in ("average", "vote"):
        want = number_judges(scored, keys).select(*keys, "judge_key", "judge_name", *SCORE_COLS).unionByName(
            J.jury_rows(scored, keys, strategy, 3).select(*keys, "judge_key", "judge_name", *SCORE_COLS))
        got = R.pack_verdicts(scored, entries, strategy, 3).select(*keys, F.inline("judges")).drop("ok")
        norm = lambda d: sorted([tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in d.collect() if r[1] != 40], key=repr)
        assert norm(got) == norm(want)
    one = R.pack_verdicts(scored.filter("judge_pos = 1"), entries, "SingleJudge", 1)
    assert one.select(F.inline("judges")).filter("judge_key = 'Jury'").count() == 0
    with pytest.raises(ValueError):
        R.pack_verdicts(scored, entries, "Vote?", 3)


def test_averaging_has_one_exchange_of_score_rows(spark):
    """Between the scores and the aggregate there is one shuffle: the grouping by entry."""
    from scorewright.functions.scores import SCORE_COLS
    scored = spark.range(5).selectExpr("'f' file_id", "id ordinal", "1 judge_pos", "'a' judge_name", "true usable", *[f"1D {c}" for c in SCORE_COLS])
    packed = R.pack_verdicts(scored, scored.selectExpr("file_id", "ordinal", "'t' task"), "vote", 3)
    plan = packed._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(file_id") == 1 and "Window" not in plan and "Join" not in plan
    assert R.packed_results(packed)["counts"].collect()[0]["total_entries"] == 5
    flat = R.flag_valid(packed, F.array(F.lit("Judge 1")))._jdf.queryExecution().executedPlan().toString()
    assert flat.count("Exchange") == plan.count("Exchange")
