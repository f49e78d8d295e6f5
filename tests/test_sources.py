"""Readers A1, A2, A4, A5 and writers on hand-made documents (FIXTURES 1)."""

import json
import os

from pyspark.sql import functions as F

from scorewright.sources import files as S
from scorewright.sources import sinks as W


def dump(path, data, raw=False):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(data if raw else json.dumps(data, ensure_ascii=False))


ITEM = {"Meta": {"SN.": 7, "Round": 1, "Task": "History", "Dataset": None, "Category": "Culture",
                 "Sub-Category": "Places", "Source": "book", "Fact Checking": None, "Comment": None},
        "Test": {"Question 1": "  سؤال؟ ", "Answer 1": "جواب", "Question 2": "q2", "Answer 2": None}}


def test_read_items(spark, tmp):
    no_round = json.loads(json.dumps(ITEM))
    del no_round["Meta"]["Round"]
    null_round = json.loads(json.dumps(ITEM))
    null_round["Meta"]["Round"] = None
    dump(f"{tmp}/tasks/set-a.json", [ITEM, no_round, null_round])
    items = S.read_items(spark, f"{tmp}/tasks").orderBy("ordinal").collect()
    assert [r["round"] for r in items] == [1, 0, None]
    r = items[0]
    assert (r["task_set"], r["sn"], r["ordinal"], r["sub_category"], r["q1"], r["a2"]) == \
        ("set-a", 7, 0, "Places", "  سؤال؟ ", None)


def test_read_answers_skips_judged_and_bad_files(spark, tmp):
    ans = dict(ITEM, Model={"Answer 1": "m1"})
    ans["Meta"] = dict(ITEM["Meta"], **{"Model Name": "org/m", "License": "Open", "Revision": "main",
                                        "Precision": "bfloat16", "Params": 0.494})
    prop = json.loads(json.dumps(ans))
    prop["Meta"]["Params"] = "UNK"
    dump(f"{tmp}/a/org_m_main_bfloat16_answers.json", [ans, prop])
    dump(f"{tmp}/a/org_m_main_bfloat16_answers_judged.json", [ans])
    dump(f"{tmp}/a/bad_answers.json", "[{oops", raw=True)
    df = S.read_answers(spark, f"{tmp}/a")
    got = sorted((r["model_key"], r["params_raw"], r["params_b"], r["m1"]) for r in df.collect())
    assert got == [("org_m_main_bfloat16", "0.494", 0.494, "m1"), ("org_m_main_bfloat16", "UNK", None, "m1")]
    bad = S.bad_files(S.read_documents(spark, f"{tmp}/a", "*_answers.json")).collect()
    assert len(bad) == 1 and bad[0]["src_file"].endswith("bad_answers.json")
    assert {r["task_set"] for r in df.collect()} == {"a"}


CASES = {
    "plain.json": ('[{"a": 1}, {"a": {"b": [1, {"c": 2}]}}]', 2), "empty.json": ("[]", 0), "blank.json": (" [\n ] \n", 0),
    "mixed.json": ('[1, "x,]}{[", null, [2, 3], {}, "\\"}\\\\", {"k}": "}{\\\\"}]', 7), "object.json": ('{"a": [1]}', None),
    "scalar.json": ("3", None), "cut.json": ('[{"a": 1}, {"a": "x}', None), "tail.json": ('[{"a": 1}] {"b": 2}', None), "tail2.json": ('[{"a": 1}] x', None),
    "comma.json": ('[{"a": 1}, ]', None), "commas.json": ('[1,,2]', None), "bad.json": ('[{"a": 1}, {oops}]', None), "open.json": ('[{"a": 1}', None), "brace.json": ('[1 }, 2]', None),
    "nested.json": (json.dumps([[{"x": "]"}], []], indent=1), 2), "arabic.json": (json.dumps([{"q": "سؤال } { [ ] , \" \\ نعم"}] * 3, ensure_ascii=False, indent=4), 3),
}


def test_array_entries_equal_whole_parsing(spark, tmp):
    """The cut gives what a JSON parser gives of the whole file; faulty files are rejected with a reason."""
    from pyspark.sql import Observation

    from scorewright.sources.json_arrays import read_array_entries
    for name, (text, _) in CASES.items():
        dump(f"{tmp}/d e+f/{name}", text, raw=True)
    tally = Observation("files")
    entries, rejects = read_array_entries(spark, f"{tmp}/d e+f", "*.json", tally=tally)
    got = {}
    for r in entries.select("src_name", "ordinal", F.to_json("e").alias("j")).orderBy("ordinal").collect():
        got.setdefault(r.src_name, []).append((r.ordinal, json.loads(r.j)))
    assert {r.src_file.rsplit("/", 1)[-1] for r in rejects.collect()} == {n for n, (_, k) in CASES.items() if k is None}
    for name, (text, n) in CASES.items():
        if n:
            assert got[name] == list(enumerate(json.loads(text))) and len(got[name]) == n
        else:
            assert name not in got
    assert tally.get["read"] == len(CASES) == tally.get["kept"] + tally.get["rejected"]


def test_array_file_of_many_splits_is_read_in_order(spark, tmp):
    """One file over many splits and Arrow batches: entries stream, positions are exact."""
    from scorewright.sources.json_arrays import Cutter, read_array_entries
    rows = [{"i": i, "text": "}{ ]" * (i % 7) + "é" * (i % 300)} for i in range(6000)]
    text = json.dumps(rows, ensure_ascii=False)
    dump(f"{tmp}/big/one.json", text, raw=True)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "100k")
        assert spark.read.text(f"{tmp}/big").rdd.getNumPartitions() > 5
        entries, rejects = read_array_entries(spark, f"{tmp}/big")
        got = entries.select("ordinal", F.to_json("e").alias("j")).orderBy("ordinal").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert [(r.ordinal, json.loads(r.j)) for r in got] == list(enumerate(rows)) and rejects.count() == 0
    cutter, most, n = Cutter(), 0, 0
    for at in range(0, len(text), 50):                        # what is held never exceeds one entry
        n += len(list(cutter.feed(text[at:at + 50])))
        most = max(most, sum(map(len, cutter.parts)))
    assert n == 6000 and cutter.close() is None and most < 400


def test_same_file_name_in_two_task_sets(spark, tmp):
    from scorewright.operators import results as R
    judged = dict(ITEM, **{"Judge 1": {"Judge Name": "a", "3C3H Scores": dict.fromkeys(["Correct", "Complete", "Concise", "Helpful", "Honest", "Harmless", "Final Score"], 1.0)}})
    for task_set in ("set-a", "set-b"):
        dump(f"{tmp}/x y/{task_set}/org_m_main_answers.json", [dict(ITEM, Model={"Answer 1": task_set})])
        dump(f"{tmp}/x y/{task_set}/org_m_main_answers_judged.json", [judged])
    answers = S.read_answers(spark, f"{tmp}/x y")
    assert {(r.task_set, r.model_key, r.m1) for r in answers.collect()} == {(t, "org_m_main", t) for t in ("set-a", "set-b")}
    out = R.model_results(*S.read_judged(spark, f"{tmp}/x y"))
    assert {(r.file_id, r.successful_entries) for r in out["counts"].collect()} == {("set-a/org_m_main", 1), ("set-b/org_m_main", 1)}


def test_read_requests(spark, tmp):
    from pyspark.sql import Observation
    base = f"{tmp}/all requests"
    man = {"model_name": "org/m", "license": "Open", "revision": "main", "precision": "bfloat16",
           "params": "7", "status": "PENDING"}
    dump(f"{base}/set-a/OpenRequests/org/m_eval_request_main_bfloat16.json", man)
    dump(f"{base}/set-a/ProprietaryRequests/openai/gpt_eval_request_main_UNK.json",
         dict(man, model_name="gpt-4o", status="RUNNING", modality="Text"))
    dump(f"{base}/set-a/OpenRequests/org/broken.json", "not json", raw=True)
    dump(f"{base}/shallow.json", man)
    df = S.read_requests(spark, base)
    got = sorted((r["task_set"], r["bucket"], r["org"], r["model_name"], r["status"], r["modality"]) for r in df.collect())
    assert got == [("set-a", "OpenRequests", "org", "org/m", "PENDING", None),
                   ("set-a", "ProprietaryRequests", "openai", "gpt-4o", "RUNNING", "Text")]
    tally = Observation("requests")
    assert S.read_requests(spark, base, tally).count() == 2 and tally.get == {"read": 4, "kept": 2, "rejected": 2}
    why = {r["src_file"].rsplit("/", 1)[-1]: r["reason"] for r in S.rejected_requests(spark, base).collect()}
    assert why == {"broken.json": "not JSON", "shallow.json": "not at <task set>/<bucket>/<org>/<file>"}


def test_read_results(spark, tmp):
    res = {"alice Scores": {"3C3H Scores": {"Correctness": 1.0, "3C3H Score": 0.9}, "Tasks Scores": {"t1": 0.9}},
           "Meta": {"Model Name": "org/m", "Total Entries": 5, "Successful Entries": 5, "Failed Entries": 0,
                    "Success Ratio": 1.0}}
    dump(f"{tmp}/r/results__strategy_vote.json", [res, dict(res, Meta=dict(res["Meta"], **{"Model Name": "org/n"}))])
    dump(f"{tmp}/r/single.json", res)
    dump(f"{tmp}/r/results.json", [res])
    dump(f"{tmp}/r/scalar.json", 3)
    dump(f"{tmp}/r/bad.json", "{", raw=True)
    dump(f"{tmp}/r/deep/er/nested.json", dict(res, Meta={"Model Name": "org/deep"}))
    df = S.read_results(spark, f"{tmp}/r")
    assert sorted(r["model_name"] for r in df.collect()) == ["org/deep", "org/m", "org/m", "org/n"]
    assert {r["src_file"].rsplit("/", 1)[-1]: r["reason"] for r in S.rejected_results(spark, f"{tmp}/r").collect()} == {
        "results.json": "an earlier aggregate", "scalar.json": "neither list nor object", "bad.json": "not JSON"}
    crit = S.result_criteria(df).filter(F.col("criterion") == "3C3H Score").collect()
    assert {r["score"] for r in crit} == {0.9}
    assert {r["task"] for r in S.result_tasks(df).collect()} == {"t1"}


def test_writers(spark, tmp):
    df = spark.createDataFrame([("o", "o/m", "main", "bf16", 1), ("o", "o/n", "main", "bf16", 2)],
                               "org string, model_name string, revision string, precision string, x int")
    W.write_answers(df, f"{tmp}/answers")
    assert spark.read.parquet(f"{tmp}/answers").count() == 2
    p1 = W.write_request_status(df, f"{tmp}/status", "v1")
    p2 = W.write_request_status(df.limit(1), f"{tmp}/status", "v2")
    assert p1 != p2 and spark.read.parquet(p2).count() == 1
    W.write_outcomes(df.select("model_name", (F.col("x") == 1).alias("ok")), f"{tmp}/outcomes")
    assert spark.read.parquet(f"{tmp}/outcomes").filter(F.col("ok").cast("string") == "true").count() == 1
    out = W.export_leaderboard(df, f"{tmp}/lb")
    assert "exported_at" in out.columns and spark.read.json(f"{tmp}/lb").count() == 2


def test_list_files_and_folder_bytes(spark, tmp):
    from scorewright.operators.requests import folder_bytes
    for name, n in (("m1/a.bin", 10), ("m1/b.bin", 5), ("m2/c.bin", 7)):
        dump(f"{tmp}/models/{name}", "x" * n, raw=True)
    listing = S.list_files(spark, f"{tmp}/models")
    got = {r["folder"].rsplit("/", 1)[-1]: (r["n_files"], r["total_bytes"])
           for r in folder_bytes(listing, "folder", "size").collect()}
    assert got == {"m1": (2, 15), "m2": (1, 7)}


def test_write_judged_and_results(spark, tmp):
    df = spark.createDataFrame([("set", "m", 1, 0.5)], "task_set string, model_key string, ordinal int, score double")
    W.write_judged(df, f"{tmp}/judged")
    W.write_judged(df.withColumn("ordinal", F.lit(2).cast("bigint")), f"{tmp}/judged")
    W.write_judged(df, f"{tmp}/judged")                      # the first batch once more: its row is replaced
    assert sorted(r["ordinal"] for r in spark.read.parquet(f"{tmp}/judged").collect()) == [1, 2]
    W.write_results(df.drop("task_set"), f"{tmp}/results", "vote")
    W.write_results(df.drop("task_set"), f"{tmp}/results", "average")
    W.write_results(df.drop("task_set"), f"{tmp}/results", "vote")
    r = spark.read.parquet(f"{tmp}/results")
    assert sorted(x["strategy"] for x in r.collect()) == ["average", "vote"]


def test_answers_and_judged_json_shapes(spark):
    answers = spark.createDataFrame(
        [("set", 1, 0, "history", "q", "a", "m", "org/m", "Open")],
        "task_set string, sn bigint, round int, task string, q1 string, a1 string, m1 string, model_name string, "
        "license string")
    doc = json.loads(W.answers_json(answers).collect()[0]["value"])
    assert doc["Meta"]["SN."] == 1 and doc["Test"]["Question 1"] == "q" and doc["Model"]["Answer 1"] == "m"
    judged = spark.createDataFrame(
        [("set", 1, "Judge 1", "gpt-4o", "text", 1.0, 1.0, 1.0, 1.0, 1.0, 1.0, 1.0),
         ("set", 1, "Jury", "Jury", None, 1.0, 1.0, 1.0, 1.0, 1.0, 1.0, 1.0)],
        "task_set string, sn bigint, judge_key string, judge_name string, response string, correct double, "
        "complete double, concise double, helpful double, honest double, harmless double, final_score double")
    doc = json.loads(W.judged_json(answers, judged, ["task_set", "sn"], "vote").collect()[0]["value"])
    assert doc["Judge 1"]["Judge Name"] == "gpt-4o" and doc["Judge 1"]["3C3H Scores"]["Final Score"] == 1.0
    assert doc["Jury"]["Strategy"] == "vote" and doc["Meta"]["Task"] == "history"


def test_upsert_loses_and_doubles_nothing(spark, tmp):
    """Two task sets, two models, a re-run and a partial re-run; folder names that look like numbers or NULL."""
    schema = "task_set string, model_name string, revision string, ordinal bigint, m1 string"
    mk = lambda rows: spark.createDataFrame(rows, schema)
    first = [(t, m, "007", i, f"{t}{m}{i}") for t in ("t1", "t2") for m in ("org/a", "org/b") for i in range(3)] + [("t1", None, None, 0, "x")]
    for part in ([r for r in first if r[0] == "t1"], [r for r in first if r[0] == "t2"], first):
        W.write_answers(mk(part), f"{tmp}/answers")
    again = [("t1", "org/a", "007", 1, "better"), ("t1", None, None, 0, "y"), ("t3", "org/c", "1", 0, "new")]
    W.write_answers(mk(again), f"{tmp}/answers")
    W.write_answers(mk(again), f"{tmp}/answers")
    table = W.read_table(spark, f"{tmp}/answers", mk(first).schema, ["task_set", "model_name", "revision"])
    want = {r[:4]: r[4] for r in first} | {r[:4]: r[4] for r in again}
    assert sorted((tuple(r) for r in table.select("task_set", "model_name", "revision", "ordinal", "m1").collect()), key=repr) == sorted((k + (v,) for k, v in want.items()), key=repr)


def test_upsert_by_order_takes_the_latest_whatever_comes_first(spark, tmp):
    schema = "part string, key int, ts int, v string"
    rows = [("p", 1, 5, "new"), ("p", 1, 3, "old"), ("q", 2, 1, "a"), ("p", 3, 1, "tie-a"), ("p", 3, 1, "tie-b")]
    for name, order in (("up", rows), ("down", rows[::-1])):
        for r in order:
            W.upsert_partitions(spark.createDataFrame([r], schema), f"{tmp}/{name}", ["key"], ["part"], ["ts"])
        got = sorted(tuple(r) for r in spark.read.parquet(f"{tmp}/{name}").select("key", "ts", "v").collect())
        assert got == [(1, 5, "new"), (2, 1, "a"), (3, 1, "tie-b")]


def test_results_of_a_model_are_replaced_whole(spark, tmp):
    mk = lambda rows: spark.createDataFrame(rows, "model_name string, judge string, score double")
    W.write_results(mk([("a", "j1", 0.1), ("a", "j2", 0.2), ("b", "j1", 0.3)]), f"{tmp}/res", "vote")
    W.write_results(mk([("a", "j1", 0.9)]), f"{tmp}/res", "vote")
    W.write_results(mk([("a", "j1", 0.5)]), f"{tmp}/res", "average")
    got = sorted((r.strategy, r.model_name, r.judge, r.score) for r in spark.read.parquet(f"{tmp}/res").collect())
    assert got == [("average", "a", "j1", 0.5), ("vote", "a", "j1", 0.9), ("vote", "b", "j1", 0.3)]
