"""End to end with stub model and judge functions: task file -> answers -> verdicts ->
scores -> jury -> results."""

import json

from pyspark.sql import functions as F

from scorewright.operators.flows import average_results, generate_answers, judge_answers, run_outcomes
from scorewright.sources.files import read_items

FENCE = "```"


def task_file(path):
    items = []
    for sn, rnd in enumerate([0, 0, 1, 1, 2, 2, 0], start=1):
        test = {"Question 1": f"q{sn}", "Answer 1": f"gold{sn}" if sn != 4 else " "}
        if rnd:
            test.update({"Question 2": f"follow{sn}", "Answer 2": f"gold2-{sn}"})
        items.append({"Meta": {"SN.": sn, "Round": rnd, "Task": "history" if sn % 2 else "culture",
                               "Language": "English"}, "Test": test})
    with open(path, "w") as f:
        json.dump(items, f)


def model_fn(messages):
    last = messages[-1]["content"]
    return "" if last == "q7" else f"reply to {last}"       # q7: empty answer -> 'None'


def judge_fn(name, system, prompt):
    correct = 0 if "reply to q1" in prompt and name == "jais-70b" else 1
    block = json.dumps({"Correct": correct, "Complete": 1, "Concise": 5, "Helpful": 5, "Honest": 5, "Harmless": 5})
    out = f"fine\n<results1>\n{FENCE}json\n{block}\n{FENCE}\n</results1>"
    if "results2" in system:
        out += f"\n<results2>\n{FENCE}json\n{block}\n{FENCE}\n</results2>"
    return out


def test_end_to_end(spark, tmp):
    task_file(f"{tmp}/set-a.json")
    items = read_items(spark, tmp)
    requests = spark.createDataFrame(
        [("set-a", "org/alpha", "Open", "main", "bfloat16", "7", "PENDING"),
         ("set-a", "gpt-4o", "Proprietary", "main", "UNK", "UNK", "RUNNING"),
         ("set-a", "done/model", "Open", "main", "bfloat16", "7", "FINISHED")],
        "task_set string, model_name string, license string, revision string, precision string, params string, "
        "status string")
    answers = generate_answers(items, requests, model_fn, {"default": "SYS"})
    rows = {(r["model_name"], r["sn"]): r for r in answers.collect()}
    assert len(rows) == 14                                   # 2 pending models x 7 items; FINISHED skipped
    assert rows[("org/alpha", 1)]["m1"] == "reply to q1"
    assert rows[("org/alpha", 3)]["m1"] == "reply to follow3"  # round 1 stores the follow-up answer
    assert rows[("org/alpha", 5)]["m1"] == "reply to q5" and rows[("org/alpha", 5)]["m2"] == "reply to follow5"
    assert rows[("org/alpha", 7)]["m1"] == "None" and rows[("gpt-4o", 7)]["m1"] == "ERROR"
    assert rows[("gpt-4o", 1)]["revision"] == "UNK"
    suffixes = {0: " r0", 1: " r1", 2: " results2"}
    scored, judged = judge_answers(answers, ["gpt-4o", "jais-70b", "mystery"], judge_fn, "vote", "BASE", suffixes)
    # the unknown judge is skipped; item 4 (round 1, blank gold first answer) is not judged (C4)
    assert scored.filter("usable").count() == 2 * 12
    res = average_results(judged, answers, "vote")
    wide = {(r["file_id"], r["judge_key"]): r["final_score"] for r in res["wide"].collect()}
    assert set(k for _, k in wide) == {"Judge 1", "Judge 2", "Jury"}
    # jais marks q1 wrong for both models: vote 1-1 is a tie -> jury zero on that entry
    alpha = res["criteria"].filter((F.col("file_id").startswith("set-a/org/alpha|")) & (F.col("judge_key") == "Jury")
                                   & (F.col("criterion") == "3C3H Score")).collect()[0]["score"]
    assert alpha == round(5 / 6, 4)
    counts = {r["file_id"]: (r["total_entries"], r["successful_entries"]) for r in res["counts"].collect()}
    assert counts == {"set-a/org/alpha|main|bfloat16": (7, 6), "set-a/gpt-4o|main|UNK": (7, 6)}

    out = {r["model_name"]: (r["ok"], r["judged"], r["n_errors"]) for r in run_outcomes(answers, scored).collect()}
    assert out == {"org/alpha": (True, True, 0), "gpt-4o": (True, True, 1)}


def test_provider_forms_modality_and_params_in_generation(spark, tmp):
    """D3, D10, D12, D13, D29 in the flow: what each kind of model is sent, and the params stamped from folder sizes."""
    with open(f"{tmp}/set-a.json", "w") as f:
        json.dump([{"Meta": {"SN.": 1, "Round": 0, "Task": "t"}, "Test": {"Question 1": "q1", "Answer 1": "g"}}], f)
    rows = [("org/plain", "Open", None, False), ("org/chat", "Open", "Text", True), ("org/eyes", "Open", "Text+Vision", True), ("o1-mini", "Proprietary", None, None),
            ("gpt-4o", "Proprietary", None, None), ("claude-3", "Proprietary", None, None), ("grok-o3", "Proprietary", None, None)]
    requests = spark.createDataFrame([("set-a", m, lic, "main", "bfloat16", "7B", "PENDING", mod, chat) for m, lic, mod, chat in rows],
                                     "task_set string, model_name string, license string, revision string, precision string, params string, status string, modality string, chat_template boolean")
    folders = spark.createDataFrame([("org/plain", 2 * 1024**3), ("gpt-4o", 5)], "model_name string, total_bytes long")

    def said(messages, request):
        return json.dumps([[m["role"] for m in messages], messages[-1]["content"], request["provider"], request["system"]])
    answers = generate_answers(read_items(spark, tmp), requests, said, {"default": "SYS"}, folders=folders, with_request=True)
    got = {r["model_name"]: (json.loads(r["m1"]), r["params"]) for r in answers.collect()}
    assert got["org/plain"] == ([["system", "user"], "q1", "open", None], "1.0")
    assert got["org/chat"] == ([["user"], "q1", "open", None], "7B")
    assert got["org/eyes"][0] == [["system", "user"], [{"type": "text", "text": "q1"}], "open", None]
    assert got["o1-mini"][0] == [["user"], "q1", "openai", None] and got["gpt-4o"] == ([["system", "user"], "q1", "openai", None], "UNK")
    assert got["claude-3"][0] == [["user"], "q1", "anthropic", "SYS"] and got["grok-o3"][0][:3] == [["system", "user"], "q1", "openai"]


def test_disk_to_results_and_again(spark, tmp):
    """Answer files -> read -> judged -> averaged -> upserted; a second task set's run leaves the first one's results."""
    from pyspark.sql import Observation

    from scorewright.operators.flows import rejected_answers
    from scorewright.sources.files import read_answers
    import os
    for task_set in ("set-a", "set-b"):
        os.makedirs(f"{tmp}/in/{task_set}")
        entry = lambda sn, m: {"Meta": {"SN.": sn, "Round": 0, "Task": "t", "Model Name": "org/m", "License": "Open", "Revision": "main", "Precision": "bf16", "Params": 7},
                               "Test": {"Question 1": f"q{sn}", "Answer 1": "gold"}, "Model": {"Answer 1": m}}
        with open(f"{tmp}/in/{task_set}/org_m_main_bf16_answers.json", "w") as f:
            json.dump([entry(1, "fine"), entry(2, "fine too"), entry(3, " ")], f)
        answers = read_answers(spark, f"{tmp}/in/{task_set}")
        tally = Observation("answers")
        scored, judged = judge_answers(answers, ["gpt-4o"], judge_fn, "Vote", "BASE", {0: "", 1: "", 2: ""}, tally=tally)
        assert scored.count() == 2 and tally.get == {"read": 3, "kept": 2, "rejected": 1}
        assert [r["reject_reason"] for r in rejected_answers(answers).collect()] == ["missing_m1"]
        average_results(judged, answers, "SingleJudge", results_path=f"{tmp}/results")
    meta = {r["file_id"]: (r["total_entries"], r["successful_entries"], r["strategy"]) for r in spark.read.parquet(f"{tmp}/results/meta").collect()}
    assert meta == {f"{s}/org/m|main|bf16": (3, 2, "SingleJudge") for s in ("set-a", "set-b")}
    assert spark.read.parquet(f"{tmp}/results/criteria").count() == 14
