"""Caller-supplied model and judge functions (U1-U4) with deterministic stubs."""

from pyspark.sql import functions as F

from scorewright.operators.inference import ERROR, RetryPolicy, complete, judge, rate_limit_policy
from scorewright.operators.items import build_messages, flatten_messages

NO_SLEEP = RetryPolicy(attempts=3, wait=5.0, sleep=lambda s: None)


def items(spark):
    df = spark.createDataFrame([(1, 0, "what is 2+2", None, None), (2, 0, "boom", None, None),
                                (3, 1, "q1", "a1", "q2")],
                               "id int, round int, q1 string, a1 string, q2 string")
    msgs = build_messages(F.col("round"), F.col("q1"), F.col("a1"), F.col("q2"), F.lit("prior"), F.lit("SYS"), F.lit(1))
    return df.withColumn("messages", msgs).withColumn("flat", flatten_messages(F.col("messages")))


def echo(messages):
    last = messages[-1]["content"]
    if "boom" in last:
        raise RuntimeError("provider failure")
    return f"  answer to {last} ({len(messages)})  "


def test_complete_errors_become_ERROR(spark):
    out = {r["id"]: r["completion"] for r in complete(items(spark), echo, concurrency=2).collect()}
    assert out == {1: "answer to what is 2+2 (2)", 2: ERROR, 3: "answer to q2 (4)"}


def test_complete_fallback_to_flattened_text(spark):
    def template_fails(messages):
        if len(messages) > 1:
            raise ValueError("template")
        return "flat:" + messages[0]["content"][:3]
    out = {r["id"]: r["completion"] for r in complete(items(spark), template_fails, fallback_col="flat").collect()}
    assert out[1] == "flat:SYS" and out[3] == "flat:SYS"


def test_judge_retries_and_records_attempts(spark):
    df = spark.createDataFrame([(1, "gpt-4o", "S", "flaky"), (2, "gpt-4o", "S", "dead"), (3, "k2-65b", "S", "ok")],
                               "id int, judge_name string, system_text string, prompt string")
    calls = {}

    def fn(name, system, prompt):
        calls[prompt] = calls.get(prompt, 0) + 1
        if prompt == "dead" or (prompt == "flaky" and calls[prompt] < 3):
            raise ConnectionError(f"try {calls[prompt]}")
        return f"<results1>{name}</results1>"
    out = {r["id"]: (r["response"], r["attempts"], r["error"]) for r in judge(df, fn, policy=NO_SLEEP).collect()}
    assert out[1] == ("<results1>gpt-4o</results1>", 3, None)
    assert out[2][1] == 3 and out[2][0] == "ConnectionError: try 3" and out[2][2] == out[2][0]
    assert out[3] == ("<results1>k2-65b</results1>", 1, None)


def test_rate_limit_policy():
    waits = []
    pol = rate_limit_policy(sleep=waits.append)
    state = {"n": 0}

    def call():
        state["n"] += 1
        if state["n"] == 1:
            raise RuntimeError("429 Too many requests")
        return "ok"
    assert pol.run(call) == ("ok", 2, None) and waits == [60.0]
    text, n, err = pol.run(lambda: (_ for _ in ()).throw(RuntimeError("500")))
    assert text is None and n == 1 and "500" in err


def test_inference_plan_uses_arrow_batches(spark):
    plan = complete(items(spark), echo)._jdf.queryExecution().executedPlan().toString()
    assert "MapInPandas" in plan or "PythonMapInArrow" in plan


def test_batches_and_calls_in_flight(spark):
    """Batches hold at most batch_size inputs of one provider, at most in_flight calls are open, a bad input costs no other."""
    import threading
    import time

    from scorewright.operators.inference import call_all
    lock, state = threading.Lock(), {"open": 0, "most": 0, "sizes": []}

    def fn(inputs):
        with lock:
            state["open"] += 1
            state["most"] = max(state["most"], state["open"])
            state["sizes"].append((len(inputs), len({i[1] for i in inputs})))
        time.sleep(0.01)
        with lock:
            state["open"] -= 1
        if any(i[0] == 13 for i in inputs):
            raise RuntimeError("bad input")
        return [f"{i[0]}!" for i in inputs]

    inputs = [(i, "ab"[i % 2]) for i in range(40)]
    got = call_all(inputs, [p for _, p in inputs], fn, RetryPolicy(attempts=1), batch_size=8, in_flight=3)
    assert [t for t, _, _ in got] == [None if i == 13 else f"{i}!" for i in range(40)]
    assert state["most"] == 3 and max(n for n, _ in state["sizes"]) == 8 and {k for _, k in state["sizes"]} == {1}
    assert len([n for n, _ in state["sizes"] if n > 1]) == 6          # 20 inputs of each provider in batches of 8
    short = call_all([(1,), (2,)], ["p", "p"], lambda xs: ["only one"] if len(xs) > 1 else ["x"], RetryPolicy(attempts=1), batch_size=2)
    assert [t for t, _, _ in short] == ["x", "x"]
    plain = call_all([(i,) for i in range(9)], ["p"] * 9, lambda i: str(i), RetryPolicy(attempts=1), in_flight=4)
    assert [t for t, _, _ in plain] == [str(i) for i in range(9)]


def test_rate_budget_is_shared_by_partitions():
    from scorewright.operators.inference import RateBudget
    now, slept = [100.0], []

    def sleep(s):
        slept.append(round(s, 6))
        now[0] += s
    gate = RateBudget({"slow": 2.0}, 4, clock=lambda: now[0], sleep=sleep).gate()
    for _ in range(3):
        gate("slow")
    gate("other")
    assert slept == [2.0, 2.0]                # 2 calls a second over 4 partitions: one every 2 seconds in each


def test_complete_and_judge_in_batches(spark):
    def batch(inputs):
        return [f"{m[-1]['content']}|{r['id']}" for m, r in inputs]
    out = {r["id"]: r["completion"] for r in complete(items(spark), batch, batch_size=2, request_cols=("id",), concurrency=1).collect()}
    assert out == {1: "what is 2+2|1", 2: "boom|2", 3: "q2|3"}
    typed = items(spark).withColumn("vision", F.col("id") == 1)
    out = {r["id"]: r["completion"] for r in complete(typed, lambda m: str(m[-1]["content"]), vision_col="vision").collect()}
    assert out[1] == "[{'type': 'text', 'text': 'what is 2+2'}]" and out[3] == "q2"
    df = spark.createDataFrame([(i, f"judge{i % 2}", "S", f"p{i}") for i in range(7)], "id int, judge_name string, system_text string, prompt string")
    got = {r["id"]: r["response"] for r in judge(df, lambda xs: ["/".join(x) for x in xs], batch_size=3, in_flight=2, policy=NO_SLEEP,
                                                 rates={"judge0": 1e6}, concurrency=2).collect()}
    assert got == {i: f"judge{i % 2}/S/p{i}" for i in range(7)}


def test_failed_calls_stay_open_and_the_latest_success_wins(spark, tmp):
    from scorewright.operators.inference import judge_once, latest_verdicts, read_log
    calls = spark.createDataFrame([(1, "a", "S", "p1"), (2, "a", "S", "p2"), (2, "a", "S", "p2-again"), (None, "a", "S", "p0")], "id int, judge_name string, system_text string, prompt string")
    keys, made = ["id", "judge_name"], f"{tmp}/made"

    def outcome(run):
        def fn(name, system, prompt):
            if prompt == "p2" and run == 1:
                raise ConnectionError("503")
            return f"{prompt} in run {run}"
        return lambda todo: judge(todo, fn, policy=RetryPolicy(attempts=2, sleep=lambda s: None))
    first = {r["id"]: (r["response"], r["error"], r["attempts"]) for r in judge_once(calls, outcome(1), made, keys).collect()}
    assert first == {1: ("p1 in run 1", None, 1), 2: ("ConnectionError: 503", "ConnectionError: 503", 2), None: ("p0 in run 1", None, 1)}
    second = {r["id"]: (r["response"], r["error"]) for r in judge_once(calls, outcome(2), made, keys).collect()}
    assert second == {1: ("p1 in run 1", None), 2: ("p2 in run 2", None), None: ("p0 in run 1", None)}
    third = judge_once(calls, outcome(3), made, keys)
    assert {r["id"]: r["response"] for r in third.collect()} == {k: v[0] for k, v in second.items()}
    log = read_log(spark, made)
    assert log.count() == 4 and log.filter("error IS NOT NULL").count() == 1
    twice = log.unionByName(log.filter("id = 1").withColumn("response", F.lit("older")).withColumn("judged_at", F.lit("2000-01-01").cast("timestamp")))
    twice = twice.unionByName(log.filter("id = 2").withColumn("error", F.lit("later 500")).withColumn("judged_at", F.lit("2100-01-01").cast("timestamp")))
    assert {r["id"]: r["response"] for r in latest_verdicts(twice, keys).collect()} == {k: v[0] for k, v in second.items()}


def test_workers_get_small_batches(spark):
    """A worker holds some hundred rows and a few MB at a time, however many rows its partition has and however long they are."""
    import pyarrow as pa

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_pydict({"rows": [b.num_rows], "bytes": [b.nbytes]})

    for rows, letters in ((3000, 1), (200, 100_000)):
        df = spark.range(0, rows, 1, 1).selectExpr("id", "'j' judge_name", "'S' system_text", f"repeat(cast(id % 10 as string), {letters}) prompt")
        for more in ({}, {"batch_size": 7}, {"in_flight": 3}):
            one = lambda name, system, prompt: f"{prompt[0]}{len(prompt)}"
            fn = (lambda xs: [one(*x) for x in xs]) if "batch_size" in more else one
            out = judge(df, fn, policy=NO_SLEEP, **more)
            seen = out.mapInArrow(sizes, "rows long, bytes long").collect()
            assert sum(r["rows"] for r in seen) == rows
            assert max(r["rows"] for r in seen) <= 500 and max(r["bytes"] for r in seen) <= 6 << 20
            assert {(r["id"], r["response"]) for r in out.select("id", "response").collect()} == {(i, f"{i % 10}{letters}") for i in range(rows)}
