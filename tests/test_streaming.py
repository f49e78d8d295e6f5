"""Stream = batch for S1, S2 and S3."""

import json
import os

from pyspark.sql import functions as F

from scorewright.functions.scores import SCORE_COLS
from scorewright.operators.scoring import score_verdicts
from scorewright.operators.requests import request_state
from scorewright.streaming.jobs import request_state_stream, score_new_verdicts

SCHEMA = "doc_id bigint, judge_pos int, round int, model_id bigint, task string, response string"


def verdict_rows(n0, n1):
    out = []
    for d in range(n0, n1):
        for j in (1, 2):
            sc = {"Correct": (d + j) % 3 != 0, "Complete": 1, "Concise": d % 6, "Helpful": 1 + j,
                  "Honest": 5, "Harmless": d % 4}
            body = json.dumps(sc) if (d + j) % 5 else "{broken"
            out.append((d, j, 0, d % 3, f"t{d % 2}", f"text {d}\n<results1>\n```json\n{body}\n```\n</results1>"))
    return out


def write_batches(spark, base, ranges):
    for i, (a, b) in enumerate(ranges):
        spark.createDataFrame(verdict_rows(a, b), SCHEMA).coalesce(1).write.mode("overwrite").parquet(f"{base}/b{i}")


def test_s1_scores_each_file_once(spark, tmp):
    src, sink, ckpt = f"{tmp}/src", f"{tmp}/sink", f"{tmp}/ckpt"
    os.makedirs(src)
    stage = f"{tmp}/stage"
    write_batches(spark, stage, [(0, 10), (10, 25), (25, 40)])
    import shutil
    for i in range(2):
        for f in os.listdir(f"{stage}/b{i}"):
            if f.endswith(".parquet"):
                shutil.copy(f"{stage}/b{i}/{f}", f"{src}/b{i}-{f}")
    score_new_verdicts(spark, src, SCHEMA, sink, ckpt).awaitTermination()
    for f in os.listdir(f"{stage}/b2"):
        if f.endswith(".parquet"):
            shutil.copy(f"{stage}/b2/{f}", f"{src}/b2-{f}")
    score_new_verdicts(spark, src, SCHEMA, sink, ckpt).awaitTermination()
    streamed = spark.read.parquet(sink)
    batch = score_verdicts(spark.createDataFrame(verdict_rows(0, 40), SCHEMA))
    cols = ["doc_id", "judge_pos", "usable"] + SCORE_COLS
    assert streamed.count() == 80
    assert sorted(map(tuple, streamed.select(cols).collect())) == sorted(map(tuple, batch.select(cols).collect()))


def judged_files():
    """Judged rows by arriving file: judges in different files, entries without judges, corrections, replays, a late judge."""
    def row(f, o, j, version, base, task="t0", ok=True):
        return (f, o, task, j, version, ok, *[base * k / 8 if ok or k < 3 else None for k in range(1, 8)])
    known = [(f, o, f"t{o % 2}", None, 0, False, *[None] * 7) for f in ("a", "b") for o in range(6)]
    one = known + [row("a", o, "Judge 1", 1, o / 10, f"t{o % 2}") for o in range(6)] + [row("a", o, "Jury", 1, 0.5, f"t{o % 2}") for o in range(4)]
    two = [row("a", 1, "Judge 1", 2, 0.9, "t1"), row("a", 0, "Jury", 1, 0.5, "t0"), row("b", 2, "Judge 1", 1, 0.3, None), row("b", 2, "Jury", 1, 0.3, None)]
    three = [row("a", 4, "Jury", 1, 0.7, "t0"), row("a", 2, "Judge 1", 3, 0.2, "t0", ok=False), row("a", 1, "Judge 1", 1, 0.1, "t1")]
    four = [row("a", 2, "Judge 1", 4, 0.25, "t9"), row("b", 5, "Judge 1", 1, 1.0, "t1"), row("b", 5, "Judge 7", 1, 1.0, "t1"), row("a", 5, "Jury", 1, 0.123456789, "t1")]
    return [one, two, three, four]


def test_s3_running_averages_equal_batch(spark, tmp):
    """After 1, 3 and all files the running results equal E6-E8 over the latest rows; corrections and replays included."""
    from pyspark.sql import Window

    from scorewright.operators import results as R
    from scorewright.streaming.jobs import running_averages, running_results
    schema = "file_id string, ordinal bigint, task string, judge_key string, version bigint, score_ok boolean, " + ", ".join(f"{c} double" for c in SCORE_COLS)
    files, expected = judged_files(), ["Judge 1", "Jury"]
    for upto, fresh in ((1, [0]), (3, [1, 2]), (4, [3, 1])):
        for i in fresh:
            spark.createDataFrame(files[i], schema).coalesce(1).write.mode("append").parquet(f"{tmp}/src")
        running_averages(spark, spark.readStream.schema(schema).parquet(f"{tmp}/src"), expected, f"{tmp}/run")
        got = running_results(spark.read.parquet(f"{tmp}/run/totals"), expected)
        rows = spark.createDataFrame([r for f in files[:upto] for r in f], schema)
        last = (rows.filter("judge_key IS NOT NULL").withColumn("rn", F.row_number().over(Window.partitionBy("file_id", "ordinal", "judge_key").orderBy(F.desc("version"))))
                .filter("rn = 1"))
        # an entry's task is that of its judge rows here, so the entry table takes it from them
        entries = rows.groupBy("file_id", "ordinal").agg(F.max_by("task", "version").alias("task"))
        packed = R.pack_judged(last.select("file_id", "ordinal", "judge_key", F.col("judge_key").alias("judge_name"), "score_ok", *SCORE_COLS), entries)
        agg = R.averages(R.flag_valid(packed, F.array(*[F.lit(k) for k in expected]))).collect()
        want = {(r.file_id, r.judge_key): tuple(r[c] for c in SCORE_COLS) for r in agg if r["_set"] == 1}
        assert {(r.file_id, r.judge_key): tuple(r[c] for c in SCORE_COLS) for r in got["wide"].collect()} == want
        assert {(r.file_id, r.total_entries, r.successful_entries) for r in got["counts"].collect()} == {
            (r.file_id, r.total_entries, r.successful_entries) for r in agg if r["_set"] == 1}
        if upto != 4:
            assert {(r.file_id, r.judge_key, r.task, r.score) for r in got["tasks"].collect()} == {
                (r.file_id, r.judge_key, r.task, r.score) for r in agg if r["_set"] == 0 and r.task and r.score is not None}


def test_s2_request_state_stream_equals_batch(spark, tmp):
    rows = [(i, f"2024-01-01 00:00:{i % 60:02d}", i % 7, ["PENDING", "RUNNING", "FINISHED", "FAILED"][i % 4])
            for i in range(50)]
    df = spark.createDataFrame(rows, "event_id bigint, ts string, request_id bigint, status string") \
        .withColumn("ts", F.to_timestamp("ts"))
    df.write.parquet(f"{tmp}/changes")
    stream = spark.readStream.schema(df.schema).parquet(f"{tmp}/changes")
    q = (request_state_stream(stream).writeStream.outputMode("update").format("memory")
         .queryName("s2_state").option("checkpointLocation", f"{tmp}/ck2").start())
    q.processAllAvailable()
    q.stop()
    got = {r["request_id"]: r["status"] for r in spark.sql("SELECT * FROM s2_state").collect()}
    exp = {r["request_id"]: r["status"] for r in request_state(df, keep=()).collect()}
    assert got == exp


def test_s2_state_table(spark, tmp):
    """The table follows the stream; a new checkpoint over an old table, old changes again and late ones change nothing."""
    from scorewright.streaming.jobs import read_request_state, request_state_table
    schema = "event_id bigint, ts timestamp, request_id bigint, status string"
    src = f"{tmp}/changes2"
    first = [(1, "2024-01-01 00:00:01", 1, "PENDING"), (2, "2024-01-01 00:00:02", 2, "PENDING")]
    second = [(3, "2024-01-01 00:00:03", 1, "RUNNING"), (4, "2024-01-01 00:00:04", 1, "FINISHED"), (5, "2024-01-01 00:00:04", 3, None)]
    late = [(0, "2023-01-01 00:00:00", 1, "FAILED"), (9, "2024-01-01 00:00:00", 2, "FAILED")]
    mk = lambda rows: spark.createDataFrame(rows, "event_id bigint, ts string, request_id bigint, status string") \
        .withColumn("ts", F.to_timestamp("ts"))
    stream = lambda: spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(src)
    state = lambda: {r["request_id"]: r["status"] for r in read_request_state(spark, f"{tmp}/state").collect()}
    mk(first).write.parquet(f"{src}/a")
    request_state_table(stream(), f"{tmp}/state", f"{tmp}/ck_state").awaitTermination()
    assert state() == {1: "PENDING", 2: "PENDING"}
    mk(second).write.parquet(f"{src}/b")
    request_state_table(stream(), f"{tmp}/state", f"{tmp}/ck_state").awaitTermination()
    assert state() == {1: "FINISHED", 2: "PENDING", 3: None}
    mk(late).write.parquet(f"{src}/c")
    request_state_table(stream(), f"{tmp}/state", f"{tmp}/ck_new").awaitTermination()
    assert state() == {1: "FINISHED", 2: "PENDING", 3: None} and read_request_state(spark, f"{tmp}/state").count() == 3
