"""Structured Streaming operators.

S1 ``score_new_verdicts``: each arriving verdict file is scored once.  File source,
    checkpoint and the file sink give exactly-once processing; scoring is stateless
    (the batch ``score_verdicts`` plan).
S2 ``request_state_stream``: keyed state holds each request's latest change by (ts, event_id)
    and gives out a row only when it moves on.  ``request_state_table`` upserts those rows
    into a bucketed table by the same order, so the table never depends on batch ids, on the
    order of arrival or on the checkpoint: a new checkpoint that replays old changes leaves it as it is.
S3 ``entry_changes``: keyed state per entry holds its judges' scores.  An entry is released, one
    row per judge with sign +1, once every expected judge's score set is complete, and taken back
    with sign -1 when a correction arrives.  ``running_totals`` adds the signed rows up exactly (in
    decimals), and ``running_results`` reads E6, E7 and E8 from the totals.

State lives in the RocksDB state store, on disk and in the checkpoint, so it isn't bounded by memory.
An optional time to live bounds it: after it a request's or an entry's state is dropped.  S2's table stays
right then, as it compares times itself; S3 then takes a late correction for a new entry, so its time to
live has to exceed the time in which corrections come.

Checkpoints live under the cluster's ``spark.checkpoint.dir`` (a shared folder); a local
scratch folder is used only when that is unset (tests).
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from scorewright.functions.scores import SCORE_COLS, round4
from scorewright.operators.scoring import score_verdicts
from scorewright.session import scratch_path
from scorewright.sources.sinks import upsert_partitions

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
BUCKETS = 64


def _ckpt(spark: SparkSession, name: str, given: str | None) -> str:
    return given or scratch_path(spark, f"streams/{name}")


def _keyed(rows: DataFrame, keys: list[str], processor: StatefulProcessor, schema: str, mode: str, ttl: int | None) -> DataFrame:
    """Keyed state over a stream.  Without a time to live no timers run, so an availableNow run ends by itself."""
    rows.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    return rows.groupBy(*keys).transformWithStateInPandas(processor, schema, mode, "None" if ttl is None else "ProcessingTime")


def _start(writer, available_now: bool) -> StreamingQuery:
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")).start()


# ----------------------------------------------------------------- S1


def score_new_verdicts(spark: SparkSession, source_dir: str, schema, sink_dir: str,
                       checkpoint: str | None = None, fmt: str = "parquet",
                       available_now: bool = True) -> StreamingQuery:
    """Score verdict files as they arrive into a Parquet table at ``sink_dir``.

    Spark's file sink commits each micro-batch through its metadata log, so a batch
    retried after a lost executor or a restart is not written twice (exactly-once);
    read the table back with ``spark.read.parquet(sink_dir)``."""
    stream = spark.readStream.format(fmt).schema(schema).load(source_dir)
    return _start(score_verdicts(stream).writeStream.format("parquet").option("path", sink_dir).outputMode("append")
                  .option("checkpointLocation", _ckpt(spark, "s1", checkpoint)), available_now)


# ----------------------------------------------------------------- S2


class _Latest(StatefulProcessor):
    """The latest (time, event, status) of one request."""

    def __init__(self, key: str, ttl: int | None) -> None:
        self.key, self.ttl = key, ttl

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", "us bigint, event_id bigint, status string", self.ttl)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        known = tuple(self.last.get()) if self.last.exists() else None
        best = known
        for part in rows:                       # a hot request's rows come in pieces
            top = part.sort_values(["us", "event_id", "status"], na_position="first").iloc[-1]
            found = (int(top.us), int(top.event_id), None if pd.isna(top.status) else top.status)
            if best is None or found[:2] > best[:2]:
                best = found
        if best is not None and (known is None or best[:2] > known[:2]):
            self.last.update(best)
            yield pd.DataFrame({self.key: [key[0]], "status": [best[2]], "us": [best[0]], "event_id": [best[1]]})

    def close(self) -> None:
        pass


def request_state_stream(changes: DataFrame, key: str = "request_id", ttl_ms: int | None = None) -> DataFrame:
    """S2 (streaming form): a row (key, status, last_ts, event_id) whenever a request's latest change moves on; run
    with outputMode ``update``."""
    kind = changes.schema[key].dataType.simpleString()
    rows = changes.select(key, F.unix_micros(F.col("ts").cast("timestamp")).alias("us"),
                          F.coalesce(F.col("event_id").cast("long"), F.lit(-(1 << 62))).alias("event_id"), "status")
    out = _keyed(rows.filter("us IS NOT NULL"), [key], _Latest(key, ttl_ms), f"`{key}` {kind}, status string, us bigint, event_id bigint", "Update", ttl_ms)
    return out.select(key, "status", F.timestamp_micros("us").alias("last_ts"), "event_id")


def request_state_table(changes: DataFrame, path: str, checkpoint: str | None = None,
                        key: str = "request_id", available_now: bool = True, ttl_ms: int | None = None,
                        buckets: int = BUCKETS) -> StreamingQuery:
    """S2 + B5: keep a request-state table at ``path`` current from a stream of status changes.

    Each micro-batch's changed requests are upserted by (last_ts, event_id) into the buckets (a hash of the key)
    they lie in.  Applying a batch twice, or old changes again, changes nothing."""
    def upsert(batch: DataFrame, batch_id: int) -> None:
        rows = batch.withColumn("bucket", F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int"))
        upsert_partitions(rows, path, [key], ["bucket"], ["last_ts", "event_id"])

    return _start(request_state_stream(changes, key, ttl_ms).writeStream.outputMode("update").foreachBatch(upsert)
                  .option("checkpointLocation", _ckpt(changes.sparkSession, "s2", checkpoint)), available_now)


def read_request_state(spark: SparkSession, path: str) -> DataFrame:
    """The state table: one row per request."""
    return spark.read.parquet(path).drop("bucket")


# ----------------------------------------------------------------- S3

_SCORES = ", ".join(f"{c} double" for c in SCORE_COLS)
_SIGNED = f"file_id string, ordinal bigint, judge_key string, task string, sign int, {_SCORES}"


class _Entry(StatefulProcessor):
    """One entry's judges: releases its rows once all expected ones are complete, takes them back on a correction."""

    def __init__(self, expected: list[str], ttl: int | None) -> None:
        self.expected, self.ttl = expected, ttl

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("seen", "n int", self.ttl)
        self.judges = handle.getMapState("judges", "judge_key string", f"version bigint, ok boolean, task string, {_SCORES}", self.ttl)

    def _released(self) -> list[tuple]:
        held = [tuple(self.judges.getValue((k,))) if self.judges.containsKey((k,)) else None for k in self.expected]
        return [(k, *h[2:]) for k, h in zip(self.expected, held, strict=True)] if all(h and h[1] for h in held) else []

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        before, out = self._released(), []
        if not self.seen.exists():
            self.seen.update((1,))
            out.append((1, (None, None, *[None] * len(SCORE_COLS))))
        for part in rows:                       # a judge's latest version stays; equal versions the greatest row
            for r in part.itertuples(index=False):
                if r.judge_key in self.expected:
                    new = (int(r.version), bool(r.ok), None if pd.isna(r.task) else r.task, *[None if pd.isna(v) else float(v) for v in (getattr(r, c) for c in SCORE_COLS)])
                    old = tuple(self.judges.getValue((r.judge_key,))) if self.judges.containsKey((r.judge_key,)) else None
                    if old is None or (new[0], repr(new)) > (old[0], repr(old)):
                        self.judges.updateValue((r.judge_key,), new)
        after = self._released()
        if before != after:
            out += [(-1, r) for r in before] + [(1, r) for r in after]
        if out:
            frame = pd.DataFrame([(key[0], key[1], r[0], r[1], sign, *r[2:]) for sign, r in out], columns=["file_id", "ordinal", "judge_key", "task", "sign", *SCORE_COLS])
            yield frame.astype({c: "float64" for c in SCORE_COLS})

    def close(self) -> None:
        pass


def entry_changes(judged: DataFrame, expected: list[str], ttl_ms: int | None = None) -> DataFrame:
    """S3, first half: a stream of judged rows -> signed rows of complete entries; outputMode ``append``.

    judged: (file_id, ordinal, task, judge_key, version, seven scores[, score_ok]); a row with NULL ``judge_key``
    only makes its entry known.  Of a judge's rows the highest ``version`` counts, so a replayed file changes
    nothing and a correction replaces.  A row with NULL judge_key and sign +1 counts each entry once."""
    ok = F.col("score_ok") if "score_ok" in judged.columns else F.lit(True)
    if "score_ok" not in judged.columns:
        for c in SCORE_COLS:
            ok = ok & F.col(c).isNotNull()
    rows = judged.select(F.col("file_id").cast("string").alias("file_id"), F.col("ordinal").cast("long").alias("ordinal"), "judge_key", "task",
                         F.col("version").cast("long").alias("version"), F.coalesce(ok, F.lit(False)).alias("ok"), *SCORE_COLS)
    return _keyed(rows, ["file_id", "ordinal"], _Entry(list(expected), ttl_ms), _SIGNED, "Append", ttl_ms)


def running_totals(signed: DataFrame) -> DataFrame:
    """S3, second half: sums and counts per (file, judge, task) of the signed rows, exact in decimals; outputMode
    ``complete`` or ``update`` on a stream, or a plain aggregate on a table of them."""
    number = lambda c: F.coalesce(F.col(c), F.lit(0.0)).cast("decimal(26,12)") * F.col("sign")
    return signed.groupBy("file_id", "judge_key", "task").agg(
        F.sum("sign").alias("n"), F.sum(F.when(F.col("final_score").isNotNull(), F.col("sign")).otherwise(0)).alias("n_final"),
        *[F.sum(number(c)).alias("sum_" + c) for c in SCORE_COLS])


def running_results(totals: DataFrame, expected: list[str]) -> dict[str, DataFrame]:
    """E6 (``wide``), E7 (``tasks``) and E8 (``counts``) of the totals so far, as the batch averaging gives them."""
    mean = lambda top, n: round4(F.when(F.col(n) > 0, F.col(top).cast("double") / F.col(n)))
    per_judge = totals.filter("judge_key IS NOT NULL").groupBy("file_id", "judge_key").agg(
        F.sum("n").alias("n"), *[F.sum("sum_" + c).alias("sum_" + c) for c in SCORE_COLS])
    files = totals.filter("judge_key IS NULL").select("file_id", F.col("n").cast("bigint").alias("total_entries"))
    keys = files.select("file_id", F.explode(F.array(*[F.lit(k) for k in expected])).alias("judge_key"))
    wide = keys.join(per_judge, ["file_id", "judge_key"], "left").select("file_id", "judge_key", *[mean("sum_" + c, "n").alias(c) for c in SCORE_COLS])
    tasks = totals.filter("judge_key IS NOT NULL AND task <> '' AND n_final > 0").select(
        "file_id", "judge_key", "task", mean("sum_final_score", "n_final").alias("score"))
    ok = per_judge.filter(F.col("judge_key") == expected[0]).select("file_id", F.col("n").cast("bigint").alias("successful_entries"))
    counts = files.join(ok, "file_id", "left").fillna(0, ["successful_entries"])
    counts = counts.withColumns({"failed_entries": F.col("total_entries") - F.col("successful_entries"),
                                 "success_ratio": round4(F.col("successful_entries") / F.col("total_entries"))})
    return {"wide": wide, "tasks": tasks, "counts": counts}


def running_averages(spark: SparkSession, judged: DataFrame, expected: list[str], base: str,
                     available_now: bool = True, ttl_ms: int | None = None) -> list[StreamingQuery]:
    """S3 as two queries under ``base``: judged rows -> ``changes`` (signed rows, exactly once through the file sink) ->
    ``totals`` (rewritten whole from the aggregate's state, files x judges x tasks rows).  With ``available_now`` each
    runs until its input is used up, one after the other."""
    base = base.rstrip("/")
    first = _start(entry_changes(judged, expected, ttl_ms).writeStream.format("parquet").option("path", f"{base}/changes").outputMode("append")
                   .option("checkpointLocation", f"{base}/checkpoints/changes"), available_now)
    if available_now:
        first.awaitTermination()
    changes = spark.readStream.schema(_SIGNED).parquet(f"{base}/changes")
    second = _start(running_totals(changes).writeStream.outputMode("complete")
                    .foreachBatch(lambda batch, _: batch.write.mode("overwrite").parquet(f"{base}/totals"))
                    .option("checkpointLocation", f"{base}/checkpoints/totals"), available_now)
    if available_now:
        second.awaitTermination()
    return [first, second]
