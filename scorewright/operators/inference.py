"""Caller-supplied model and judge functions as distributed batch jobs.

The only place, with the array reader and the keyed streams, where Python workers run.
Rows travel to the workers in Arrow batches (``mapInPandas``); the function is captured in
the closure and called per row or per list of rows, with a bounded number of calls in
flight and a rate budget per provider.  Failures never abort the job: a
generation failure becomes ``ERROR`` and a judge failure returns its last error text,
with the number of attempts recorded.

Side effects: a judge call must not be repeated by a task retry or by a later change
of the parser, so ``judge`` output is meant to be written (the verdict table) before
any parsing runs - the barrier of the pipeline.  Keep ``spark.speculation`` off (the
session default here).  Concurrency towards a provider is bounded by the number of
partitions handed to ``mapInPandas`` (``concurrency``).
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import nullcontext
from dataclasses import dataclass, field
from threading import Lock

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

ERROR = "ERROR"

#: Rows and bytes of one Arrow batch sent to a worker, at most: a worker holds a batch, its inputs and its answers.
BATCH_ROWS = 500
BATCH_BYTES = 4 << 20


@dataclass
class RetryPolicy:
    """Attempts, wait between attempts, a predicate choosing which errors are retried
    and the wait used for them (e.g. a 429 waits 60 s and is retried once).  ``sleep`` is
    injectable so tests don't wait."""
    attempts: int = 3
    wait: float = 5.0
    retry_if: Callable[[str], bool] = field(default=lambda err: True)
    wait_for: Callable[[str], float] | None = None
    sleep: Callable[[float], None] = time.sleep

    def run(self, call: Callable[[], str]) -> tuple[str | None, int, str | None]:
        """Returns (text, attempts, last error)."""
        err = None
        for attempt in range(1, self.attempts + 1):
            try:
                return call(), attempt, None
            except Exception as e:  # noqa: BLE001 - any provider failure is data here
                err = f"{type(e).__name__}: {e}"
                if attempt == self.attempts or not self.retry_if(err):
                    return None, attempt, err
                self.sleep(self.wait_for(err) if self.wait_for else self.wait)
        return None, self.attempts, err


# A policy with one attempt and no waiting (deterministic functions, tests).
NO_WAIT = RetryPolicy(attempts=1, wait=0.0)


def rate_limit_policy(sleep: Callable[[float], None] = time.sleep) -> RetryPolicy:
    """The generation policy: one retry after 60 s on a 'too many requests' error only."""
    return RetryPolicy(attempts=2, wait=60.0,
                       retry_if=lambda e: "429" in e and "Too many requests" in e, sleep=sleep)


@dataclass
class RateBudget:
    """Calls per second allowed to each provider over the whole job, shared evenly by the partitions that call:
    ``partitions`` tasks may run at once, so each spaces its calls to a provider by partitions / rate seconds.
    A provider that isn't listed is not limited.  ``clock`` and ``sleep`` are injectable for tests."""
    per_second: dict[str, float]
    partitions: int
    clock: Callable[[], float] = time.monotonic
    sleep: Callable[[float], None] = time.sleep

    def gate(self) -> Callable[[str], None]:
        """One task's gate: waits until the provider's next slot; safe for several threads."""
        lock, free = Lock(), {}

        def wait(provider: str) -> None:
            rate = self.per_second.get(provider)
            if rate:
                with lock:
                    now = self.clock()
                    at = max(now, free.get(provider, now))
                    free[provider] = at + self.partitions / rate
                if at > now:
                    self.sleep(at - now)

        return wait


def _messages(v) -> list[dict]:
    if v is None:
        return []
    return [{"role": m["role"], "content": m["content"]} for m in v]


def _vision(messages: list[dict]) -> list[dict]:
    """D12 on the worker: content as a list of typed parts."""
    return [{"role": m["role"], "content": [{"type": "text", "text": m["content"]}]} for m in messages]


def call_all(inputs: list[tuple], providers: list[str], fn: Callable, policy: RetryPolicy, batch_size: int | None = None,
             in_flight: int = 1, gate: Callable[[str], None] | None = None) -> list[tuple[str | None, int, str | None]]:
    """(text, attempts, last error) of every input (a tuple of arguments), in order, with at most ``in_flight`` calls
    open at a time.

    Without ``batch_size`` each input is a call ``fn(*input) -> text``.  With it ``fn(list of inputs) -> list of
    texts`` gets up to that many inputs of one provider; a batch that fails or gives another number of texts is
    tried again input by input, so one bad input costs no other."""
    wait = gate or (lambda provider: None)

    def one(i: int) -> tuple:
        def call() -> str:
            wait(providers[i])
            return fn(*inputs[i]) if batch_size is None else _single(fn([inputs[i]]))
        return policy.run(call)

    def many(at: list[int]) -> list[tuple]:
        def call() -> list[str]:
            wait(providers[at[0]])
            texts = list(fn([inputs[i] for i in at]))
            if len(texts) != len(at):
                raise ValueError(f"{len(texts)} texts for {len(at)} inputs")
            return texts
        texts, n, _ = policy.run(call)
        return [(t, n, None) for t in texts] if texts is not None else [one(i) for i in at]

    with ThreadPoolExecutor(in_flight) if in_flight > 1 else nullcontext() as pool:
        each = pool.map if pool else map
        if batch_size is None:
            return list(each(one, range(len(inputs))))
        groups: dict[str, list[int]] = {}
        for i, p in enumerate(providers):
            groups.setdefault(p, []).append(i)
        parts = [at[k:k + batch_size] for at in groups.values() for k in range(0, len(at), batch_size)]
        out: list = [None] * len(inputs)
        for at, found in zip(parts, each(many, parts), strict=True):
            for i, f in zip(at, found, strict=True):
                out[i] = f
        return out


def _single(texts) -> str:
    texts = list(texts)
    if len(texts) != 1:
        raise ValueError(f"{len(texts)} texts for 1 input")
    return texts[0]


def complete(df: DataFrame, fn: Callable, messages_col: str = "messages",
             out_col: str = "completion", policy: RetryPolicy | None = None,
             fallback_col: str | None = None, concurrency: int | None = None, batch_size: int | None = None,
             in_flight: int = 1, rates: dict[str, float] | None = None, provider_col: str = "provider",
             request_cols: tuple[str, ...] = (), vision_col: str | None = None) -> DataFrame:
    """U1 (+U4): run ``fn(messages) -> text`` on every row's message list; with ``batch_size``
    ``fn([(messages,), ...]) -> texts`` per batch.

    A failure (an exception after the policy's attempts) becomes ``ERROR``; an empty
    answer stays empty (D20 turns it into ``None`` / ``ERROR`` by licence).  With
    ``fallback_col`` (U4: the flattened prompt, D14) a failed row is tried once more with
    a single user message holding that text before giving up.  ``concurrency`` partitions call at the same time,
    each with ``in_flight`` open calls; ``rates`` (calls per second by provider) is split over the partitions.
    ``request_cols`` are passed to ``fn`` as a second argument, a dict; rows whose ``vision_col`` is true get their
    contents as typed parts (D12)."""
    policy = policy or RetryPolicy(attempts=1, wait=0.0)
    schema = T.StructType(df.schema.fields + [T.StructField(out_col, T.StringType())])
    src, budget = _spread(df, concurrency, rates, batch_size)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        gate = budget.gate() if budget else None
        for pdf in batches:
            extra = [({c: r[c] for c in request_cols},) for r in pdf[list(request_cols)].to_dict("records")] if request_cols else [()] * len(pdf)
            vision = pdf[vision_col].fillna(False).tolist() if vision_col else [False] * len(pdf)
            who = pdf[provider_col].tolist() if provider_col in pdf else [""] * len(pdf)
            shaped = lambda msgs, v: _vision(msgs) if v else msgs
            inputs = [(shaped(_messages(m), v), *x) for m, v, x in zip(pdf[messages_col], vision, extra, strict=True)]
            texts = [t for t, _, _ in call_all(inputs, who, fn, policy, batch_size, in_flight, gate)]
            if fallback_col is not None:
                failed = [i for i, t in enumerate(texts) if t is None]
                flat = [(shaped([{"role": "user", "content": pdf[fallback_col].iloc[i]}], vision[i]), *extra[i]) for i in failed]
                for i, (t, _, _) in zip(failed, call_all(flat, [who[i] for i in failed], fn, policy, batch_size, in_flight, gate), strict=True):
                    texts[i] = t
            pdf = pdf.copy()
            pdf[out_col] = [t.strip() if t is not None else ERROR for t in texts]
            yield pdf

    return src.mapInPandas(run, schema)


def judge(df: DataFrame, fn: Callable, judge_col: str = "judge_name",
          system_col: str = "system_text", prompt_col: str = "prompt",
          policy: RetryPolicy | None = None, concurrency: int | None = None, batch_size: int | None = None,
          in_flight: int = 1, rates: dict[str, float] | None = None, provider_col: str = "provider") -> DataFrame:
    """One row per (answer, judge) -> ``response`` (the verdict text, or the last error
    text after the retries), ``attempts`` and ``error``.  Judges of one answer are
    separate rows, so they run in parallel.  ``fn(judge, system, prompt)``, or with ``batch_size`` a list of such
    triples; concurrency, calls in flight and rates as in ``complete``."""
    policy = policy or RetryPolicy(attempts=3, wait=5.0)
    schema = T.StructType(df.schema.fields + [
        T.StructField("response", T.StringType()), T.StructField("attempts", T.IntegerType()),
        T.StructField("error", T.StringType())])
    src, budget = _spread(df, concurrency, rates, batch_size)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        gate = budget.gate() if budget else None
        for pdf in batches:
            inputs = list(zip(pdf[judge_col], pdf[system_col], pdf[prompt_col], strict=True))
            who = pdf[provider_col if provider_col in pdf else judge_col].tolist()
            got = call_all(inputs, who, fn, policy, batch_size, in_flight, gate)
            pdf = pdf.copy()
            pdf["response"] = [t.strip() if t is not None else err for t, _, err in got]
            pdf["attempts"], pdf["error"] = [n for _, n, _ in got], [err for _, _, err in got]
            yield pdf

    return src.mapInPandas(run, schema)


def _spread(df: DataFrame, concurrency: int | None, rates: dict[str, float] | None, batch_size: int | None = None) -> tuple[DataFrame, RateBudget | None]:
    """``df`` in ``concurrency`` partitions, and the rate budget that they share.  From now on the session sends its
    workers batches of ``BATCH_ROWS`` rows (``batch_size``, if that is more) and ``BATCH_BYTES`` at most."""
    spark = df.sparkSession
    for k, most in (("Records", max(BATCH_ROWS, batch_size or 0)), ("Bytes", BATCH_BYTES)):
        spark.conf.set(f"spark.sql.execution.arrow.max{k}PerBatch", str(most))
    if rates and not concurrency:
        concurrency = spark.sparkContext.defaultParallelism
    return (df.repartition(concurrency) if concurrency else df), (RateBudget(dict(rates), concurrency) if rates else None)


def verdict_barrier(verdicts: DataFrame, path: str) -> DataFrame:
    """Materialise judge output before parsing: append to the verdict table and read it
    back, so re-running the scoring never calls a judge again."""
    verdicts.write.mode("append").parquet(path)
    return verdicts.sparkSession.read.parquet(path)


def read_log(spark: SparkSession, path: str) -> DataFrame | None:
    """The verdict log at ``path``; None before the first call.  Logs of older form lack ``judged_at``."""
    try:
        log = spark.read.option("mergeSchema", "true").parquet(path)
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None
    return log if "judged_at" in log.columns else log.withColumn("judged_at", F.lit(None).cast("timestamp"))


def first_by(df: DataFrame, keys: list[str], order: list[F.Column]) -> DataFrame:
    """One row per key, the first by ``order`` and then by all plain columns, so never one by chance."""
    rest = [F.col(f.name).asc_nulls_first() for f in df.schema.fields if f.name not in keys and isinstance(f.dataType, T.AtomicType)]
    w = Window.partitionBy(*keys).orderBy(*order, *rest)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def latest_verdicts(log: DataFrame, keys: list[str]) -> DataFrame:
    """One verdict per key of the log: the latest success, or the latest error where no call succeeded yet."""
    return first_by(log, keys, [F.col("error").isNull().desc(), F.col("judged_at").desc_nulls_last()])


def judge_once(calls: DataFrame, call: Callable[[DataFrame], DataFrame], path: str, keys: list[str]) -> DataFrame:
    """F1 before U2 over a verdict log: calls without a *successful* verdict at ``path`` are made and appended with
    their attempts, error and time.  A failed call stays open: the next run makes it again.

    Returns the latest verdicts (``latest_verdicts``) of these ``calls``, one per key."""
    spark = calls.sparkSession
    log = read_log(spark, path)
    same = lambda a, b: [F.col(f"{a}.{k}").eqNullSafe(F.col(f"{b}.{k}")) for k in keys]
    todo = first_by(calls, keys, [])
    if log is not None:
        done = log.filter(F.col("error").isNull()).select(*keys).distinct()
        todo = todo.alias("c").join(done.alias("k"), same("c", "k"), "left_anti")
    call(todo).withColumn("judged_at", F.current_timestamp()).write.mode("append").parquet(path)
    wanted = calls.select(*keys).distinct()
    every = read_log(spark, path).alias("v").join(wanted.alias("w"), same("v", "w"), "left_semi")
    return latest_verdicts(every, keys)


def is_error_answer(answer_col: str = "m1") -> F.Column:
    """Q23: flag answers that are the ``ERROR`` placeholder (they are judged like any other)."""
    return F.col(answer_col) == F.lit(ERROR)
