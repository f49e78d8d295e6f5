"""The three entry points as compositions of the operators.

generate_answers  requests -> reset + C1 -> F3 x items -> C3/C5 -> D11 -> U1 -> D20 -> D1
judge_answers     answers -> C4/C5 -> F4 (D5 unknown judges dropped, D26 aliases) -> D15
                  -> U2 -> verdict barrier -> D16-D19, E1, E2 -> H2 + E3/E4 (E5)
average_results   judged + entries -> E13, G1, E14, C6 -> E6, E7, E8, E10

Every model or judge call happens once per row in ``mapInPandas``; the outputs of those
calls are written (``materialize`` or the verdict path) before anything reads them twice,
so a retried task or a later step never repeats a call.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from scorewright.functions.scores import SCORE_COLS
from scorewright.functions.text import blank_to_null, default_answer, params_billion, route_judge, route_provider, strip
from scorewright.operators import inference as U
from scorewright.operators import items as I
from scorewright.operators import jury as J
from scorewright.operators import requests as Rq
from scorewright.operators import results as R
from scorewright.operators.scoring import number_judges, score_verdicts
from scorewright.session import materialize
from scorewright.sources.json_arrays import observed
from scorewright.sources.sinks import write_results

#: item_id: the item's ordinal in its file where there is one, else its sn.  run_id: model, revision and precision.
ITEM_KEY = ["task_set", "item_id"]
RUN_KEY = ITEM_KEY + ["run_id"]


def with_keys(df: DataFrame) -> DataFrame:
    """Adds item_id and run_id where the columns they are made of exist."""
    have = set(df.columns)
    if "item_id" not in have and have & {"ordinal", "sn"}:
        df = df.withColumn("item_id", F.coalesce(*(F.col(c).cast("string") for c in ("ordinal", "sn") if c in have)))
    if "run_id" not in have and "model_name" in have:
        df = df.withColumn("run_id", F.concat_ws("|", *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("model_name", "revision", "precision") if c in have)))
    return df


def generate_answers(items: DataFrame, requests: DataFrame, model_fn: Callable[..., str],
                     prompts: dict[str, str], include_system: bool = True,
                     policy: U.RetryPolicy | None = None, concurrency: int | None = None,
                     folders: DataFrame | None = None, with_request: bool = False, **calls) -> DataFrame:
    """§3.1: answers of every pending request's model for every valid item of its task set.

    requests: (task_set, model_name, license, revision, precision, params, status) and, where known, modality
    (D29: missing is ``Text``) and chat_template (the open model has one, so it gets no system message, D12).
    folders: (model_name, total_bytes), from which open models' params are estimated (D10); without it they are
    taken as requested.
    Round 0: one call; round 1: one call with the gold first answer (a blank one is
    generated first); round 2: the first answer, then the follow-up with the model's own
    first answer.  The first-pass answers are written before the second pass reads them.
    Proprietary models get their messages in their provider's form (D3, D13); Text+Vision models get typed parts.
    ``with_request`` passes ``model_fn(messages, request)`` a dict with model_name, provider, modality and the
    separate ``system`` text of providers that take one.  ``calls`` goes on to ``complete`` (batch_size, in_flight, rates).
    """
    optional = {"modality": F.lit(None).cast("string"), "chat_template": F.lit(False)}
    pending = Rq.pending_requests(Rq.reset_running(requests))
    pending = pending.withColumns({c: v for c, v in optional.items() if c not in requests.columns}).select(
        "task_set", "model_name", "license", "revision", "precision", "params",
        I.modality_of(F.col("modality")).alias("modality"), F.coalesce("chat_template", F.lit(False)).alias("chat_template"))
    if folders is not None:
        sized = params_billion(F.col("params"), F.col("total_bytes"), F.col("precision")).cast("string")
        given = F.col("total_bytes").isNull() | (F.col("license") == "Proprietary")
        pending = pending.join(folders.select("model_name", "total_bytes"), "model_name", "left").withColumn(
            "params", F.when(given, F.col("params")).otherwise(sized)).drop("total_bytes")
    runs = with_keys(I.generation_check(I.expand_runs(items, pending)).filter("gen_ok"))
    prop = F.col("license") == "Proprietary"
    runs = runs.withColumns({"provider": F.when(prop, route_provider(F.col("model_name"))).otherwise(F.lit("open")),
                             "_vision": ~prop & (F.col("modality") != "Text")})
    sysp = I.system_prompt(F.col("language") if "language" in runs.columns else F.lit(None), prompts)
    r, a1_blank = F.col("round"), blank_to_null(F.col("a1")).isNull()
    needs_first = (r == 0) | (r == 2) | ((r == 1) & a1_blank)
    says_system = F.lit(include_system) & (prop | F.col("_vision") | ~F.col("chat_template"))

    def ask(rows: DataFrame, prior: F.Column, pass_: F.Column, out_col: str) -> DataFrame:
        built = I.build_messages(r, F.col("q1"), F.col("a1"), F.col("q2"), prior, sysp, pass_, says_system)
        rows = rows.withColumn("_built", built)
        sent, system = I.provider_messages(F.col("_built"), F.col("provider"), F.col("model_name"))
        rows = rows.withColumns({"messages": sent, "system": system}).drop("_built")
        request = ("model_name", "provider", "modality", "system") if with_request else ()
        return U.complete(rows, model_fn, out_col=out_col, policy=policy, concurrency=concurrency, request_cols=request,
                          vision_col="_vision", **calls).drop("messages", "system")

    first = materialize(ask(runs.filter(needs_first), F.lit(None).cast("string"), F.when(r == 1, 0).otherwise(1), "first_answer"), "first_pass")
    second_in = runs.filter(r != 0).join(first.select(*RUN_KEY, "first_answer"), RUN_KEY, "left")
    second = ask(second_in, F.col("first_answer"), F.when(r == 1, 1).otherwise(2), "second_answer")
    base = first.filter(r == 0).withColumn("second_answer", F.lit(None).cast("string"))
    both = base.unionByName(second, allowMissingColumns=True)
    lic = F.col("license")
    m1 = F.when(r == 1, F.col("second_answer")).otherwise(F.col("first_answer"))   # Q19, Q20
    m2 = F.when(r == 2, F.col("second_answer"))
    out = both.withColumns({"m1": default_answer(m1, lic), "m2": F.when(r == 2, default_answer(m2, lic))})
    out = I.stamp_model(out, F.col("model_name"), lic, F.col("revision"), F.col("precision"), F.col("params"))
    return out.drop("first_answer", "second_answer", "gen_ok", "gen_reason", "status", "_vision")


def judge_answers(answers: DataFrame, judges: list[str], judge_fn: Callable[[str, str, str], str],
                  strategy: str, base_system: str, suffixes: dict[int, str], closing: dict[int, str] | None = None,
                  aliases: dict[str, str] | None = None, verdict_path: str | None = None,
                  answer_keys: list[str] = RUN_KEY, policy: U.RetryPolicy | None = None,
                  concurrency: int | None = None, tally: Observation | None = None, **calls_with) -> tuple[DataFrame, DataFrame]:
    """§3.2: returns (verdicts with scores, judged long table incl. the jury).

    Answers failing C4/C5 are not judged; ``rejected_answers`` returns them and ``tally`` counts answers read, kept
    and rejected.  ``calls_with`` goes on to ``judge`` (batch_size, in_flight, rates).  Judges whose name has no route (D5) are
    skipped like the reference does.  The raw verdicts are written first (barrier)."""
    strategy = J.resolve_strategy(judges, strategy)
    checked = I.judging_check(answers)
    checked = checked if tally is None else observed(checked, tally, "reject_reason")
    ok = with_keys(checked.filter("judge_ok"))
    calls = J.expand_judges(ok, judges, aliases).filter(route_judge(F.col("judge_short")).isNotNull())
    calls = calls.withColumns({"system_text": I.judge_system(F.col("round"), base_system, suffixes),
                               "prompt": I.judge_prompt(F.col("round"), closing)})
    calls = calls.withColumn("provider", route_judge(F.col("judge_short")))
    call = lambda todo: U.judge(todo, judge_fn, judge_col="judge_model", policy=policy, concurrency=concurrency, **calls_with)
    verdicts = (U.judge_once(calls, call, verdict_path, [*answer_keys, "judge_name"]) if verdict_path
                else materialize(call(calls), "verdicts"))
    scored = score_verdicts(verdicts)
    keys = answer_keys + ["task"] if "task" in scored.columns else answer_keys
    jrows = number_judges(scored, answer_keys).select(*keys, "judge_key", "judge_name", *SCORE_COLS)
    if strategy != "SingleJudge":
        jury = J.jury_rows(scored, keys, strategy, len(judges)).select(*keys, "judge_key", "judge_name", *SCORE_COLS)
        jrows = jrows.unionByName(jury)
    return scored, jrows


def rejected_answers(answers: DataFrame) -> DataFrame:
    """C4/C5 side output: the answers that ``judge_answers`` leaves out, with ``reject_reason``."""
    return I.judging_check(answers).filter(~F.col("judge_ok")).drop("judge_ok")


def average_results(judged: DataFrame, answers: DataFrame, strategy: str,
                    file_keys: list[str] = ("task_set", "run_id"), results_path: str | None = None) -> dict[str, DataFrame]:
    """§3.3: one results "file" per (task set, run); entry ordinal = item ordinal.  With ``results_path`` the
    criteria, tasks and meta tables are upserted there by file (F8, B3), beside what earlier runs left."""
    file_id = F.concat_ws("/", *[F.col(k) for k in file_keys])
    order = F.col("ordinal") if "ordinal" in answers.columns else F.col("sn")
    answers, judged = with_keys(answers), with_keys(judged)
    entries = answers.select(file_id.alias("file_id"), order.alias("ordinal"), "sn", "task",
                             *[c for c in R.META_COLS if c in answers.columns])
    j = judged.join(answers.select(*RUN_KEY, order.alias("ordinal")), RUN_KEY).withColumn("file_id", file_id)
    out = R.model_results(j.select("file_id", "ordinal", "task", "judge_key", "judge_name", *SCORE_COLS),
                          entries.drop("sn"), strategy)
    if results_path is not None:
        for name in ("criteria", "tasks", "meta"):
            write_results(out[name], f"{results_path.rstrip('/')}/{name}", strategy)
    return out


def run_outcomes(answers: DataFrame, scored: DataFrame, keys: list[str] = ("task_set", "model_name"),
                 attempted: DataFrame | None = None) -> DataFrame:
    """B6 input + Q16: per model, ``ok`` = answers were generated (the reference marks the
    request FINISHED on that alone) and ``judged`` = at least one usable verdict exists,
    so a model whose judging failed is visible.  With ``attempted`` (the requests that were
    run) a model without any answer is there with ``ok`` false.  One aggregate per side, joined on the
    model key (one row per model on each side)."""
    keys = list(keys)
    gen = answers.groupBy(*keys).agg(F.count(F.lit(1)).cast("bigint").alias("n_answers"),
                                     F.count_if(F.col("m1") == U.ERROR).cast("bigint").alias("n_errors"))
    jud = scored.groupBy(*keys).agg(F.count_if(F.col("usable")).cast("bigint").alias("n_usable_verdicts"))
    if attempted is not None:
        gen = attempted.select(*keys).distinct().join(gen, keys, "left").fillna(0, ["n_answers", "n_errors"])
    out = gen.join(jud, keys, "left").fillna(0, ["n_usable_verdicts"])
    return out.withColumns({"ok": F.col("n_answers") > 0, "judged": F.col("n_usable_verdicts") > 0})


__all__ = ["with_keys", "generate_answers", "judge_answers", "rejected_answers", "average_results", "run_outcomes", "strip"]
