"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame whose column
names match the DuckDB oracle in ``plans.oracle_queries``.

Outputs are flat (BIGINT / INT / DOUBLE / STRING) and every double that comes out of
an average is rounded with D27 so both engines hash the same values.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scorewright.functions.scores import CRITERIA, SCORE_COLS, round4
from scorewright.operators import jury as J
from scorewright.operators import results as R
from scorewright.operators.scoring import number_judges, score_verdicts
from scorewright.plans import views as V
from scorewright.session import materialize

ANSWER = ["doc_id"]


# ---------------------------------------------------------------- scoring

def scored(spark: SparkSession, sf: str) -> DataFrame:
    return score_verdicts(V.v_verdicts(spark, sf))


def q_verdict_scores(spark, sf):
    return (scored(spark, sf).filter("usable")
            .select("doc_id", "judge_pos", "round", *SCORE_COLS))


def q_verdict_usability(spark, sf):
    return (scored(spark, sf).groupBy("round", "judge_pos", F.col("usable").cast("int").alias("usable"))
            .agg(F.count(F.lit(1)).cast("bigint").alias("n")))


def q_verdict_rejections(spark, sf):
    """Why verdicts are unusable (no block, bad JSON, empty object, per block;
    unsupported round), counted per round and judge; usable verdicts have no reason."""
    return (scored(spark, sf).groupBy("round", "judge_pos", "reject_reason")
            .agg(F.count(F.lit(1)).cast("bigint").alias("n")))


def q_judge_numbering(spark, sf):
    return number_judges(scored(spark, sf), ANSWER).select("doc_id", "judge_pos", "judge_name", "judge_key")


# ---------------------------------------------------------------- jury

def _jury(spark, sf, strategy):
    j = J.jury_scores(scored(spark, sf), ANSWER, strategy)
    return j.select("doc_id", "n_usable", *[round4(F.col(c)).alias(c) for c in SCORE_COLS])


def q_jury_average(spark, sf):
    return _jury(spark, sf, "average")


def q_jury_vote(spark, sf):
    return _jury(spark, sf, "vote")


# ---------------------------------------------------------------- results

def view_entries(spark: SparkSession, sf: str) -> DataFrame:
    """The entry table of the verdict view: file = model (doc_id % 8), ordinal = doc_id, task = lang."""
    model = F.col("doc_id") % V.N_VIEW_MODELS
    return V.table(spark, sf, "documents").select(
        model.alias("file_id"), F.col("doc_id").alias("ordinal"), F.col("lang").alias("task"),
        F.concat(F.lit("org/model-"), model.cast("string")).alias("model_name"))


def packed_verdicts(spark: SparkSession, sf: str, strategy: str = "vote") -> DataFrame:
    """The view's verdicts scored, renumbered and juried in one packed row per entry, written once: the roster and
    the averages both read it."""
    s = scored(spark, sf).select(F.col("model_id").alias("file_id"), F.col("doc_id").alias("ordinal"), "judge_pos", "judge_name", "usable", *SCORE_COLS)
    return materialize(R.pack_verdicts(s, view_entries(spark, sf), strategy, len(V.VIEW_JUDGES)), "judged_entries")


def _results(spark, sf):
    return R.packed_results(packed_verdicts(spark, sf), "vote")


def q_criterion_averages(spark, sf):
    return _results(spark, sf)["criteria"].select(
        F.col("file_id").alias("model_id"), "judge_key", "judge_name", "criterion", "score")


def q_task_averages(spark, sf):
    return _results(spark, sf)["tasks"].select(
        F.col("file_id").alias("model_id"), "judge_key", "judge_name", "task", "score")


def q_entry_counts(spark, sf):
    return _results(spark, sf)["meta"].select(
        F.col("file_id").alias("model_id"), "model_name", "total_entries", "successful_entries",
        "failed_entries", "success_ratio")


def q_common_judges(spark, sf):
    return R.common_judges(R.file_summary(packed_verdicts(spark, sf)))


def q_judge_rosters(spark, sf):
    return R.judge_rosters(R.file_summary(packed_verdicts(spark, sf))).select(F.col("file_id").alias("model_id"), "judge_key")


# ---------------------------------------------------------------- large aggregates on lineitem (v_big)

def big_scores(spark, sf) -> DataFrame:
    b = V.v_big(spark, sf)
    s = None
    for c in CRITERIA:
        s = F.col(c) if s is None else s + F.col(c)
    return b.withColumn("final_score", round4(s / F.lit(6.0))).withColumn("usable", F.lit(True))


def q_big_jury_vote(spark, sf):
    j = J.jury_scores(big_scores(spark, sf), ["answer_id"], "vote")
    return j.select("answer_id", "n_usable", *[round4(F.col(c)).alias(c) for c in SCORE_COLS])


def q_big_jury_average(spark, sf):
    j = J.jury_scores(big_scores(spark, sf), ["answer_id"], "average")
    return j.select("answer_id", "n_usable", *[round4(F.col(c)).alias(c) for c in SCORE_COLS])


def q_big_criterion_averages(spark, sf):
    b = big_scores(spark, sf)
    return b.groupBy("model_id", "judge_pos").agg(
        F.count(F.lit(1)).cast("bigint").alias("n"),
        *[round4(F.avg(c)).alias(c) for c in SCORE_COLS])


def q_big_task_averages(spark, sf):
    b = big_scores(spark, sf)
    return b.groupBy("model_id", "judge_pos", "task").agg(round4(F.avg("final_score")).alias("score"))


# ---------------------------------------------------------------- items and messages

from scorewright.functions import text as T  # noqa: E402
from scorewright.operators import items as I  # noqa: E402
from scorewright.operators import requests as Rq  # noqa: E402

# Stand-in closing instructions and judge system texts for the prompt queries.
VIEW_CLOSING = {0: "Evaluate the answer.", 1: "Evaluate the answer.", 2: "Evaluate both answers."}
VIEW_JUDGE_BASE = "JUDGE-BASE"
VIEW_JUDGE_SUFFIX = {0: " R0", 1: " R1", 2: " R2"}


#: What names an item of the view.
ITEM = ["conversation", "part"]


def q_item_validity(spark, sf):
    return I.generation_check(V.v_items(spark, sf)).select(
        *ITEM, "round", F.col("gen_ok").cast("int").alias("gen_ok"), "gen_reason")


def q_answer_validity(spark, sf):
    return I.judging_check(V.v_answers(spark, sf)).select(
        *ITEM, "model_pos", F.col("judge_ok").cast("int").alias("judge_ok"), "reject_reason")


def _system():
    """The conversation's own system text, else the prompt of its language."""
    return F.coalesce(F.col("system_text"), I.system_prompt(F.col("language"), V.VIEW_PROMPTS))


def _messages(spark, sf):
    items = I.generation_check(V.v_items(spark, sf)).filter("gen_ok")
    p = I.generation_passes(items)
    sysp = _system()
    prior = F.concat(F.lit("model answer to: "), T.strip(F.col("q1")))
    return p.withColumn("messages", I.build_messages(F.col("round"), F.col("q1"), F.col("a1"), F.col("q2"),
                                                     prior, sysp, F.col("pass")))


def q_conversation_messages(spark, sf):
    m = _messages(spark, sf)
    return m.select(*ITEM, "pass", F.posexplode("messages").alias("pos", "msg")).select(
        *ITEM, "pass", "pos", F.col("msg.role").alias("role"), F.col("msg.content").alias("content"))


def q_flat_prompts(spark, sf):
    m = _messages(spark, sf)
    o_model = F.lit("o1-mini")
    return m.select(*ITEM, "pass",
                    I.flatten_messages(F.col("messages")).alias("prompt"),
                    F.size(I.drop_system(F.col("messages"), o_model)).cast("int").alias("n_no_system"),
                    I.split_system(F.col("messages"))[0].alias("system_text"))


def q_judge_prompts(spark, sf):
    a = I.judging_check(V.v_answers(spark, sf)).filter("judge_ok")
    return a.select(*ITEM, "model_pos",
                    I.judge_system(F.col("round"), VIEW_JUDGE_BASE, VIEW_JUDGE_SUFFIX).alias("system_text"),
                    I.judge_prompt(F.col("round"), VIEW_CLOSING).alias("prompt"))


def q_stamped_answers(spark, sf):
    a = V.v_answers(spark, sf)
    lic = T.detect_license(F.col("model_name"))
    a = a.withColumn("_lic", lic)
    a = I.stamp_model(a, F.col("model_name"), F.col("_lic"), F.lit("main"), F.lit("bfloat16"), F.lit("7.0"))
    a = I.with_default_answers(a)
    return a.select(*ITEM, "model_pos", "model_name", "license", "revision", "precision", "params",
                    "m1", "m2")


def q_expand_runs(spark, sf):
    pending = Rq.pending_requests(Rq.request_state(V.v_requests(spark, sf)))
    items = V.v_items(spark, sf)
    return I.expand_runs(items.select("task_set", *ITEM, "round"),
                         pending.select("task_set", "request_id", "model_name"))


def q_unjudged_answers(spark, sf):
    """answers not judged yet; the judged side is every round-0 answer with a model
    answer (the part of the work already done)."""
    a = V.v_answers(spark, sf)
    key = [*ITEM, "model_pos"]
    judged = a.filter((F.col("round") == 0) & (F.col("m1") != "")).select(*key)
    return I.unjudged(a.select(*key), judged, key)


# ---------------------------------------------------------------- models and files

def q_model_routing(spark, sf):
    m = V.v_models(spark, sf)
    name = F.col("model_name")
    org, mid = T.model_name_fields(name)
    porg, pid = T.model_path_parts(name)
    return m.select(
        "model_key", "model_name",
        T.route_provider(name).alias("provider"),
        T.request_org(name).alias("request_org"),
        T.route_judge(name).alias("judge_route"),
        T.detect_license(name).alias("license"),
        T.request_bucket(name).alias("bucket"),
        org.alias("org"), mid.alias("model_id"),
        porg.alias("path_org"), pid.alias("path_model"),
        T.request_file_name(mid, F.col("revision"), F.col("precision")).alias("request_file"),
        T.answers_file_name(F.coalesce(porg, F.lit("x")), name, F.col("revision"), F.col("precision"))
        .alias("answers_file"),
        T.is_o_series(name).cast("int").alias("o_series"))


def q_model_params(spark, sf):
    m = V.v_models(spark, sf)
    return m.select(
        "model_key", "precision", "params",
        T.precision_bits(F.col("precision")).alias("bits"),
        T.params_billion(F.col("params"), F.col("total_bytes"), F.col("precision")).alias("params_b"),
        T.params_source(F.col("params")).alias("params_source"))


def q_folder_bytes(spark, sf):
    f = V.v_files(spark, sf)
    sizes = Rq.folder_bytes(f, "model", "size")
    prec = F.when(F.col("total_bytes") % 2 == 0, F.lit("bfloat16")).otherwise(F.lit("float32"))
    return sizes.select("model", "n_files", "total_bytes",
                        T.params_billion(F.lit(None).cast("string"), F.col("total_bytes"), prec).alias("params_b"))


# ---------------------------------------------------------------- requests

def q_request_state(spark, sf):
    st = Rq.request_state(V.v_requests(spark, sf))
    return st.select("request_id", "model_name", "task_set", "status", "reset_status", "category",
                     F.col("unknown_status").cast("int").alias("unknown_status"))


def q_pending_requests(spark, sf):
    return Rq.pending_requests(Rq.request_state(V.v_requests(spark, sf))).select("request_id", "model_name")


def q_unfinished_requests(spark, sf):
    return Rq.unfinished(Rq.request_state(V.v_requests(spark, sf))).select("request_id", "status")


def q_run_summary(spark, sf):
    r = V.v_requests(spark, sf).withColumn("run_id", F.to_date("ts").cast("string"))
    return Rq.run_summary(r, "run_id")


def q_register_requests(spark, sf):
    st = Rq.request_state(V.v_requests(spark, sf)).select("model_name", "status")
    # the models asked for: every model of the models view plus those whose last run finished
    models = V.v_models(spark, sf).select("model_name").union(
        st.filter(F.col("status") == "FINISHED").select("model_name")).distinct()
    return Rq.register_requests(models, st, "model_name")


def q_register_manifests(spark, sf):
    """F7 by request file: the manifests of every model of the models view and of those whose last run finished, with
    their seven fields; a manifest that lies there already keeps its status."""
    known = Rq.request_state(V.v_requests(spark, sf)).select("model_name", "status")
    existing = Rq.request_files(known.select("model_name")).select("model_name", "bucket", "org", "file").join(known, "model_name")
    listed = V.v_models(spark, sf).select("model_name", "revision", "precision", "params")
    asked = listed.unionByName(known.filter(F.col("status") == "FINISHED").select("model_name"), allowMissingColumns=True)
    return Rq.register_requests(Rq.request_files(asked), existing, ["bucket", "org", "file"])


def _states(spark, sf):
    """Every request's state now and at the midpoint of the time range, from one aggregate; the midpoint is a scalar
    subquery."""
    r = V.v_requests(spark, sf)
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    mid = r.agg(F.floor((F.min(us) + F.max(us)) / 2).alias("c")).scalar()
    r = r.withColumn("us", us).withColumn("cut", mid)
    return Rq.request_states_at(r, F.col("cut"), ts="us")


def q_pull_new(spark, sf):
    """the local copy is the state at the midpoint of the time range; the remote side
    is the state now.  Requests first seen after the midpoint are pulled, local ones kept."""
    st = _states(spark, sf)
    side = lambda name, status: F.struct(F.lit(name).alias("source"), status.alias("status"))
    sides = F.filter(F.array(side("remote", F.col("status")), F.when(F.col("was_known"), side("local", F.col("old_status")))), lambda x: x.isNotNull())
    both = st.select("request_id", F.inline(sides))
    return Rq.pull_new(both.filter("source = 'remote'").drop("source"), both.filter("source = 'local'").drop("source"), ["request_id"])


def q_item_turns(spark, sf):
    """Turns of each conversation that its items hold (every user and assistant turn, texts or not) and whether its
    system text is with them."""
    return V.turn_pairs(spark, sf).groupBy("conv_id").agg(
        F.sum("user_turns").alias("user_turns"), F.sum("assistant_turns").alias("assistant_turns"),
        F.max("system_text").alias("system_text"))


def q_mirror_plan(spark, sf):
    """the local files are the states now, the remote ones those at the midpoint; every seventh remote file lies
    outside the status folders.  Both sides of a file are in one row, so nothing is joined."""
    held = F.when(F.col("request_id") % 7 == 3, F.lit("archive")).otherwise(T.status_category(F.col("old_status")))
    pairs = _states(spark, sf).select(
        F.col("task_set").alias("org"), F.concat(F.col("request_id").cast("string"), F.lit(".json")).alias("file"),
        F.array(T.status_category(F.col("status"))).alias("put"),
        F.when(F.col("was_known"), F.array(held)).otherwise(F.array().cast("array<string>")).alias("held"))
    return Rq.plan_actions(pairs)


def q_mirror_folders(spark, sf):
    """F9 on two separate listings: local manifests by request, remote ones by event, so one file may lie in several
    remote folders; unknown remote files are deleted."""
    local = _states(spark, sf).select(F.col("task_set").alias("org"), F.concat((F.col("request_id") % 400).cast("string"), F.lit(".json")).alias("file"), "status")
    e = V.v_requests(spark, sf)
    remote = e.select(T.status_category(F.col("status")).alias("category"), F.col("task_set").alias("org"),
                      F.concat((F.col("request_id") % 500).cast("string"), F.lit(".json")).alias("file"))
    return Rq.mirror_plan(local, remote, delete_orphans=True)


# ---------------------------------------------------------------- more results operators

def q_jury_everywhere(spark, sf):
    return R.jury_everywhere(R.file_summary(packed_verdicts(spark, sf)))


def _big_partial(spark, sf, cond):
    b = big_scores(spark, sf).filter(cond)
    return b.groupBy("model_id", "judge_pos").agg(
        F.count(F.lit(1)).cast("bigint").alias("n"), round4(F.avg("final_score")).alias("final_score"))


def q_results_upsert(spark, sf):
    """F8 + H3: old results (answers with an even order key) upserted with new results for
    every third model (all answers); key (model_id, judge_pos)."""
    old = _big_partial(spark, sf, F.col("answer_id") % 2 == 0).withColumn("generation", F.lit(1))
    new = _big_partial(spark, sf, F.col("model_id") % 3 == 0).withColumn("generation", F.lit(2))
    return R.upsert_results(old, new, ["model_id", "judge_pos"]).select(
        "model_id", "judge_pos", "n", "final_score", "generation")


def q_results_last_wins(spark, sf):
    """H3: three result files name some models twice and more; the later file replaces the earlier one."""
    old = _big_partial(spark, sf, F.col("answer_id") % 2 == 0).withColumn("generation", F.lit(1))
    parts = [_big_partial(spark, sf, (F.col("model_id") % 4 < k) & (F.col("answer_id") % k == 0)).withColumn("generation", F.lit(k)) for k in (2, 3)]
    return R.upsert_results(old, parts[0].unionByName(parts[1]), ["model_id", "judge_pos"]).select(
        "model_id", "judge_pos", "n", "final_score", "generation")


def q_results_union(spark, sf):
    """result tables of different columns, one below the other; missing columns are NULL."""
    crit = _big_partial(spark, sf, F.lit(True)).withColumn("file", F.lit("criteria"))
    return R.union_results([crit, q_big_task_averages(spark, sf).withColumn("file", F.lit("tasks"))])


def q_assembled_results(spark, sf):
    """E11 flattened again: one row per file, judge entry and task of the nested documents."""
    out = _results(spark, sf)
    nested = R.assemble_results(out["wide"], out["tasks"], out["meta"])
    e = nested.select(F.col("file_id").alias("model_id"), "model_name", "total_entries", F.explode("judges").alias("judge_entry", "v"))
    return e.select("model_id", "model_name", "total_entries", "judge_entry", F.col("v")["3C3H Scores"]["3C3H Score"].alias("final_score"),
                    F.explode_outer(F.col("v")["Tasks Scores"]).alias("task", "task_score"))


def q_attached_answers(spark, sf):
    """items with their completions; an item whose model said nothing is left out."""
    said = V.v_answers(spark, sf).filter(F.col("m1") != "").select(*ITEM, "model_pos", "m1")
    return I.attach_answers(V.v_items(spark, sf).select(*ITEM, "task_set", "q1"), said, ITEM)


def q_list_arguments(spark, sf):
    """Comma separated arguments, made of part names, as judges (stripped, lower-cased, blanks left out) and as
    models (verbatim), with their positions."""
    arg = F.concat(F.lit(" "), F.replace(F.upper("p_name"), F.lit(" "), F.lit(" ,")), F.when(F.col("p_partkey") % 5 == 0, F.lit(", ,")).otherwise(F.lit("")))
    p = V.table(spark, sf, "part").select("p_partkey", arg.alias("arg"))
    lists = [("judges", T.parse_list(F.col("arg"), lower=True)), ("models", T.parse_list(F.col("arg")))]
    both = F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), v.alias("items")) for k, v in lists]))
    return p.select("p_partkey", both.alias("l")).select("p_partkey", "l.kind", F.posexplode("l.items").alias("pos", "item"))


# ---------------------------------------------------------------- small additions (X1-X4), labelled as ours

def q_leaderboard_rank(spark, sf):
    """Models ranked by the jury's 3C3H score (dense rank; ties share a rank).  The
    window runs over the aggregated results (models x judges rows), not over entries."""
    from pyspark.sql import Window
    crit = _results(spark, sf)["wide"].filter(F.col("judge_key") == "Jury")
    w = Window.orderBy(F.col("final_score").desc_nulls_last())
    return crit.select(F.col("file_id").alias("model_id"), "final_score",
                       F.dense_rank().over(w).cast("bigint").alias("rank"))


def q_judge_agreement(spark, sf):
    """Share of answers on which two configured judges gave the same Correct value.
    One row per answer with a column per configured judge position (conditional
    aggregation over a bounded list: one shuffle), then one global aggregate: no
    self-join and no pair rows per answer."""
    s = scored(spark, sf).filter("usable")
    n = len(V.VIEW_JUDGES)
    wide = s.groupBy("doc_id").agg(*[F.max(F.when(F.col("judge_pos") == p, F.col("correct"))).alias(str(p))
                                     for p in range(1, n + 1)])
    aggs = []
    for a in range(1, n + 1):
        for b in range(a + 1, n + 1):
            both = F.col(str(a)).isNotNull() & F.col(str(b)).isNotNull()
            aggs += [F.count_if(both).cast("bigint").alias(f"n_{a}_{b}"),
                     F.count_if(both & (F.col(str(a)) == F.col(str(b)))).cast("bigint").alias(f"agree_{a}_{b}")]
    out = wide.agg(*aggs)
    pairs = [(a, b) for a in range(1, n + 1) for b in range(a + 1, n + 1)]
    stack = ", ".join(f"{a}, {b}, n_{a}_{b}, agree_{a}_{b}" for a, b in pairs)
    return out.selectExpr(f"stack({len(pairs)}, {stack}) AS (judge_a, judge_b, n, agree)").select(
        "judge_a", "judge_b", "n", "agree",
        F.when(F.col("n") > 0, round4(F.col("agree") / F.col("n"))).alias("share"))


def q_gold_agreement(spark, sf):
    """Agreement of each judge's Correct with the gold ``labels.quality``."""
    s = scored(spark, sf).filter("usable").select("doc_id", "judge_pos", "correct")
    gold = V.table(spark, sf, "labels").select("doc_id", "quality")
    j = s.join(gold, "doc_id")
    return j.groupBy("judge_pos").agg(
        F.count(F.lit(1)).cast("bigint").alias("n"),
        round4(F.avg(F.when(F.col("correct") == F.col("quality").cast("double"), 1.0).otherwise(0.0))).alias("agreement"))


def q_source_averages(spark, sf):
    """Average final score per (document source, judge) - the category-style roll-up."""
    s = scored(spark, sf).filter("usable")
    return s.groupBy("source", "judge_pos").agg(F.count(F.lit(1)).cast("bigint").alias("n"), round4(F.avg("final_score")).alias("score"))


# ---------------------------------------------------------------- message variants, aliases, timing

def q_vision_messages(spark, sf):
    """D12 + D29: vision models get typed content parts; open models with a chat template
    get no system message.  modality by conversation % 4: 3 -> Text+Vision, 2 -> missing
    (Text), else Text; chat template on for even conversations."""
    m = _messages(spark, sf)
    modality = I.modality_of(F.when(F.col("conversation") % 4 == 3, F.lit("Text+Vision"))
                             .when(F.col("conversation") % 4 == 2, F.lit(None).cast("string")).otherwise(F.lit("Text")))
    template = F.col("conversation") % 2 == 0
    sysp = _system()
    prior = F.concat(F.lit("model answer to: "), T.strip(F.col("q1")))
    msgs = I.build_messages(F.col("round"), F.col("q1"), F.col("a1"), F.col("q2"), prior, sysp, F.col("pass"),
                            include_system=~template | (modality != "Text"))
    m = m.withColumns({"modality": modality, "msgs": msgs})
    vision = I.to_vision(F.col("msgs"))
    return m.select(
        *ITEM, "pass", "modality",
        F.size("msgs").cast("int").alias("n_messages"),
        F.get(F.col("msgs"), 0)["role"].alias("first_role"),
        F.when(F.col("modality") != "Text", F.get(F.get(vision, 0)["content"], 0)["type"]).alias("first_part_type"),
        F.when(F.col("modality") != "Text", F.get(F.get(vision, -1 + F.size("msgs"))["content"], 0)["text"])
        .alias("last_part_text"))


# Short judge names and the model ids they stand for (view data).
VIEW_ALIASES = {"claude-3.5-sonnet": "claude-3-5-sonnet-20241022", "claude-3-haiku": "claude-3-haiku-20240307"}


def q_judge_routes(spark, sf):
    """D5 + D26 on model names used as judge names."""
    from scorewright.operators.jury import judge_alias
    m = V.v_models(spark, sf)
    name = F.regexp_replace(F.lower(F.col("model_name")), r"^claude-3-(\d+)$", "claude-3.5-sonnet")
    return m.select("model_key", name.alias("judge_name"),
                    judge_alias(name, VIEW_ALIASES).alias("judge_id"),
                    T.route_judge(name).alias("route"))


def q_run_durations(spark, sf):
    """Per run (day) the span between first and last status change as HH:MM:SS.ss."""
    r = V.v_requests(spark, sf).withColumn("run_id", F.to_date("ts").cast("string"))
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    d = r.groupBy("run_id").agg(((F.max(us) - F.min(us)) / 1e6).alias("secs"))
    return d.select("run_id", round4(F.col("secs")).alias("secs"), T.hms(F.col("secs")).alias("elapsed"))


# ---------------------------------------------------------------- caller-supplied generation (U1) with a stub model

def stub_model(messages: list[dict]) -> str:
    """Deterministic stand-in for a model: describes the whole last user turn."""
    last = [m for m in messages if m["role"] == "user"][-1]["content"]
    return f"echo: {len(last)} chars {len(last.split())} words"


def q_stub_generation(spark, sf):
    """U1 on every generation pass of the items view, with a deterministic stub model."""
    from scorewright.operators.inference import complete
    m = _messages(spark, sf).select(*ITEM, "pass", "messages")
    return complete(m, stub_model).select(*ITEM, "pass", "completion")


def stub_judge(name: str, system: str, prompt: str) -> str:
    """Deterministic stand-in for a judge: scores from the length of the whole prompt."""
    n = len(prompt)
    b1 = {"Correct": 1 if n % 3 else 0, "Complete": 1, "Concise": 1 + n % 5, "Helpful": 5, "Honest": 4,
          "Harmless": 5}
    fence = "`" * 3
    out = f"Assessment.\n<results1>\n{fence}json\n{json.dumps(b1)}\n{fence}\n</results1>"
    if system.endswith("R2"):
        b2 = {"Correct": 1, "Complete": n % 2, "Concise": 3, "Helpful": 4, "Honest": 5, "Harmless": 5}
        out += f"\n<results2>\n{fence}json\n{json.dumps(b2)}\n{fence}\n</results2>"
    return out


def q_stub_judging(spark, sf):
    """U2 + scoring: two configured judges per valid answer, a deterministic stub judge,
    then the verdicts scored (D16-D19, E1, E2)."""
    from scorewright.operators.inference import NO_WAIT, judge
    a = I.judging_check(V.v_answers(spark, sf)).filter("judge_ok")
    calls = J.expand_judges(a, ["gpt-4o", "k2-65b"]).withColumns({
        "system_text": I.judge_system(F.col("round"), VIEW_JUDGE_BASE, VIEW_JUDGE_SUFFIX),
        "prompt": I.judge_prompt(F.col("round"), VIEW_CLOSING)})
    verdicts = judge(calls.select(*ITEM, "model_pos", "judge_pos", "judge_name", "round", "system_text", "prompt"),
                     stub_judge, policy=NO_WAIT)
    return score_verdicts(verdicts).select(*ITEM, "model_pos", "judge_pos",
                                           F.col("usable").cast("int").alias("usable"), *SCORE_COLS)


QUERIES = {
    "verdict_scores": q_verdict_scores,
    "verdict_usability": q_verdict_usability,
    "verdict_rejections": q_verdict_rejections,
    "judge_numbering": q_judge_numbering,
    "jury_average": q_jury_average,
    "jury_vote": q_jury_vote,
    "criterion_averages": q_criterion_averages,
    "task_averages": q_task_averages,
    "entry_counts": q_entry_counts,
    "common_judges": q_common_judges,
    "judge_rosters": q_judge_rosters,
    "big_jury_vote": q_big_jury_vote,
    "big_jury_average": q_big_jury_average,
    "big_criterion_averages": q_big_criterion_averages,
    "big_task_averages": q_big_task_averages,
    "item_validity": q_item_validity,
    "answer_validity": q_answer_validity,
    "conversation_messages": q_conversation_messages,
    "flat_prompts": q_flat_prompts,
    "judge_prompts": q_judge_prompts,
    "stamped_answers": q_stamped_answers,
    "expand_runs": q_expand_runs,
    "unjudged_answers": q_unjudged_answers,
    "model_routing": q_model_routing,
    "model_params": q_model_params,
    "folder_bytes": q_folder_bytes,
    "request_state": q_request_state,
    "pending_requests": q_pending_requests,
    "unfinished_requests": q_unfinished_requests,
    "run_summary": q_run_summary,
    "register_requests": q_register_requests,
    "pull_new": q_pull_new,
    "mirror_plan": q_mirror_plan,
    "mirror_folders": q_mirror_folders,
    "register_manifests": q_register_manifests,
    "results_last_wins": q_results_last_wins,
    "results_union": q_results_union,
    "assembled_results": q_assembled_results,
    "attached_answers": q_attached_answers,
    "list_arguments": q_list_arguments,
    "item_turns": q_item_turns,
    "jury_everywhere": q_jury_everywhere,
    "results_upsert": q_results_upsert,
    "leaderboard_rank": q_leaderboard_rank,
    "judge_agreement": q_judge_agreement,
    "gold_agreement": q_gold_agreement,
    "source_averages": q_source_averages,
    "vision_messages": q_vision_messages,
    "judge_routes": q_judge_routes,
    "run_durations": q_run_durations,
    "stub_generation": q_stub_generation,
    "stub_judging": q_stub_judging,
}
