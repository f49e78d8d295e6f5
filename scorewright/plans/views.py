"""Deterministic evaluation views derived from the driver tables.

The driver tables hold no judgments, so every query family reads a view that maps
them onto the evaluation data model with integer arithmetic and CASE only (no hash or
random function).  The DuckDB side builds the same views in ``plans.oracle``.

All views are lazy DataFrames over ``spark.read.parquet``: filters and column
selections of the queries reach the Parquet scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scorewright.operators.jury import expand_judges
from scorewright.session import balance

# Judges configured for the verdict view, in configured order.
VIEW_JUDGES = ["gpt-4o", "claude-3-5-sonnet", "jais-70b"]
N_VIEW_MODELS = 8


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _s(c: Column) -> Column:
    return c.cast("string")


def _cat(*parts) -> Column:
    return F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])


NL = "\n"


def v_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` x 3 judges -> one raw verdict per (doc, judge).

    The verdict is the whole document text followed by tagged, fenced JSON blocks.  Case
    ``k = (doc_id + judge_pos) % 11`` selects the dirt: 0 wrong tag, 1 truncated JSON,
    2 list value, 3 object value, 4 string value, 5 null value, 6 round 2 with one block,
    7 empty object, 8 boolean Correct, 9 decimal value and tab whitespace, 10 missing key.
    """
    docs = balance(table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source"))
    v = expand_judges(docs, VIEW_JUDGES).withColumn("j", F.col("judge_pos").cast("bigint"))
    # One select; later expressions use earlier aliases (Spark resolves them into a chain
    # of projections): the case selector, the twelve criterion values, the JSON pieces,
    # then the response text.
    nl, tab = "chr(10)", "chr(9)"
    exprs = {
        "k": "(doc_id + j) % 11",
        "round": "CAST(doc_id % 3 AS INT)",
        "model_id": f"doc_id % {N_VIEW_MODELS}",
        "task": "lang",
        "c1": "CASE WHEN (doc_id * 3 + j) % 7 = 0 THEN 0 WHEN (doc_id * 3 + j) % 7 = 1 THEN 2 ELSE 1 END",
        "x1": "(doc_id * 5 + j * 2) % 3",
        "y1": "(doc_id * 7 + j * 3) % 8",
        "h1": "1 + (doc_id * 11 + j * 5) % 5",
        "o1": "1 + (doc_id * 13 + j) % 5",
        "m1": "(doc_id * 17 + j * 7) % 6",
        "c2": "CASE WHEN (doc_id * 5 + j) % 4 = 0 THEN 0 ELSE 1 END",
        "x2": "(doc_id + j) % 2",
        "y2": "1 + (doc_id * 3 + j) % 5",
        "h2": "1 + (doc_id + j * 3) % 5",
        "o2": "1 + (doc_id * 7 + j) % 5",
        "m2": "1 + (doc_id * 9 + j) % 5",
        "json1": """CASE WHEN k = 7 THEN '{}'
            WHEN k = 1 THEN concat('{"Correct": ', c1, ', "Complete": ', x1, ', "Concise"')
            ELSE concat('{"Correct": ', CASE WHEN k = 8 THEN (CASE WHEN c1 = 1 THEN 'true' ELSE 'false' END)
                                            ELSE CAST(c1 AS STRING) END, ', ',
                        CASE WHEN k = 10 THEN '' ELSE concat('"Complete": ', x1, ', ') END,
                        '"Concise": ', CASE WHEN k = 2 THEN concat('[', y1, ', "x", ', h1, ']')
                                            WHEN k = 9 THEN concat(y1, '.5') ELSE CAST(y1 AS STRING) END,
                        ', "Helpful": ', CASE WHEN k = 3 THEN concat('{"a": ', h1, ', "b": "x", "c": ', y1, '}')
                                              ELSE CAST(h1 AS STRING) END,
                        ', "Honest": ', CASE WHEN k = 4 THEN concat('"', o1, '"') ELSE CAST(o1 AS STRING) END,
                        ', "Harmless": ', CASE WHEN k = 5 THEN 'null' ELSE CAST(m1 AS STRING) END, '}') END""",
        "json2": """concat('{"Correct": ', c2, ', "Complete": ', x2, ', "Concise": ', y2, ', "Helpful": ', h2,
                           ', "Honest": ', o2, ', "Harmless": ', m2, '}')""",
        "tag": "CASE WHEN k = 0 THEN 'result1' ELSE 'results1' END",
        "sep": f"CASE WHEN k = 9 THEN concat(' ', {tab}) ELSE {nl} END",
        "response": f"""concat(coalesce(text, ''), {nl}, '<', tag, '>', sep, '```json', sep, json1, sep, '```', sep,
                               '</', tag, '>',
                               CASE WHEN round = 2 AND k <> 6 THEN concat({nl}, '<results2>', {nl}, '```json', {nl},
                                    json2, {nl}, '```', {nl}, '</results2>') ELSE '' END)""",
    }
    v = v.selectExpr("*", *[f"{e} AS {name}" for name, e in exprs.items()])
    return v.select("doc_id", "judge_pos", "judge_name", "round", "model_id", "task", "source", "response")


def v_big(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lineitem`` as judge score rows for the large aggregates.

    answer = l_orderkey, model = l_orderkey % 50, judge = l_linenumber, task = one of
    seven names by l_orderkey % 7 (constant per answer).  Criteria come from quantity,
    discount and tax, already on the normalised 0..1 scale.
    """
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_tax")
    q, disc, tax = F.col("l_quantity"), F.col("l_discount"), F.col("l_tax")
    correct = F.when(q % 3 == 0, F.lit(0.0)).otherwise(F.lit(1.0))
    return li.select(
        F.col("l_orderkey").alias("answer_id"),
        (F.col("l_orderkey") % 50).alias("model_id"),
        F.col("l_linenumber").alias("judge_pos"),
        _cat("task", _s(F.col("l_orderkey") % 7)).alias("task"),
        correct.alias("correct"),
        (correct * F.when(q % 2 == 0, 1.0).otherwise(0.0)).alias("complete"),
        (correct * (q % 5) / 4).alias("concise"),
        (correct * disc * 10).alias("helpful"),
        (correct * tax * 12.5).alias("honest"),
        (correct * ((q + F.col("l_linenumber")) % 5) / 4).alias("harmless"),
    )


# Models answering the items view, in order.
VIEW_MODELS = ["org0/alpha-7b", "org1/beta-13b", "gpt-4o", "claude-3-5-sonnet"]
# Stand-in system prompts for the items view (real prompts come from the caller).
VIEW_PROMPTS = {"arabic": "SYS-AR", "hindi": "SYS-HI", "default": "SYS-DEFAULT"}


def turn_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``conversations`` cut into items of two user and two assistant turns each.

    User and assistant turns are numbered per conversation; turns 2k + 1 and 2k + 2 of either
    role are q1 / a1 and q2 / a2 of item k, so every such turn is in exactly one item.  The
    conversation's first system text comes with each item.  The numbering window and the pivot
    aggregate are both met by one shuffle by conv_id.
    """
    from pyspark.sql import Window
    t = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    whole = Window.partitionBy("conv_id")
    upto = whole.orderBy("turn").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    nu, na = (F.sum(F.when(F.col("role") == r, 1).otherwise(0)).over(upto) for r in ("user", "assistant"))
    said = F.when((F.col("role") == "system") & F.col("text").isNotNull(), F.col("turn"))
    t = t.withColumns({"n": F.when(F.col("role") == "user", nu).otherwise(na) - 1,
                       "system_text": F.min_by("text", said).over(whole)})
    t = t.filter(F.col("role").isin("user", "assistant"))
    t = t.withColumns({"part": F.floor(F.col("n") / 2), "second": F.col("n") % 2})
    pick = lambda role, second: F.max(F.when((F.col("role") == role) & (F.col("second") == second), F.col("text")))
    return t.groupBy("conv_id", "part").agg(pick("user", 0).alias("q1"), pick("assistant", 0).alias("a1"),
                                            pick("user", 1).alias("q2"), pick("assistant", 1).alias("a2"),
                                            F.first("system_text").alias("system_text"),
                                            F.count_if(F.col("role") == "user").alias("user_turns"),
                                            F.count_if(F.col("role") == "assistant").alias("assistant_turns"))


def v_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``conversations`` -> question items, one per two turn pairs of a conversation.

    (conversation, part) names the item.  By the conversation: round = conversation % 3, except
    every 23rd (round 3, unsupported); a1 is blanked to whitespace on every 19th (C3/C4
    rejections must be injected: the table has no blank text).  ``system_text`` is the
    conversation's own system turn, NULL without one.
    """
    c = F.col("conv_id")
    return turn_pairs(spark, sf_dir).select(
        _cat("conv", _s(c % 2)).alias("task_set"),
        c.alias("conversation"), "part",
        F.when(c % 23 == 22, F.lit(3)).otherwise((c % 3).cast("int")).alias("round"),
        _cat("task", _s(c % 4)).alias("task"),
        _cat("cat", _s(c % 3)).alias("category"),
        F.when(c % 5 == 0, F.lit("Arabic")).when(c % 5 == 1, F.lit("HINDI"))
        .when(c % 5 == 2, F.lit(None).cast("string")).otherwise(F.lit("English")).alias("language"),
        "system_text", "q1",
        F.when(c % 19 == 7, F.lit(" \n\t ")).otherwise(F.col("a1")).alias("a1"),
        "q2", "a2")


def v_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``v_items`` x 4 models: m1 / m2 copy a1 / a2 and are blanked when
    (conversation + part + model_pos) % 7 = 0."""
    items = v_items(spark, sf_dir)
    arr = F.array(*[F.struct(F.lit(i + 1).alias("model_pos"), F.lit(m).alias("model_name"))
                    for i, m in enumerate(VIEW_MODELS)])
    a = items.withColumn("_m", F.explode(arr)).select("*", "_m.*").drop("_m")
    blank = (F.col("conversation") + F.col("part") + F.col("model_pos")) % 7 == 0
    return a.withColumns({
        "m1": F.when(blank, F.lit("")).otherwise(F.col("a1")),
        "m2": F.when(blank, F.lit("")).otherwise(F.col("a2")),
    })


def v_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``part`` -> model names with and without ``/`` and with provider keywords, plus
    revision, precision, params text and a folder size, all by key arithmetic."""
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size")
    k, size = F.col("p_partkey"), _s(F.col("p_size"))
    dashed = F.regexp_replace(F.col("p_name"), " ", "-")
    name = (F.when(k % 12 == 0, _cat("gpt-4o-", size))
            .when(k % 12 == 1, _cat("o1-preview-", size))
            .when(k % 12 == 2, _cat("Claude-3-", size))
            .when(k % 12 == 3, _cat("jais-", size, "b"))
            .when(k % 12 == 4, _cat("Llama-3-", size, "B"))
            .when(k % 12 == 5, _cat("gemini-1.5-", size))
            .when(k % 12 == 6, _cat("deepseek-v", size))
            .when(k % 12 == 7, _cat("mistral-large-", size))
            .when(k % 12 == 8, _cat("grok-", size))
            .when(k % 12 == 9, _cat("nanda-", size))
            .when(k % 12 == 10, _cat("/org", _s(k % 13), "/", dashed, "-", size, "/"))
            .otherwise(F.regexp_replace(F.col("p_name"), " ", "_")))
    precision = (F.when(F.col("p_size") % 9 == 0, "bfloat16").when(F.col("p_size") % 9 == 1, "float16")
                 .when(F.col("p_size") % 9 == 2, "float32").when(F.col("p_size") % 9 == 3, "fp8")
                 .when(F.col("p_size") % 9 == 4, "4bit").when(F.col("p_size") % 9 == 5, "8bit")
                 .when(F.col("p_size") % 9 == 6, "UNK").when(F.col("p_size") % 9 == 7, "BF16")
                 .otherwise("int8"))
    params = (F.when(k % 8 == 0, "7").when(k % 8 == 1, "0").when(k % 8 == 2, "0.5")
              .when(k % 8 == 3, "8.03").when(k % 8 == 4, "7B").when(k % 8 == 5, "")
              .when(k % 8 == 6, "UNK").otherwise("70"))
    return p.select(
        k.alias("model_key"), name.alias("model_name"),
        F.when(k % 3 == 0, F.lit("main")).otherwise(_cat("rev", _s(k % 5))).alias("revision"),
        precision.alias("precision"), params.alias("params"),
        (k * 7340033 + F.col("p_size") * 1048576).alias("total_bytes"))


# Event type -> request status for the requests view.
EVENT_STATUS = {"view": "PENDING", "click": "RUNNING", "purchase": "FINISHED", "error": "FAILED",
                "signup": "REJECTED"}


def v_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` -> request status changes: request = user_id; view -> PENDING,
    click -> RUNNING, purchase -> FINISHED, error -> FAILED, signup -> REJECTED; every
    13th event writes the status lower-case; task set conv0-conv2 by user_id % 3.  Time =
    ts, ties broken by event_id."""
    e = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type")
    st = None
    for k, v in EVENT_STATUS.items():
        st = F.when(F.col("event_type") == k, F.lit(v)) if st is None else st.when(F.col("event_type") == k, F.lit(v))
    u = F.col("user_id")
    return e.select(
        "event_id", "ts", u.alias("request_id"),
        F.when(F.col("event_id") % 13 == 0, F.lower(st)).otherwise(st).alias("status"),
        _cat("conv", _s(u % 3)).alias("task_set"),
        F.when(u % 3 == 0, _cat("gpt-4o-", _s(u))).otherwise(_cat("org", _s(u % 5), "/model-", _s(u)))
        .alias("model_name"))


def v_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` as model folder listings: model = source, file = doc_id, size = n_chars."""
    return table(spark, sf_dir, "documents").select(
        F.col("source").alias("model"), F.col("doc_id").alias("file_id"), F.col("n_chars").alias("size"))
