"""Verdict scoring.

Input: one row per (answer, judge) with the raw judge response and the item round.
Output: the same rows with ``usable`` plus the seven scores.  No shuffle: every
column is a row-local expression, so scoring is a single narrow stage that scales
with the number of input partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scorewright.functions.scores import (
    CRITERIA, CRITERIA_KEYS, SCORE_COLS, as_object, block_pattern, sql_container_score, sql_is_container,
    sql_normalise_one, sql_round4, sql_scalar_score,
)


def score_verdicts(verdicts: DataFrame, response_col: str = "response",
                   round_col: str = "round", clamp: bool = False) -> DataFrame:
    """Add ``usable`` and the seven score columns to a verdict table (narrow, no shuffle).

    Staged projections, each reading the previous stage's columns, so nothing is
    evaluated twice and every stage compiles into whole-stage code:
      1. regex-extract each block and parse it once into MAP<STRING, VARIANT>;
      2. ``usable`` comes out of a one-row ``inline`` generator: a later
         ``filter(usable)`` cannot be pushed below it, so the parse runs once per
         verdict, and everything above it runs on usable verdicts only;
      3. per criterion and block: the variant value, its type name, the coerced value
         (higher-order functions only for list / object values), the normalised value;
      4. E1 weights (1, or 2 and 1 in round 2) and the E2 final score.
    ``clamp=True`` caps normalised 1-5 criteria at 1 (off by default, as in the reference).
    """
    resp, rnd = F.col(response_col), F.col(round_col)
    is_two = rnd == F.lit(2)
    # re-scoring a scored table replaces its score columns
    verdicts = verdicts.drop(*[c for c in ["usable", "reject_reason", *SCORE_COLS] if c in verdicts.columns])
    # each block is regex-extracted once (kept as a column: the parse and the reject
    # reason both read it), then parsed once
    t = verdicts.withColumns({
        "_x1": F.regexp_extract(resp, block_pattern("results1"), 1),
        "_x2": F.when(is_two, F.regexp_extract(resp, block_pattern("results2"), 1)),
    })
    t = t.withColumns({
        "_o1": as_object(F.try_parse_json(F.nullif(F.col("_x1"), F.lit("")))),
        "_o2": as_object(F.try_parse_json(F.nullif(F.col("_x2"), F.lit("")))),
    })
    ok1 = F.coalesce(F.size(F.col("_o1")) > 0, F.lit(False))
    ok2 = F.coalesce(F.size(F.col("_o2")) > 0, F.lit(False))
    usable = F.when(rnd.isin(0, 1), ok1).when(is_two, ok1 & ok2).otherwise(F.lit(False))
    reason = F.when(~F.coalesce(rnd.isin(0, 1, 2), F.lit(False)), F.lit("unsupported_round"))
    for b, cond in ((1, F.lit(True)), (2, is_two)):
        x, o = F.col(f"_x{b}"), F.col(f"_o{b}")
        reason = (reason.when(cond & (x == ""), F.lit(f"no_block{b}"))
                  .when(cond & o.isNull(), F.lit(f"bad_json{b}"))
                  .when(cond & (F.size(o) == 0), F.lit(f"empty_block{b}")))
    t = t.select("*", F.inline(F.array(F.struct(usable.alias("usable"), reason.alias("reject_reason")))))
    blocks = (1, 2)
    rq = f"`{round_col}`"
    stages = [
        {f"_v{b}{i}": f"element_at(_o{b}, '{k}')" for b in blocks for i, k in enumerate(CRITERIA_KEYS)},
        {f"_t{b}{i}": f"schema_of_variant(_v{b}{i})" for b in blocks for i in range(6)},
        # numbers are read in compiled code; only list / object values need the
        # higher-order functions (evaluated interpreted), in their own stage
        {f"_s{b}{i}": sql_scalar_score(f"_v{b}{i}", f"_t{b}{i}") for b in blocks for i in range(6)},
        {f"_c{b}{i}": sql_is_container(f"_t{b}{i}") for b in blocks for i in range(6)},
        {f"_r{b}{i}": f"CASE WHEN _s{b}{i} IS NOT NULL THEN _s{b}{i} WHEN _c{b}{i} THEN "
                      f"{sql_container_score(f'_v{b}{i}', f'_t{b}{i}')} ELSE 0.0 END"
         for b in blocks for i in range(6)},
        {f"_n{b}{i}": sql_normalise_one(i, f"_r{b}{i}", f"_r{b}0", clamp) for b in blocks for i in range(6)},
        {f"_w{i}": f"CASE WHEN usable THEN (CASE WHEN {rq} = 2 THEN ((_n1{i} * 2.0) + (_n2{i} * 1.0)) / 3.0 "
                   f"ELSE _n1{i} END) END" for i in range(6)},
        {c: sql_round4(f"_w{i}") for i, c in enumerate(CRITERIA)},
        {"_w6": "(" + " + ".join(CRITERIA) + ") / 6.0"},
        {"final_score": sql_round4("_w6")},
    ]
    # one select: later expressions refer to earlier aliases (lateral column aliases), which
    # Spark resolves into a chain of projections - one analysis instead of one per stage
    t = t.selectExpr("*", *[f"{e} AS {k}" for stage in stages for k, e in stage.items()])
    tmp = [k for stage in stages for k in stage if k.startswith("_")]
    return t.drop("_x1", "_x2", "_o1", "_o2", *tmp)


def number_judges(scored: DataFrame, answer_keys: list[str], judge_pos: str = "judge_pos") -> DataFrame:
    """H2: keep usable verdicts and number them 1.. per answer in configured judge order.

    A judge whose verdict is unusable shifts later judges down, so ``judge_key`` is only
    for export; identity stays with ``judge_pos``/``judge_name``.  The window is
    partitioned by the answer key, which holds at most one row per configured judge."""
    w = Window.partitionBy(*answer_keys).orderBy(F.col(judge_pos))
    return (scored.filter(F.col("usable"))
            .withColumn("judge_num", F.row_number().over(w))
            .withColumn("judge_key", F.concat(F.lit("Judge "), F.col("judge_num").cast("string"))))


__all__ = ["score_verdicts", "number_judges", "CRITERIA", "SCORE_COLS"]
