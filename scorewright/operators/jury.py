"""Judges and jury.

The jury is one hash aggregate keyed by the answer: partial aggregation runs before
the shuffle and every answer holds at most one row per configured judge, so the
shuffle carries a handful of rows per answer and no key can be hot.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorewright.functions.scores import SCORE_COLS

STRATEGIES = ("average", "vote")


def resolve_strategy(judges: list[str], strategy: str) -> str:
    """One judge -> ``SingleJudge``; otherwise ``average`` or ``vote`` in any
    letter case; anything else is an error."""
    if len(judges) == 1:
        return "SingleJudge"
    if strategy.strip().lower() not in STRATEGIES:
        raise ValueError(f"unknown jury strategy: {strategy!r}")
    return strategy.strip().lower()


def parse_judges(arg: str) -> list[str]:
    """D24 (driver side): comma separated judge names, stripped and lower-cased."""
    return [p.strip().lower() for p in arg.split(",") if p.strip()]


def expand_judges(answers: DataFrame, judges: list[str], aliases: dict[str, str] | None = None) -> DataFrame:
    """every answer x every configured judge, with the configured position (1-based).

    The judge list is a caller argument of bounded size, so it is inlined as a literal
    array and exploded: a generator, no join and no shuffle.  ``judge_name`` is the
    configured name, ``judge_model`` the full model id (D26) that the call is made with."""
    aliases = aliases or {}
    arr = F.array(*[F.struct(F.lit(i + 1).alias("judge_pos"), F.lit(j).alias("judge_short"),
                             F.lit(j).alias("judge_name"), F.lit(aliases.get(j, j)).alias("judge_model"))
                    for i, j in enumerate(judges)])
    return answers.withColumn("_j", F.explode(arr)).select("*", "_j.*").drop("_j")


def judge_alias(name: Column, aliases: dict[str, str]) -> Column:
    """Short judge name -> full model id; identity when not listed."""
    if not aliases:
        return name
    m = F.create_map(*[x for k, v in aliases.items() for x in (F.lit(k), F.lit(v))])
    return F.coalesce(F.element_at(m, name), name)


def jury_scores(scored: DataFrame, answer_keys: list[str], strategy: str) -> DataFrame:
    """Combine the usable verdicts of each answer.

    ``average``: mean over usable judges of the six criteria and the final score (no rounding).
    ``vote``: when more judges gave Correct = 1 than Correct = 0, the mean over the judges
    with Correct = 1; otherwise all zero (a tie is zero; fractional Correct values vote for
    neither side).  An answer without any usable verdict gets NULL scores (empty jury).
    Input rows are all verdicts (usable or not) so one aggregate, no join, covers every answer.
    """
    if strategy not in STRATEGIES:
        raise ValueError(f"unknown jury strategy: {strategy!r}")
    usable = F.col("usable")
    aggs = [F.count_if(usable).cast("bigint").alias("n_usable")]
    if strategy == "average":
        aggs += [F.avg(F.when(usable, F.col(c))).alias(c) for c in SCORE_COLS]
        out = scored.groupBy(*answer_keys).agg(*aggs)
    else:
        yes = usable & (F.col("correct") == 1)
        no = usable & (F.col("correct") == 0)
        aggs += [F.count_if(yes).alias("_yes"), F.count_if(no).alias("_no")]
        aggs += [F.avg(F.when(yes, F.col(c))).alias("_" + c) for c in SCORE_COLS]
        out = scored.groupBy(*answer_keys).agg(*aggs)
        won = F.col("_yes") > F.col("_no")
        out = out.withColumns({c: F.when(F.col("n_usable") > 0,
                                         F.when(won, F.col("_" + c)).otherwise(F.lit(0.0)))
                               for c in SCORE_COLS})
        out = out.drop("_yes", "_no", *["_" + c for c in SCORE_COLS])
    return out.withColumn("strategy", F.lit(strategy))


def jury_rows(scored: DataFrame, answer_keys: list[str], strategy: str, n_configured: int) -> DataFrame:
    """E5: the jury only exists with two or more *configured* judges; shaped like judge rows
    (``judge_key = 'Jury'``) so results can average it with the judges."""
    if n_configured < 2:
        return None
    j = jury_scores(scored, answer_keys, strategy)
    return j.withColumns({"judge_key": F.lit("Jury"), "judge_name": F.lit("Jury")})
