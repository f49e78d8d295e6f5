"""Judged entries -> model results.

Inputs
  judged:  one row per (file_id, ordinal, judge_key) with judge_name and the seven scores
           (NULL = missing / empty score set).  ``judge_key`` is ``Judge <n>`` or ``Jury``.
  entries: one row per (file_id, ordinal) with task and the model metadata columns.
  scored:  verdicts of the configured judges, usable or not, by entry and ``judge_pos``.

Plan shape: the score rows meet their entry in one grouping (one exchange by entry; a group holds
the configured judges and one entry row), which leaves one packed row per entry: task, metadata and
an array of judge structs.  Renumbering (H2), the jury (E3-E5) and the complete-case test (C6) are
row expressions over that array.  The packed table is written once.  Criterion averages, task
averages and entry counts come from one grouping-sets aggregate over it, partial before the
shuffle; rosters, first entries and names from one aggregate per file.  The expected judges are a
scalar subquery: nothing is collected, and an empty intersection fails the job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scorewright.functions.scores import CRITERION_LABELS, SCORE_COLS, round4
from scorewright.operators.jury import STRATEGIES

JURY = "Jury"
ENTRY = ["file_id", "ordinal"]
META_COLS = ["model_name", "license", "revision", "precision", "params"]
JUDGE = ("struct<judge_key:string,judge_name:string,ok:boolean,"
         + ",".join(f"{c}:double" for c in SCORE_COLS) + ">")


def _complete() -> Column:
    """All seven scores present (no NULL, non-empty)."""
    c = F.lit(True)
    for s in SCORE_COLS:
        c = c & F.col(s).isNotNull()
    return c


# ----------------------------------------------------------------- one packed row per entry


def _pack(rows: DataFrame, element: Column, entries: DataFrame) -> DataFrame:
    """(entry, element) rows and the entry rows in one grouping: (file_id, ordinal, task, _meta, _found)."""
    meta = F.struct(*[F.col(c) for c in META_COLS if c in entries.columns] or [F.lit(None).cast("string").alias("model_name")])
    task = F.col("task") if "task" in entries.columns else F.lit(None)
    facts = entries.select(*ENTRY, F.struct(task.cast("string").alias("task"), meta.alias("meta")).alias("_e"))
    both = rows.select(*ENTRY, element.alias("_j")).unionByName(facts, allowMissingColumns=True)
    packed = both.groupBy(*ENTRY).agg(F.collect_list("_j").alias("_found"), F.max("_e").alias("_e"))
    return packed.select(*ENTRY, F.col("_e.task").alias("task"), F.col("_e.meta").alias("_meta"), "_found")


def pack_judged(judged: DataFrame, entries: DataFrame) -> DataFrame:
    """Judged rows -> (file_id, ordinal, task, _meta, judges): one row per entry with the array of its judge
    structs, the jury's included.  Several rows of one judge key keep the greatest of them."""
    ok = F.col("score_ok") if "score_ok" in judged.columns else _complete()
    one = F.struct("judge_key", "judge_name", ok.alias("ok"), *SCORE_COLS).cast(JUDGE)
    packed = _pack(judged, one, entries)
    ordered = F.array_sort("_found")
    last = F.filter(ordered, lambda j, i: ~F.coalesce(j["judge_key"] == F.get(ordered, i + 1)["judge_key"], F.lit(False)))
    return packed.withColumn("judges", last).drop("_found")


def pack_verdicts(scored: DataFrame, entries: DataFrame, strategy: str, n_configured: int) -> DataFrame:
    """Scored verdicts -> the same packed rows: usable judges renumbered in configured order (H2) and, with two
    or more configured judges, the jury by ``strategy`` (E3, E4, E5), all inside one entry's array."""
    if n_configured >= 2 and strategy not in STRATEGIES:
        raise ValueError(f"unknown jury strategy: {strategy!r}")
    one = F.when(F.col("usable"), F.struct("judge_pos", "judge_name", *SCORE_COLS))
    packed = _pack(scored, one, entries).withColumn("_u", F.array_sort("_found"))
    named = ", ".join(f"'{c}', v.{c}" for c in SCORE_COLS)
    complete = " AND ".join(f"v.{c} IS NOT NULL" for c in SCORE_COLS)
    judges = (f"transform(_u, (v, i) -> named_struct('judge_key', concat('Judge ', i + 1), 'judge_name', v.judge_name, "
              f"'ok', {complete}, {named}))")
    if n_configured >= 2:
        judges = f"concat({judges}, array({_jury(strategy)}))"
    return packed.withColumn("judges", F.expr(judges).cast(f"array<{JUDGE}>")).drop("_found", "_u")


def _jury(strategy: str) -> str:
    """The jury struct over the usable verdicts ``_u``: the mean of all, or of those that voted Correct = 1 when they
    are more than those with Correct = 0, else zeros; NULL scores when no verdict is usable."""
    voters = "filter(_u, v -> v.correct = 1)" if strategy == "vote" else "_u"
    zero = ", ".join(f"'{c}', 0D" for c in SCORE_COLS)
    add = ", ".join(f"'{c}', a.{c} + v.{c}" for c in SCORE_COLS)
    mean = ", ".join(f"'{c}', a.{c} / size({voters})" for c in SCORE_COLS)
    none = ", ".join(f"'{c}', CAST(NULL AS DOUBLE)" for c in SCORE_COLS)
    kind = "'judge_key', 'Jury', 'judge_name', 'Jury', 'ok'"
    won = f"size({voters}) > size(filter(_u, v -> v.correct = 0))" if strategy == "vote" else "true"
    return (f"CASE WHEN size(_u) = 0 THEN named_struct({kind}, false, {none}) "
            f"WHEN {won} THEN aggregate({voters}, named_struct({zero}), (a, v) -> named_struct({add}), "
            f"a -> named_struct({kind}, true, {mean})) "
            f"ELSE named_struct({kind}, true, {zero}) END")


# ----------------------------------------------------------------- rosters


def file_summary(packed: DataFrame) -> DataFrame:
    """Per file: ``roster`` (E13: the judge keys of the first entry that has any ``Judge <n>`` key; NULL without
    one), the metadata of the first entry and ``names``, the judge names it gives (E10)."""
    keys = F.array_sort(F.transform("judges", lambda j: j["judge_key"]))
    judged = F.exists("judges", lambda j: j["judge_key"].startswith("Judge "))
    names = F.map_from_entries(F.transform("judges", lambda j: F.struct(j["judge_key"], j["judge_name"])))
    return (packed.select("file_id", "ordinal", "_meta", keys.alias("_k"), judged.alias("_has"), names.alias("_n"))
            .groupBy("file_id").agg(
                F.min_by("_k", F.when(F.col("_has"), F.col("ordinal"))).alias("roster"),
                F.min("ordinal").alias("first_ordinal"),
                F.min_by(F.struct("_meta", "_n"), "ordinal").alias("_f"))
            .select("file_id", "roster", "first_ordinal", F.col("_f._meta").alias("_meta"), F.col("_f._n").alias("names")))


def judge_rosters(files: DataFrame) -> DataFrame:
    """E13 as rows (file_id, judge_key)."""
    return files.select("file_id", F.explode("roster").alias("judge_key"))


def common_keys(files: DataFrame) -> DataFrame:
    """G1 + E14: one row, ``common``: the judge keys that every roster holds, judges in order, the jury last.
    Rosters are few (numbered judges), so their distinct ones are gathered and intersected in one aggregate."""
    rosters = files.agg(F.collect_set("roster").alias("_r"))
    common = F.aggregate("_r", F.get("_r", 0), lambda a, r: F.array_intersect(a, r))
    return rosters.select(F.coalesce(F.concat(F.filter(F.array_sort(common), lambda k: k != JURY),
                                              F.filter(common, lambda k: k == JURY)), F.array().cast("array<string>")).alias("common"))


def common_judges(files: DataFrame) -> DataFrame:
    """G1 + E14 as rows (judge_key); none when the rosters share nothing."""
    return common_keys(files).select(F.explode("common").alias("judge_key"))


def jury_everywhere(files: DataFrame) -> DataFrame:
    """One row: whether every file's roster holds the jury (1) or not (0), and the files with a roster."""
    has = F.array_contains("roster", JURY).cast("int")
    return files.agg(F.coalesce(F.min(has), F.lit(0)).alias("jury_everywhere"),
                     F.count("roster").cast("bigint").alias("n_files"))


def _checked(common: Column) -> Column:
    judges = F.size(F.filter(common, lambda k: k != JURY))
    return F.when(judges == 0, F.raise_error(F.lit("no common judges across judged files"))).otherwise(common)


def expected_keys(files: DataFrame) -> Column:
    """The judge keys every entry must have, as a scalar subquery; the job fails when no judge is common to all."""
    return common_keys(files).select(_checked(F.col("common"))).scalar()


def expected_judges(files: DataFrame) -> list[str]:
    """The same list on the driver (at most the configured judges and the jury)."""
    keys = common_keys(files).first()["common"]
    if not any(k != JURY for k in keys):
        raise ValueError("no common judges across judged files")
    return keys


# ----------------------------------------------------------------- averages


def flag_valid(packed: DataFrame, expected: Column) -> DataFrame:
    """``_valid`` where every expected judge has a complete score set (Q11: one missing judge fails the entry
    for all judges).  A row expression: no exchange."""
    p = packed.withColumn("_x", expected)
    good = F.transform(F.filter("judges", lambda j: j["ok"]), lambda j: j["judge_key"])
    return p.withColumn("_valid", F.size(F.array_intersect(F.col("_x"), good)) == F.size("_x"))


def averages(flagged: DataFrame) -> DataFrame:
    """E6, E7 and E8 from one grouping-sets aggregate over (entry, expected judge) rows.

    ``_set`` 1: per (file, judge) the means of the six criteria and the final score over valid entries (a missing
    one counts as 0; NULL without a valid entry), the entries and the valid ones.  ``_set`` 0: per (file, judge,
    task) the mean final score of valid entries."""
    found = F.transform("_x", lambda k: F.struct(k.alias("judge_key"), F.get(F.filter("judges", lambda j: j["judge_key"] == k), F.lit(0)).alias("_j")))
    rows = (flagged.select("file_id", "task", "_valid", F.posexplode(found).alias("_pos", "_r"))
            .select("file_id", "task", "_valid", "_pos", F.col("_r.judge_key").alias("judge_key"),
                    *[F.when(F.col("_valid"), F.col(f"_r._j.{c}")).alias(c) for c in SCORE_COLS]))
    means = [round4(F.avg(F.when(F.col("_valid"), F.coalesce(F.col(c), F.lit(0.0))))).alias(c) for c in SCORE_COLS]
    return rows.groupingSets([("file_id", "judge_key"), ("file_id", "judge_key", "task")], "file_id", "judge_key", "task").agg(
        F.grouping("task").alias("_set"), F.min("_pos").alias("_pos"), *means,
        round4(F.avg("final_score")).alias("score"),
        F.count(F.lit(1)).cast("bigint").alias("total_entries"),
        F.count_if("_valid").cast("bigint").alias("successful_entries"))


def packed_results(packed: DataFrame, strategy: str | None = None) -> dict[str, DataFrame]:
    """The averaging step over packed entries (a written table): ``wide``, ``criteria`` (long), ``tasks``, ``counts``
    and ``meta``, keyed by file_id and, where relevant, judge display name."""
    files = file_summary(packed)
    agg = averages(flag_valid(packed, expected_keys(files)))
    names = files.select("file_id", "names")
    # The name in the file's first entry; the key itself when that entry lacks it; the jury is always ``Jury``
    name = F.when(F.col("judge_key") == JURY, F.lit(JURY)).otherwise(
        F.coalesce(F.try_element_at("names", F.col("judge_key")), F.col("judge_key")))
    named = agg.join(names, "file_id").withColumn("judge_name", name)
    wide = named.filter("_set = 1").select("file_id", "judge_key", "judge_name", *SCORE_COLS)
    tasks = (named.filter((F.col("_set") == 0) & F.col("task").isNotNull() & (F.col("task") != "") & F.col("score").isNotNull())
             .select("file_id", "judge_key", "judge_name", "task", "score"))
    counts = agg.filter("_set = 1 AND _pos = 0").select(
        "file_id", "total_entries", "successful_entries",
        (F.col("total_entries") - F.col("successful_entries")).alias("failed_entries"),
        round4(F.col("successful_entries") / F.col("total_entries")).alias("success_ratio"))
    meta = files.select("file_id", "first_ordinal", "_meta.*").join(counts, "file_id")
    crit = unpivot_criteria(wide, ["file_id", "judge_key", "judge_name"])
    if strategy is not None:
        crit, tasks, meta = (d.withColumn("strategy", F.lit(strategy)) for d in (crit, tasks, meta))
    return {"criteria": crit, "wide": wide, "tasks": tasks, "counts": counts, "meta": meta}


def model_results(judged: DataFrame, entries: DataFrame, strategy: str | None = None) -> dict[str, DataFrame]:
    """The whole averaging step on judged rows; the packed entries are written once (``materialize``)."""
    from scorewright.session import materialize
    return packed_results(materialize(pack_judged(judged, entries), "judged_entries"), strategy)


def unpivot_criteria(wide: DataFrame, keep: list[str]) -> DataFrame:
    """Wide criterion columns -> (criterion label (D22), score) rows."""
    return wide.unpivot(keep, SCORE_COLS, "criterion_col", "score").select(
        *keep, F.create_map(*[x for k, v in CRITERION_LABELS.items() for x in (F.lit(k), F.lit(v))])
        [F.col("criterion_col")].alias("criterion"), "score")


# ----------------------------------------------------------------- result tables


def upsert_results(old: DataFrame, new: DataFrame, key: list[str], generation: str = "generation") -> DataFrame:
    """F8 / H3: replace rows of ``old`` by ``new`` on ``key``, keep the rest; among several
    rows of one key the highest ``generation`` (later file) wins.  Parity key is
    ``["model_name"]``; the safer key adds revision and precision."""
    both = old.withColumn("_src", F.lit(0)).unionByName(new.withColumn("_src", F.lit(1)), allowMissingColumns=True)
    # equal generations: the last file name, as a later file replaces an earlier one
    ties = [c for c in (generation, "src_file", "file_name", "file_id") if c in both.columns]
    order = [F.col("_src").desc(), *(F.col(c).desc() for c in ties)]
    w = Window.partitionBy(*key).orderBy(*order)
    return both.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn", "_src")


def union_results(frames: list[DataFrame]) -> DataFrame:
    """concatenate result tables with different column sets."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def _sorted_entries(items, key_field: str):
    """Sort an array of structs by one string field (ordering of whole structs with maps
    inside is not defined)."""
    return F.array_sort(items, lambda l, r: F.when(l[key_field] < r[key_field], -1)
                        .when(l[key_field] > r[key_field], 1).otherwise(0))


def assemble_results(wide: DataFrame, tasks: DataFrame, meta: DataFrame) -> DataFrame:
    """Nested, JSON-ready results: one row per file with one struct per judge
    (criterion averages + task map) and the metadata struct.  The maps are built by
    grouped aggregation over (file, judge) and (file) groups whose size is bounded by
    the number of tasks and judges, never by the number of entries.  Two judge keys with
    one display name collide like dict keys do (last key wins, Q6)."""
    tmap = (tasks.groupBy("file_id", "judge_name")
            .agg(F.map_from_entries(_sorted_entries(F.collect_list(F.struct("task", "score")), "task"))
                 .alias("tasks_scores")))
    per_judge = (wide.join(tmap, ["file_id", "judge_name"], "left")
                 .select("file_id", "judge_key", "judge_name",
                         F.struct(F.struct(*[F.col(c).alias(CRITERION_LABELS[c]) for c in SCORE_COLS]).alias("3C3H Scores"),
                                  F.coalesce(F.col("tasks_scores"), F.create_map().cast("map<string,double>"))
                                  .alias("Tasks Scores")).alias("v")))
    entries = F.collect_list(F.struct(F.col("judge_key").alias("k"),
                                      F.concat(F.col("judge_name"), F.lit(" Scores")).alias("name"), F.col("v")))
    judges = (per_judge.groupBy("file_id")
              .agg(F.map_from_entries(F.transform(_sorted_entries(entries, "k"),
                                                  lambda e: F.struct(e["name"], e["v"]))).alias("judges")))
    return meta.join(judges, "file_id", "left")
