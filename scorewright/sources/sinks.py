"""Writers (B1-B6).

Tables are written as Parquet through Spark's commit protocol (a failed or retried
task never leaves partial output).  JSON exports are JSON-lines, one document per
line; nothing is gathered on the driver.  Status tables are never read and
overwritten in place: every write goes to a new version directory.
"""

from __future__ import annotations

import time
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType, StructType

from scorewright.functions.scores import CRITERION_LABELS, SCORE_COLS
from scorewright.session import discard, materialize

MODEL_KEYS = ["task_set", "org", "model_name", "revision", "precision"]
#: What names one entry of a file, in order of preference.
ITEM_KEYS = ("item_id", "ordinal", "sn")
#: Partitions up to which an upsert names them in the filter; beyond, a semi-join finds them.
NAMED_PARTITIONS = 1000


def read_table(spark: SparkSession, path: str, like: StructType, partition_by: list[str]) -> DataFrame | None:
    """A partitioned Parquet table with the partition columns' types taken from ``like`` (folder names alone would
    turn "7" into a number); None when there is none."""
    try:
        found = spark.read.parquet(path).schema
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None
    own = [f for f in found.fields if f.name not in partition_by]
    return spark.read.schema(StructType(own + [like[k] for k in partition_by])).parquet(path)


def upsert_partitions(new: DataFrame, path: str, keys: list[str], partition_by: list[str],
                      order: list[str] | None = None) -> None:
    """F8 on a partitioned table: rows of ``path`` whose ``keys`` appear in ``new`` are replaced, the others stay.

    With ``order`` the row with the greatest order columns stays, old or new, one per key: applying rows again, or
    in another order, gives the same table.  Without it all new rows of a key come in place of all old ones.  Only
    the partitions that ``new`` meets are read and rewritten; the merged rows go to a staging table first, so no
    folder is read while it is overwritten, and a run that died is simply run again.  NULL is a key like others."""
    spark = new.sparkSession
    staged = materialize(new.select(*[c for c in new.columns if c not in partition_by], *partition_by), "upsert-new")
    old = read_table(spark, path, staged.schema, partition_by)
    merged = None
    if old is not None:
        parts = staged.select(*partition_by).distinct()
        named = parts.limit(NAMED_PARTITIONS + 1).collect()
        if len(named) <= NAMED_PARTITIONS:
            met = F.lit(False)
            for r in named:
                here = F.lit(True)
                for k in partition_by:
                    here = here & F.col(k).eqNullSafe(F.lit(r[k]))
                met = met | here
            old = old.filter(met)
        else:
            old = _matching(old, parts, partition_by, "left_semi")
        if order is None:
            merged = _matching(old, staged.select(*keys).distinct(), keys, "left_anti").unionByName(staged, allowMissingColumns=True)
        else:
            merged = old.unionByName(staged, allowMissingColumns=True)
    if order is not None:
        # equal order columns: the greatest of the other plain columns, so never by chance
        rest = [f.name for f in (staged if merged is None else merged).schema.fields if f.name not in {*keys, *order} and isinstance(f.dataType, AtomicType)]
        w = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in [*order, *rest]])
        merged = (staged if merged is None else merged).withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")
    table = staged if merged is None else materialize(merged, "upsert-merged")
    table.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path)
    for t in {id(staged): staged, id(table): table}.values():
        discard(t)


def _matching(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    same = [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in keys]
    return left.alias("l").join(right.alias("r"), same, how)


def write_answers(df: DataFrame, path: str, keys: list[str] | None = None) -> None:
    """B1: one partition per (task set, org, model, revision, precision); an entry answered again replaces its
    earlier answer, everything else stays.  Without an entry key the written partitions are replaced whole."""
    keys = [k for k in (keys or MODEL_KEYS) if k in df.columns]
    item = [k for k in ITEM_KEYS if k in df.columns][:1]
    if item:
        upsert_partitions(df, path, keys + item, keys)
    else:
        df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(path)


def write_judged(df: DataFrame, path: str, keys: tuple[str, ...] = ("task_set", "model_key")) -> None:
    """B2: answers + verdicts + scores, batch by batch (a crash keeps earlier batches); a batch written again
    replaces its rows (same file, entry and judge)."""
    parts = [k for k in keys if k in df.columns]
    item = [k for k in ITEM_KEYS if k in df.columns][:1]
    judge = [k for k in ("judge_key", "judge_name") if k in df.columns][:1]
    upsert_partitions(df, path, parts + item + judge, parts)


def write_results(df: DataFrame, path: str, strategy: str | None = None, keys: list[str] | None = None) -> None:
    """B3 + F8: result table by strategy (the file name of the reference carries it).  All rows of a model that was
    averaged again are replaced; the strategy's other models and the other strategies stay."""
    if strategy is not None:
        df = df.withColumn("strategy", F.lit(strategy))
    keys = keys or [k for k in ("file_id", "model_name") if k in df.columns][:1]
    if keys:
        upsert_partitions(df, path, ["strategy", *keys], ["strategy"])
    else:
        df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("strategy").parquet(path)


def results_json(assembled: DataFrame) -> DataFrame:
    """E11 -> one JSON document per model: ``{"<judge> Scores": {...}, "Meta": {...}}``."""
    meta = F.struct(
        F.col("model_name").alias("Model Name"), F.col("license").alias("License"),
        F.col("revision").alias("Revision"), F.col("precision").alias("Precision"),
        F.col("params").alias("Params"), F.col("total_entries").alias("Total Entries"),
        F.col("successful_entries").alias("Successful Entries"), F.col("failed_entries").alias("Failed Entries"),
        F.col("success_ratio").alias("Success Ratio"))
    judges = F.transform_values(F.col("judges"), lambda k, v: F.to_variant_object(v))
    doc = F.map_concat(F.coalesce(judges, F.create_map().cast("map<string,variant>")),
                       F.create_map(F.lit("Meta"), F.to_variant_object(meta)))
    return assembled.select(F.to_json(doc).alias("value"))


def export_json(docs: DataFrame, path: str) -> None:
    """Write a single-column ``value`` DataFrame of JSON texts as JSON lines."""
    docs.write.mode("overwrite").text(path)


def export_leaderboard(results: DataFrame, path: str) -> DataFrame:
    """Flat union of all results plus the sync time as a *column* (the reference appends
    a marker element to the list instead)."""
    out = results.withColumn("exported_at", F.current_timestamp())
    out.write.mode("overwrite").json(path)
    return out


def write_request_status(df: DataFrame, base: str, version: str | None = None) -> str:
    """Persist request statuses to a fresh version directory (atomic per version via the
    commit protocol; never read-and-overwrite the same path).  Returns the path written."""
    version = version or f"{time.strftime('%Y%m%dT%H%M%S')}-{uuid.uuid4().hex[:8]}"
    out = f"{base.rstrip('/')}/version={version}"
    df.write.mode("errorifexists").parquet(out)
    return out


def write_outcomes(df: DataFrame, path: str) -> None:
    """Success / failure model lists, partitioned by ``ok``."""
    df.write.mode("append").partitionBy("ok").parquet(path)


__all__ = ["upsert_partitions", "read_table", "write_answers", "write_judged", "write_results", "results_json", "export_json",
           "export_leaderboard", "write_request_status", "write_outcomes", "CRITERION_LABELS", "SCORE_COLS"]


# Document keys written back (column -> key), in document order.
META_KEYS = [("sn", "SN."), ("round", "Round"), ("task", "Task"), ("dataset", "Dataset"),
             ("category", "Category"), ("sub_category", "Sub-Category"), ("source", "Source"),
             ("fact_checking", "Fact Checking"), ("comment", "Comment"), ("model_name", "Model Name"),
             ("license", "License"), ("revision", "Revision"), ("precision", "Precision"), ("params", "Params")]
TEST_KEYS = [("q1", "Question 1"), ("a1", "Answer 1"), ("q2", "Question 2"), ("a2", "Answer 2")]
SCORE_KEYS = [("correct", "Correct"), ("complete", "Complete"), ("concise", "Concise"), ("helpful", "Helpful"),
              ("honest", "Honest"), ("harmless", "Harmless"), ("final_score", "Final Score")]


def _entry_struct(df: DataFrame) -> F.Column:
    meta = F.struct(*[F.col(c).alias(k) for c, k in META_KEYS if c in df.columns])
    test = F.struct(*[F.col(c).alias(k) for c, k in TEST_KEYS if c in df.columns])
    model = F.struct(F.col("m1").alias("Answer 1"),
                     *([F.col("m2").alias("Answer 2")] if "m2" in df.columns else []))
    return F.struct(meta.alias("Meta"), test.alias("Test"), model.alias("Model"))


def answers_json(answers: DataFrame) -> DataFrame:
    """B1 export: one answered entry per row as JSON text in the document shape
    (``Meta`` / ``Test`` / ``Model``); NULL fields are left out."""
    return answers.select(F.to_json(_entry_struct(answers)).alias("value"))


def judged_json(answers: DataFrame, judged: DataFrame, keys: list[str], strategy: str | None = None) -> DataFrame:
    """B2 export: answered entries plus one ``Judge <n>`` object per usable judge (name,
    comments, 3C3H Scores) and, with a strategy, the ``Jury`` object.  The judge objects
    of an entry are gathered by a grouped aggregate whose group is one entry (at most the
    configured judges), joined back on the entry key."""
    scores = F.struct(*[F.col(c).alias(k) for c, k in SCORE_KEYS])
    comments = F.col("response") if "response" in judged.columns else F.lit(None).cast("string")
    obj = F.when(F.col("judge_key") == "Jury",
                 F.to_variant_object(F.struct(F.lit(strategy).alias("Strategy"), scores.alias("3C3H Scores"))))
    obj = obj.otherwise(F.to_variant_object(F.struct(F.col("judge_name").alias("Judge Name"),
                                                     comments.alias("Judge Comments"),
                                                     scores.alias("3C3H Scores"))))
    per_entry = judged.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("judge_key", obj))).alias("_j"))
    joined = answers.join(per_entry, keys, "left")
    entry = F.to_variant_object(_entry_struct(joined))
    doc = F.map_concat(F.try_variant_get(entry, "$", "map<string,variant>"),
                       F.coalesce(F.col("_j"), F.create_map().cast("map<string,variant>")))
    return joined.select(F.to_json(doc).alias("value"))
