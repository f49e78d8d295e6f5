"""Readers for the evaluation's JSON documents.

Task, answer and judged files are JSON arrays of any size and are read entry by entry
(``json_arrays``).  Request manifests and results are small documents: they are read whole
(``wholetext``) and parsed with ``try_parse_json`` into a VARIANT; one that does not parse
yields NULL instead of failing the job.  What a reader leaves out is never silent: the
``rejected_*`` functions return it with a reason, and an ``Observation`` counts it.
Field names with dots or spaces are addressed with ``$['...']`` paths.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from scorewright.functions.scores import CRITERIA, CRITERIA_KEYS
from scorewright.sources.json_arrays import below, decoded, observed, read_array_entries

# The document keys read from a task entry, with the column they land in.
META_FIELDS = {
    "SN.": "sn", "Round": "round", "Task": "task", "Dataset": "dataset", "Category": "category",
    "Sub-Category": "sub_category", "Source": "source", "Fact Checking": "fact_checking",
    "Comment": "comment", "Language": "language",
}
TEST_FIELDS = {"Question 1": "q1", "Answer 1": "a1", "Question 2": "q2", "Answer 2": "a2"}
MODEL_META = {"Model Name": "model_name", "License": "license", "Revision": "revision",
              "Precision": "precision", "Params": "params"}
MODEL_FIELDS = {"Answer 1": "m1", "Answer 2": "m2"}
SCORE_KEYS = dict(zip(CRITERIA_KEYS + ["Final Score"], CRITERIA + ["final_score"]))


def _path(*keys: str) -> str:
    return "$" + "".join("['" + k.replace("'", "\\'") + "']" for k in keys)


def _str(v: Column, *keys: str) -> Column:
    """A string field; numbers are rendered as text, objects/arrays as JSON."""
    sub = F.try_variant_get(v, _path(*keys), "variant")
    t = F.schema_of_variant(sub)
    return (F.when(sub.isNull() | (t == "VOID"), F.lit(None).cast("string"))
            .when(t == "STRING", F.try_variant_get(sub, "$", "string"))
            .otherwise(F.to_json(sub)))


def _round(v: Column) -> Column:
    """C5 at read time: a missing Round is 0; null, text and fractions are NULL (unsupported)."""
    sub = F.try_variant_get(v, _path("Meta", "Round"), "variant")
    return (F.when(sub.isNull(), F.lit(0))
            .when(F.schema_of_variant(sub) == "VOID", F.lit(None).cast("int"))
            .when(_is_number(sub) & (F.try_variant_get(sub, "$", "double") == F.floor(F.try_variant_get(sub, "$", "double"))),
                  F.try_variant_get(sub, "$", "int")))


def _is_number(v: Column) -> Column:
    return F.coalesce(F.schema_of_variant(v).rlike(r"^(TINYINT|SMALLINT|INT|BIGINT|FLOAT|DOUBLE|DECIMAL.*|BOOLEAN)$"),
                      F.lit(False))


def read_documents(spark: SparkSession, path: str, glob: str | None = None, recursive: bool = False) -> DataFrame:
    """Every file under ``path`` as (src_file, src_name, doc VARIANT); ``doc`` is NULL when
    the file is not JSON."""
    reader = spark.read
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    df = reader.text(path, wholetext=True)
    return df.select(
        F.col("_metadata.file_path").alias("src_file"),
        F.col("_metadata.file_name").alias("src_name"),
        F.try_parse_json(F.col("value")).alias("doc"))


def bad_files(docs: DataFrame) -> DataFrame:
    """Side output: files that could not be parsed (skipped, never fatal)."""
    return docs.filter(F.col("doc").isNull()).select("src_file")


def _item_columns(e: Column) -> list[Column]:
    cols = [F.try_variant_get(e, _path("Meta", "SN."), "bigint").alias("sn"), _round(e).alias("round")]
    cols += [_str(e, "Meta", k).alias(c) for k, c in META_FIELDS.items() if c not in ("sn", "round")]
    cols += [_str(e, "Test", k).alias(c) for k, c in TEST_FIELDS.items()]
    return cols


def _folder(path: Column) -> Column:
    """The name of the folder a file lies in."""
    return F.regexp_extract(path, r"([^/]*)/[^/]*$", 1)


def read_items(spark: SparkSession, path: str, tally: Observation | None = None) -> DataFrame:
    """A1: task file(s) -> items (task_set = file name without ``.json``, ordinal kept)."""
    ents, _ = read_array_entries(spark, path, "*.json", tally=tally)
    return ents.select(
        F.regexp_replace("src_name", r"\.json$", "").alias("task_set"), "ordinal", *_item_columns(F.col("e")), "src_file")


def read_answers(spark: SparkSession, path: str, tally: Observation | None = None) -> DataFrame:
    """A2 + C8: every ``*_answers.json`` (judged files end otherwise) -> answers with the model metadata and
    m1 / m2.  task_set is the folder the file lies in, model_key the file name; ``params_b`` is the numeric form
    of Params when it is one."""
    ents, _ = read_array_entries(spark, path, "*_answers.json", tally=tally)
    e = F.col("e")
    params_sub = F.try_variant_get(e, _path("Meta", "Params"), "variant")
    return ents.select(
        _folder(decoded("src_file")).alias("task_set"),
        F.regexp_replace("src_name", r"_answers\.json$", "").alias("model_key"), "ordinal", *_item_columns(e),
        *[_str(e, "Meta", k).alias(c) for k, c in MODEL_META.items() if c != "params"],
        _str(e, "Meta", "Params").alias("params"), _str(e, "Meta", "Params").alias("params_raw"),
        F.when(_is_number(params_sub), F.try_variant_get(params_sub, "$", "double")).alias("params_b"),
        *[_str(e, "Model", k).alias(c) for k, c in MODEL_FIELDS.items()],
        "src_file")


def read_judged(spark: SparkSession, path: str, tally: Observation | None = None) -> tuple[DataFrame, DataFrame]:
    """A3: ``*_judged.json`` -> (judged, entries).  file_id is the file's path below ``path`` without its ending, so
    files of one name in two task sets stay apart.

    judged: one row per (file, entry, ``Judge <n>`` / ``Jury`` key) with judge_name and the
    seven scores (numeric -> double, anything else NULL) plus ``score_ok`` = the score set
    is non-empty and holds no JSON null (C6's test).  entries: one row per entry with task
    and model metadata.  The dynamic judge keys are found by exploding the entry as a map.
    """
    ents, _ = read_array_entries(spark, path, "*_judged.json", tally=tally)
    ents = ents.withColumn("file_id", F.regexp_replace(below("src_file", path), r"_answers_judged\.json$|_judged\.json$", ""))
    e = F.col("e")
    entries = ents.select(
        "file_id", "ordinal", _folder(decoded("src_file")).alias("task_set"), _str(e, "Meta", "Task").alias("task"),
        *[_str(e, "Meta", k).alias(c) for k, c in MODEL_META.items()])
    kv = ents.select("file_id", "ordinal",
                     _str(e, "Meta", "Task").alias("task"),
                     F.explode(F.try_variant_get(e, "$", "map<string,variant>")).alias("judge_key", "j"))
    kv = kv.filter(F.col("judge_key").startswith("Judge ") | (F.col("judge_key") == "Jury"))
    j = F.col("j")
    scores = F.try_variant_get(j, _path("3C3H Scores"), "map<string,variant>")
    kv = kv.withColumn("_s", scores)
    s = F.col("_s")
    score_cols = []
    for key, col in SCORE_KEYS.items():
        v = F.element_at(s, F.lit(key))
        score_cols.append(F.when(_is_number(v), F.try_variant_get(v, "$", "double")).alias(col))
    has_null = F.exists(F.map_values(s), lambda x: F.coalesce(F.schema_of_variant(x) == "VOID", F.lit(True)))
    judged = kv.select(
        "file_id", "ordinal", "task", "judge_key",
        F.coalesce(_str(j, "Judge Name"), F.when(F.col("judge_key") == "Jury", F.lit("Jury"))).alias("judge_name"),
        _str(j, "Strategy").alias("strategy"),
        *score_cols,
        (F.coalesce(F.size(s), F.lit(0)) > 0) & ~F.coalesce(has_null, F.lit(False)))
    judged = judged.withColumnRenamed(judged.columns[-1], "score_ok")
    return judged, entries


# The fields of a request manifest.
REQUEST_FIELDS = ["model_name", "license", "revision", "precision", "params", "status", "modality"]


def _manifests(spark: SparkSession, root: str) -> DataFrame:
    """Every manifest file with its fields and ``reason``, why it is left out (NULL: it is kept)."""
    docs = read_documents(spark, root, "*.json", recursive=True)
    pat = r"^([^/]+)/([^/]+)/([^/]+)/([^/]+\.json)$"
    p, d = below("src_file", root), F.col("doc")
    reason = (F.when(d.isNull(), F.lit("not JSON"))
              .when(F.try_variant_get(d, "$", "map<string,variant>").isNull(), F.lit("not an object"))
              .when(~p.rlike(pat), F.lit("not at <task set>/<bucket>/<org>/<file>")))
    return docs.select(
        *[F.regexp_extract(p, pat, i).alias(n) for i, n in enumerate(["task_set", "bucket", "org", "file"], 1)],
        *[_str(d, f).alias(f) for f in REQUEST_FIELDS], "src_file", reason.alias("reason"))


def read_requests(spark: SparkSession, root: str, tally: Observation | None = None) -> DataFrame:
    """A4: every request manifest under ``root`` (recursive); task_set, bucket, org and file come from the path
    ``<task_set>/<bucket>/<org>/<file>.json``.  Files elsewhere, or that are no JSON object, are in
    ``rejected_requests``; ``tally`` counts files read, kept and rejected."""
    found = _manifests(spark, root)
    found = found if tally is None else observed(found, tally)
    return found.filter(F.col("reason").isNull()).drop("reason")


def rejected_requests(spark: SparkSession, root: str) -> DataFrame:
    """The files under ``root`` that ``read_requests`` leaves out: (src_file, reason)."""
    return _manifests(spark, root).filter(F.col("reason").isNotNull()).select("src_file", "reason")


def _result_files(spark: SparkSession, path: str) -> DataFrame:
    """Result files in ``path`` and its folders, each as an array of results, with ``reason``, why one is left out."""
    docs = read_documents(spark, path, "*.json", recursive=True)
    d = F.col("doc")
    arr = F.try_variant_get(d, "$", "array<variant>")
    one = F.when(F.try_variant_get(d, "$", "map<string,variant>").isNotNull(), F.array(d))
    reason = (F.when(F.col("src_name") == "results.json", F.lit("an earlier aggregate"))
              .when(d.isNull(), F.lit("not JSON")).when(F.coalesce(arr, one).isNull(), F.lit("neither list nor object")))
    return docs.select("src_file", F.coalesce(arr, one).alias("_a"), reason.alias("reason"))


def rejected_results(spark: SparkSession, path: str) -> DataFrame:
    """The files that ``read_results`` leaves out: (src_file, reason)."""
    return _result_files(spark, path).filter(F.col("reason").isNotNull()).select("src_file", "reason")


def read_results(spark: SparkSession, path: str, tally: Observation | None = None) -> DataFrame:
    """A5 + C8: result files, nested folders included; a file is a list of results or one result object;
    ``results.json`` (an earlier aggregate), malformed and scalar files are in ``rejected_results``.  One row per result
    with its metadata columns and ``judges`` = MAP<judge display name, VARIANT scores>."""
    files = _result_files(spark, path)
    files = files if tally is None else observed(files, tally)
    rows = files.filter(F.col("reason").isNull()).select("src_file", F.posexplode("_a").alias("ordinal", "r"))
    r = F.col("r")
    m = F.try_variant_get(r, "$", "map<string,variant>")
    meta = {"Model Name": "model_name", "License": "license", "Revision": "revision", "Precision": "precision",
            "Params": "params", "Total Entries": "total_entries", "Successful Entries": "successful_entries",
            "Failed Entries": "failed_entries", "Success Ratio": "success_ratio"}
    cols = []
    for k, c in meta.items():
        if c in ("total_entries", "successful_entries", "failed_entries"):
            cols.append(F.try_variant_get(r, _path("Meta", k), "bigint").alias(c))
        elif c == "success_ratio":
            cols.append(F.try_variant_get(r, _path("Meta", k), "double").alias(c))
        else:
            cols.append(_str(r, "Meta", k).alias(c))
    judges = F.map_filter(m, lambda k, v: k.endswith(" Scores"))
    judges = F.transform_keys(judges, lambda k, v: F.regexp_replace(k, " Scores$", ""))
    return rows.filter(m.isNotNull()).select("src_file", "ordinal", *cols, judges.alias("judges"))


def result_criteria(results: DataFrame) -> DataFrame:
    """Results -> long (model_name, judge_name, criterion label, score)."""
    e = results.select("model_name", F.explode("judges").alias("judge_name", "v"))
    c = e.select("model_name", "judge_name",
                 F.explode(F.try_variant_get(F.col("v"), _path("3C3H Scores"), "map<string,variant>"))
                 .alias("criterion", "s"))
    return c.select("model_name", "judge_name", "criterion", F.try_variant_get("s", "$", "double").alias("score"))


def result_tasks(results: DataFrame) -> DataFrame:
    """Results -> long (model_name, judge_name, task, score)."""
    e = results.select("model_name", F.explode("judges").alias("judge_name", "v"))
    t = e.select("model_name", "judge_name",
                 F.explode(F.try_variant_get(F.col("v"), _path("Tasks Scores"), "map<string,variant>"))
                 .alias("task", "s"))
    return t.select("model_name", "judge_name", "task", F.try_variant_get("s", "$", "double").alias("score"))


def list_files(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """E9 input: a file listing (path, folder, size) from the ``binaryFile`` source.  Only
    ``path`` and ``length`` are selected, so file contents are never read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    df = reader.load(path).select("path", "length")
    return df.select("path", F.regexp_extract("path", r"^(.*)/[^/]+$", 1).alias("folder"),
                     F.col("length").alias("size"))


def land_answers(spark: SparkSession, src: str, dst: str) -> DataFrame:
    """Read answer documents (A2) once and write them as Parquet partitioned by task set and model key
    (B1 layout), so later jobs split, prune and push filters instead of re-parsing JSON files.  Files landed
    before and not in ``src`` stay.  Returns the landed table."""
    read_answers(spark, src).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("task_set", "model_key").parquet(dst)
    return spark.read.parquet(dst)


def land_judged(spark: SparkSession, src: str, dst: str) -> tuple[DataFrame, DataFrame]:
    """Read judged documents (A3) once and write the judged long table and the entry table
    as Parquet partitioned by file, for the averaging step to read.  Files landed before stay."""
    out = []
    for name, df in zip(("judged", "entries"), read_judged(spark, src), strict=True):
        where = f"{dst.rstrip('/')}/{name}"
        df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("file_id").parquet(where)
        out.append(spark.read.parquet(where))
    return out[0], out[1]
