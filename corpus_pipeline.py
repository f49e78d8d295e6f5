"""From raw documents to token ids, in five stages; each is one training-data operator put to work.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; what it returns is written as Parquet and
read again as the next stage's documents.  All but the last return the columns of ``documents``.

Every stage takes nulls in any column, empty and very long texts, ties and repeated rows, empty tables and
further columns of any name; each says below what becomes of them.  Further columns stay as they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scorewright.llm import bpe, mixing, near_dup, secret_scan, spans, toxicity
from scorewright.session import materialize


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score as toxic go.  Null and empty texts score like texts without a window and stay; repeated rows
    share their fate; without labels of both kinds everything stays; an empty table stays empty."""
    spans.prepare(spark)
    return toxicity.keep_clean(docs, toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-copies, on shingles of five words at 0.8, the document of least doc_id stays.
    Texts without words, null ones included, and rows with a null doc_id are no copies and stay; of repeated rows of one
    doc_id one stays (the least text); an empty table stays empty."""
    spans.prepare(spark)
    return near_dup.keep_one(docs, near_dup.classes(docs, words=5, percent=80))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced in the texts, and n_chars counts the new text.  Null and empty texts, null ids and repeated rows
    stay as they are; an empty table stays empty."""
    spans.prepare(spark)
    return secret_scan.redact(docs, secret_scan.fit(docs))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target takes it, none to three times.  Null sources
    are a source of their own; texts without words, null ones included, add nothing to a budget and are not taken; repeated
    rows are separate texts; an empty table stays empty."""
    spans.prepare(spark)
    return mixing.repeat_rows(docs, mixing.mix(docs))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids, with the digest of the text that they decode to.  Null and empty texts have no ids and an empty decoded
    text; null ids and repeated rows come once for each row; an empty table gives an empty one."""
    spans.prepare(spark)
    return bpe.round_trip(docs).select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [("toxicity", drop_toxic), ("near_dedup", drop_near_copies), ("secrets", redact_secrets), ("mixing", mix_sources), ("bpe", encode)]
#: Trained models, sampled signatures and a tokenizer stand behind the rows: SQL has no equal.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
