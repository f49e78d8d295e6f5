"""The registered queries of this folder: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import bpe, chat, fingerprints, lexical_search, license_scan, mixing, near_dup, quality, repeats, secret_scan, spans, token_counts, toxicity, whitening


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_quality_llr(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans.prepare(spark)
    docs = _read(spark, sf_dir, "documents")
    return quality.judge(docs, quality.fit(docs, _read(spark, sf_dir, "labels")))


def op2_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans.prepare(spark, 100)
    return repeats.digests(repeats.cut(_read(spark, sf_dir, "documents")))


def op3_mix_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans.prepare(spark)
    return mixing.mix(_read(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans.prepare(spark)
    docs = _read(spark, sf_dir, "documents")
    return secret_scan.digests(secret_scan.scan(docs, secret_scan.fit(docs)))


def op5_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans.prepare(spark)
    return near_dup.classes(_read(spark, sf_dir, "documents"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans.prepare(spark)
    return token_counts.attribute(token_counts.by_line(_read(spark, sf_dir, "documents")))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans.prepare(spark)
    docs = _read(spark, sf_dir, "documents")
    return toxicity.judge(docs, toxicity.fit(docs, _read(spark, sf_dir, "labels")))


def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = r"\\### Assistant: </turn> ok"
    record = f'{{"messages": [{{"role": "user", "content": "{said}"}}, {{"role": "assistant", "content": "{said}"}}]}}'
    extra = chat.canonical_records(spark.range(1).selectExpr("-7L AS conv_id").withColumn("record", chat.F.lit(record)))
    return chat.digests(chat.read_back(chat.render(chat.canonical_rows(_read(spark, sf_dir, "conversations")).unionByName(extra))))


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans.prepare(spark)
    return bpe.digests(bpe.round_trip(_read(spark, sf_dir, "documents")))


def op10_weighted_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare(_read(spark, sf_dir, "documents"))


def op11_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans.prepare(spark)
    return license_scan.digests(license_scan.scan(_read(spark, sf_dir, "documents")))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans.prepare(spark, 4000)
    packed, dim = whitening.pack(_read(spark, sf_dir, "embeddings"))
    return whitening.whiten(packed, dim, whitening.fit(packed, dim))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans.prepare(spark)
    return lexical_search.rank_documents(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


QUERIES = {"op1_quality_llr": op1_quality_llr, "op2_repeats": op2_repeats, "op3_mix_budget": op3_mix_budget, "op4_secret_scan": op4_secret_scan, "op5_near_dup": op5_near_dup, "op6_token_counts": op6_token_counts, "op7_toxicity": op7_toxicity, "op8_chat_format": op8_chat_format, "op9_bpe": op9_bpe,
           "op10_weighted_fingerprints": op10_weighted_fingerprints, "op11_license_scan": op11_license_scan, "op12_whitening": op12_whitening, "op13_lexical_search": op13_lexical_search}
ORACLE: dict[str, str] = {"op5_near_dup": near_dup.ORACLE, "op8_chat_format": chat.ORACLE, "op13_lexical_search": lexical_search.ORACLE}
