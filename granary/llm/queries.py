"""The operators of this subpackage as queries over the given tables, with the SQL that checks them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from granary.llm import bpe, checks, chunks, codes, decontaminate, divergence, language, licenses, pii, quality, scoring, simhash, windows
from granary.llm.token_counts import token_counts
from granary.registry.base import Query, table
from granary.session import stage

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query and, where there is one, the SQL with the same result."""

    def register(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


@query("op3_token_counts")
def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return token_counts(table(spark, sf_dir, "documents"), path, limit=1024)


@query("op8_bpe_codec")
def op8_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return bpe.digests(bpe.encode(table(spark, sf_dir, "documents"), path))


@query("op10_license_scan")
def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.summary(licenses.scan(table(spark, sf_dir, "documents")))


@query("op5_decontaminate", checks.DECONTAMINATE)
def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, items = (table(spark, sf_dir, t) for t in ("documents", "benchmark"))
    return decontaminate.verdicts(decontaminate.scan(documents, items))


@query("op2_language_id")
def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    kept_out = language.held_out("doc_id")
    model = language.learn(documents.where(~kept_out & F.col("doc_id").isNotNull()))
    return language.predict(documents, model).withColumn("held_out", kept_out)


@query("op4_simhash")
def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query("op9_quality_rules")
def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "text")
    counted = stage(quality.text_counts(documents).drop("text"), "quality-counts")
    judged = quality.judge(counted, quality.fit(counted))
    return judged.select("doc_id", *quality.COUNTS, "base_failed", "kept", "distance")


@query("op6_pii")
def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.summary(pii.find(table(spark, sf_dir, "documents").select("doc_id", "text")))


@query("op1_substring_dedup")
def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunks.summary(chunks.dedupe(table(spark, sf_dir, "documents")))


@query("op7_suffix_windows")
def op7_suffix_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.summary(windows.dedupe(table(spark, sf_dir, "documents")))


@query("op11_source_divergence", checks.DIVERGENCE)
def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"), top=200)


@query("op13_vector_codes", checks.CODES)
def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codes.summary(*codes.compress(table(spark, sf_dir, "embeddings")))


@query("op12_lm_scores")
def op12_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    kept_out = scoring.held_out("doc_id")
    model = scoring.learn(documents, ~kept_out)
    return scoring.score(documents, model).select(
        "doc_id", kept_out.alias("held_out"), "n_tokens", "n_known", F.lit(model.tokens).cast("bigint").alias("train_tokens"), "base_score", "score"
    )
