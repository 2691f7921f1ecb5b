"""A corpus pipeline over ``documents``: quality rules, near duplicates, contamination, personal data, tokens.

Every stage takes the documents that its predecessor kept and, but for the last, returns rows with the
columns of documents.  ``run`` writes each result to the shared folder and reads it again, so a lost
executor costs no more than its share of one stage.

Null or empty texts and texts without words fail the quality rules and go; repeated rows are one group of
near duplicates; null ids, languages and sources are allowed; columns beyond those of documents are
passed through; empty tables give empty results.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.llm import bpe, decontaminate, pii, quality, simhash
from granary.registry.base import table
from granary.session import stage, use_own_scratch

#: No SQL expresses fingerprints, robust estimates or merges; tests compare with brute force.
ORACLE_SQL = None
VOCABULARY = "word_bpe_49k.json"


def _held(docs: DataFrame, *columns: str) -> DataFrame:
    """Whole rows as one column ``doc`` beside the columns that an operator reads."""
    return docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("doc"), *[docs[c] for c in columns])


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that pass the base rules and are no outliers of their language and source."""
    # Counted once and written with the rows: a filter on the verdict would otherwise be evaluated by
    # counting again, and the estimates read the numbers alone.
    counted = stage(quality.text_counts(_held(docs, "lang", "source", "text")).drop("text"), "pipeline-counts")
    return quality.judge(counted, quality.fit(counted)).where("kept").select("doc.*")


def keep_one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each group of fingerprints linked at two bits or fewer."""
    return simhash.keep_first(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of which less than a twentieth lies in windows of the benchmark."""
    scanned = decontaminate.scan(_held(docs, "text"), table(spark, sf_dir, "benchmark"), id="doc")
    return decontaminate.verdicts(scanned, id="doc").where("NOT contaminated").select("doc.*")


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind."""
    found = pii.find(_held(docs, "text"))
    text = pii.masked(F.col("text"), F.col("spans"))
    masked = found.select(F.col("doc").withField("text", text).alias("doc"))
    if "n_chars" in docs.columns:
        masked = masked.select(F.col("doc").withField("n_chars", F.char_length("doc.text").cast("bigint")).alias("doc"))
    return masked.select("doc.*")


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id``, ``n_tokens``, ``ids`` and ``decoded`` of all documents."""
    return bpe.encode(docs, public_tokenizers.path(VOCABULARY))


STAGES = [
    ("quality", keep_quality),
    ("near_duplicates", keep_one_of_near_duplicates),
    ("decontamination", drop_contaminated),
    ("personal_data", mask_personal_data),
    ("tokens", tokenize),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(use_own_scratch(spark), sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
