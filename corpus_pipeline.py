"""The corpus pipeline: rules, classifier, line dedup, near-dedup, packing.

Each stage takes all rows that the one before it kept, as (spark, docs, sf_dir). All but the
last return the columns of documents; the last returns the packed pieces of the documents
that are left.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from flightloom.llm import (
    line_dedup,
    minhash_dedup,
    packing,
    quality_classifier,
    quality_rules,
)
from flightloom.llm.texts import remainder, table, written

POLICY = "v3"
# Documents less likely good than this go.
LEAST_QUALITY = 0.3
# Word shingles this alike are near copies; op5's contract has a threshold of its own. As many
# trees as keep the chance to miss a pair at the threshold at 1e-4.
NEAR_PERCENT, NEAR_TREES = 80, 14


def rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.keep_documents(docs, POLICY)


def classifier_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Fitted on all documents and their training labels, as the rules stage has taken away
    most of the bad ones; applied to what that stage kept."""
    labels = table(spark, sf_dir, "labels").filter(remainder("doc_id", 3) != 1)
    model = quality_classifier.fit(table(spark, sf_dir, "documents"), labels)
    return quality_classifier.keep_good(docs, model, LEAST_QUALITY)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines go; a document that loses lines gets its new number of characters."""
    return line_dedup.apply_bitmaps(docs, line_dedup.keep_bitmaps(docs))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies stays."""
    return minhash_dedup.keep_one_each(docs, NEAR_PERCENT, NEAR_TREES)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"))


STAGES = [
    ("quality_rules", rules_stage),
    ("quality_classifier", classifier_stage),
    ("line_dedup", line_stage),
    ("near_dedup", near_dedup_stage),
    ("best_fit_packing", packing_stage),
]

# A network, a similarity join and a packing are not SQL; tests use brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written as parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
