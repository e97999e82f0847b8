"""The corpus pipeline: documents in, packed training sequences out.

Each stage takes (spark, docs, sf_dir), works on all that the stage before kept,
and returns a DataFrame; all but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from txnflow.llm import decontaminate, jaccard_join, language_crf, packing, quality
from txnflow.llm.common import discard, written
from txnflow.session import configure

# No SQL: the first stage is a trained model and the last packs by an optimisation. Tests hold each stage against
# a brute-force version.
ORACLE_SQL = None


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which one learned language has at least half of the words; texts without letters go."""
    learned = docs.where(language_crf.remainder("doc_id", 3) != 1)
    return language_crf.keep_known(docs, language_crf.train(learned))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that break no rule."""
    return quality.kept_rows(docs)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest id."""
    return jaccard_join.keep_one(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences of 1024 tokens."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("language_id", language_id),
    ("quality_rules", quality_rules),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("benchmark_decontamination", benchmark_decontamination),
    ("best_fit_packing", best_fit_packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on `documents`; what each returns is written and read again as the next one's input, then deleted."""
    configure(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        before, docs = docs, written(stage(spark, docs, sf_dir), f"stage-{name}")
        discard(before)
    return docs
