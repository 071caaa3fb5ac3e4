"""From raw documents to token files: toxicity, near duplicates, benchmark passages, mixing, token ids.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of the documents.
Stages are written as Parquet and read again before the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from regiostar.llm import pareto_mix, spaced_seeds, token_files, toxic_segments, weighted_minhash
from regiostar.llm.common import table
from regiostar.llm.queries import tokenizer_file
from regiostar.session import materialize


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxic_segments.without_toxic(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return weighted_minhash.first_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return spaced_seeds.clean(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pareto_mix.mixed(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return token_files.encoded(docs, tokenizer_file())


STAGES = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("tokens", tokens),
]

#: No SQL for trained scores, samples of hashes and files; tests/llm/test_pipeline.py compares the rows of run() after each stage
#: with brute force on planted cases.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
