"""A corpus pipeline of five stages. Every stage takes all that the one before it kept, as a table of documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sievework.llm import decontaminate, minhash, mixing, quality, tokens
from sievework.llm.queries import tokenizer_path
from sievework.llm.shared import new_folder, table


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.drop_near_duplicates(docs, size=5, percent=80)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return tokens.read_token_files(tokens.write_token_files(docs, tokenizer_path(), new_folder(spark, "pipeline-tokens")))


STAGES = [
    ("quality_rules", good_quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontaminated),
    ("mixing", mixed),
    ("token_files", token_files),
]

#: MinHash links and tokenizer ids have no SQL; the tests hold run() against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = new_folder(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
