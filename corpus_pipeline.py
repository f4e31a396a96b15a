"""The corpus pipeline: five stages over `documents`, each written as Parquet and read again by the next.

1. toxicity: documents graded toxic go.
2. near_duplicates: one document of each group of near copies stays (five-word shingles, 80 %).
3. secrets: secrets are replaced by a mark; no document goes.
4. mixing: sources are mixed to target weights; a document may come twice or not at all.
5. packing: what is left is packed into sequences of 4096 tokens; this gives the result.

Every stage works on all rows of its predecessor. The first four return the columns of `documents`. Rows that
repeat an id and text are near copies of each other, so one stays after stage 2.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from martloom.llm import mixing, near_duplicates, packing, secret_scan, toxicity
from martloom.llm.support import Workspace, prepared
from martloom.llm.tokens import public_path


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = prepared(spark).read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.without_toxic(docs, labels)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepared(spark)
    return near_duplicates.one_of_each(docs)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepared(spark)
    return secret_scan.redacted(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepared(spark)
    return mixing.mixed(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepared(spark)
    return packing.pack_documents(docs, public_path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", without_toxic),
    ("near_duplicates", without_near_copies),
    ("secrets", without_secrets),
    ("mixing", mixed),
    ("packing", packed),
]

# Fitted models, MinHash and tokenizers have no SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = Workspace(prepared(spark), "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = work.table(stage(spark, docs, sf_dir), name)
    return docs
