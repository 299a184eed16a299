"""The corpus pipeline: documents through five stages, each one operator of wintide.llm.

Every stage takes what its predecessor kept, and all but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from wintide.llm import bpe, decontaminate, ordinal_quality, secrets_index, simhash
from wintide.llm.shared import fresh_folder, ship_package

# A trained model and hashed near-duplicates are beyond SQL; the stages are tested against brute force.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality model rejects go. It is trained on the labelled ones among the stage's input.

    A null text is judged as an empty one; null ids and repeated rows are judged each by its text.
    """
    ship_package(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return ordinal_quality.keep_good(docs, ordinal_quality.train(docs, labels))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, that with the smallest id (null ids last).

    Groups are those of operator 6: fingerprints of four-word shingles, linked at up to 4 bits. Null and empty
    texts are one group; of several texts under one id only those in the same group go.
    """
    ship_package(spark)
    return simhash.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go; null and empty texts, on either side, match nothing."""
    ship_package(spark)
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced in the texts; all documents stay, and null texts stay null."""
    ship_package(spark)
    return secrets_index.redact(docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every row that is left; a null or empty text has none."""
    ship_package(spark)
    return bpe.encode_documents(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"))


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secrets", secrets),
    ("encoding", encoding),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn; each one's result is written to the shared folder and read by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = fresh_folder(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
