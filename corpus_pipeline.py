"""A training corpus in five stages: language ID, line dedup, near-dedup, secret scan, packing.

Each stage takes all that the one before kept and its decisions take effect: documents in no known
language go; repeated lines go; one document of each group of near duplicates stays; secrets are
replaced by a mark; what is left is packed into sequences.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grainmill.llm.common import shared_folder
from grainmill.llm.langid import fit, identified
from grainmill.llm.linededup import without_repeats
from grainmill.llm.packing import pack_documents
from grainmill.llm.secrets import without_secrets
from grainmill.llm.simhash import one_of_each


def measured(docs: DataFrame) -> DataFrame:
    """n_chars of the texts as they are now."""
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return identified(docs, fit(docs))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return measured(without_repeats(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return one_of_each(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return measured(without_secrets(docs))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("language_id", language_id), ("line_dedup", line_dedup), ("near_dedup", near_dedup), ("secret_scan", secret_scan), ("packing", packing)]

#: SimHash, the language model and the packer cannot be written in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table; what a stage returns is written to the shared folder and read by the next."""
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
