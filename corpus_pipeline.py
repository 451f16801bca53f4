"""A training-corpus pipeline over ``documents``: each stage is one of the operators in umbral.llm.

STAGES lists (name, function) in order; a function takes (spark, docs, sf_dir) and returns the next
stage's documents. Every stage works on all rows its predecessor kept and its decisions take effect:
rejected documents go, one document of each group of near copies stays, personal data is masked, and
the mix repeats or leaves out documents; the last stage says where every piece of a document stands.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from umbral.llm.common import ship_package
from umbral.llm.jaccard import one_of_each
from umbral.llm.linecrf import fit_lines, kept_documents
from umbral.llm.mixing import mixed_documents
from umbral.llm.packing import PackSpec, pack
from umbral.llm.pii import fit_pii, masked_documents
from umbral.session import ensure_checkpoint_dir


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the line field keep."""
    ship_package(spark)
    return kept_documents(docs, fit_lines(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    ship_package(spark)
    return one_of_each(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data masked."""
    ship_package(spark)
    return masked_documents(docs, fit_pii(docs))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of their sources takes them."""
    ship_package(spark)
    return mixed_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where every piece of every document stands in the token sequences."""
    ship_package(spark)
    return pack(docs, PackSpec(public_tokenizers.path("word_bpe_49k.json")))


STAGES = [("quality_rules", quality_rules), ("near_duplicates", near_duplicates), ("personal_data", personal_data), ("source_mix", source_mix), ("packing", packing)]

#: The line field, the shingle components and the packing are not SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; what a stage returns is written as Parquet and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{ensure_checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
