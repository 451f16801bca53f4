"""The registered queries of the corpus operators and, where SQL can say it, their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from umbral.llm.attribution import CountSpec, section_counts
from umbral.llm.common import ship_package
from umbral.llm.crosstok import CrossSpec, cross_tokens
from umbral.llm.jaccard import near_duplicates
from umbral.llm.labelled import in_fold
from umbral.llm.language import languages
from umbral.llm.linecrf import fit_lines, judge
from umbral.llm.mixing import mix, mix_sql
from umbral.llm.neighbours import search
from umbral.llm.packing import PackSpec, pack
from umbral.llm.pii import detect, fit_pii
from umbral.llm.quality import quality_scores
from umbral.llm.repair import RepairSpec, token_files
from umbral.llm.spelling import spelling_groups
from umbral.llm.toxicity import toxicity_scores

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def register(name: str, sql: str | None = None):
    def add(fn):
        def query(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)
            return fn(spark, sf_dir)
        QUERIES[name] = query
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return add


@register("op1_quality_classifier")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), in_fold(5, 0))


@register("op2_toxicity")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), in_fold(4, 2))


@register("op4_source_mix", mix_sql())
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"))


@register("op6_quality_rules")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return judge(docs, fit_lines(docs, table(spark, sf_dir, "labels")))


@register("op3_pii")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return detect(docs, fit_pii(docs))


@register("op10_best_fit_packing")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), PackSpec(public_tokenizers.path("word_bpe_49k.json")))


@register("op9_token_files")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files(table(spark, sf_dir, "documents"), RepairSpec(public_tokenizers.path("byte_bpe_50k.json")))


@register("op7_nearest_neighbours")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


@register("op8_jaccard_join")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


@register("op5_token_counts")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return section_counts(table(spark, sf_dir, "documents"), CountSpec(public_tokenizers.path("byte_bpe_50k.json")))


@register("op11_spelling_variants")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_groups(table(spark, sf_dir, "documents"))


@register("op12_cross_tokens")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cross_tokens(table(spark, sf_dir, "documents"), CrossSpec(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")))


@register("op13_language_id")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return languages(table(spark, sf_dir, "documents"), in_fold(5, 0))
