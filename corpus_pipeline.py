"""A corpus pipeline: each stage calls one operator of ``factline.llm``, and works on what the stage before has kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from factline.llm import decontam, langid, mixing, simhash, tokens
from factline.llm.common import read_benchmark, read_documents
from factline.session import work_dir


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language go: no text, no letters, or no language that holds half of the words."""
    return langid.known_language(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies stays."""
    return simhash.simhash_dedup(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark passages go."""
    return decontam.clean_documents(docs, read_benchmark(spark, sf_dir))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents stand as often as the mix takes them."""
    return mixing.mixed(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Writes the training shards and returns a row per sequence in them."""
    return tokens.training_order(docs, with_ids=False)


STAGES = [("language ID", language), ("SimHash near-dedup", near_duplicates), ("benchmark decontamination", decontamination),
          ("source mixing", source_mixing), ("token output", token_output)]

#: SQL can't express the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to documents; each one's rows are written and read again."""
    docs = read_documents(spark, sf_dir)
    for name, stage in STAGES:
        path = work_dir(spark, "pipeline-" + name.replace(" ", "-").lower())
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
