"""The corpus pipeline: toxicity, line dedup, near-dedup, mixing, packing, each over all that the stage before has kept.

Edge cases: null and empty texts, repeated rows, null ids and empty tables pass every stage as its operator says (null and empty texts have no set, so
near-dedup keeps them all; they have size 0, so mixing takes none). Columns beside those of documents pass all stages but the last, whatever their
names; n_chars, if it is there, follows a text that line dedup has changed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillwork.llm import line_dedup, mixing, near_dedup, packing, toxicity
from quillwork.llm.common import free_name, scratch

#: Packing and the learned toxicity score have no SQL; tests compare the stages with brute force instead.
ORACLE_SQL = None


def stage_toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose restored text scores 0.5 or more go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    name = free_name(docs.columns, "toxicity")
    return toxicity.score_toxicity(docs, toxicity.train(docs, labels), name=name).where(F.col(name) < 0.5).select(*docs.columns)


def stage_line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of recurring templates go; n_chars follows the text."""
    return line_dedup.dedup_texts(docs)


def stage_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    return near_dedup.near_dedup(docs)


def stage_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it."""
    return mixing.mix_sources(docs)


def stage_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of at most 4096 tokens."""
    return packing.pack(docs)


STAGES = [("toxicity", stage_toxicity), ("line dedup", stage_line_dedup), ("near-dedup", stage_near_dedup), ("mixing", stage_mixing), ("packing", stage_packing)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            path = scratch(spark, name.replace(" ", "-"))
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
