"""The corpus pipeline: toxicity, exact copies, near copies, mixing, packing.

Every stage takes the rows that the stage before it kept, written as Parquet in
the shared folder and read again; all but the last return the columns of
documents.  Near copies share at least 0.8 of their five-word shingles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from inkwright.llm import exact_dedup, mixing, near_dedup, packing, toxicity, workspace
from inkwright.llm import queries as llm_queries


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels, categories = toxicity.by_language(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.drop_toxic(docs, toxicity.train(docs, labels, categories))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.drop_exact_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.drop_near_copies(docs, width=5, percent=80)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs, llm_queries.quality_weights(spark, sf_dir))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.best_fit_packing(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_exact_copies),
    ("MinHash near-dedup", drop_near_copies),
    ("mixing sources to target weights", mix_sources),
    ("best-fit packing", pack),
]

#: Classifiers, components and tokens are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    with workspace.Scratch(spark) as scratch:
        for name, stage in STAGES[:-1]:
            docs = scratch.table(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        return scratch.keep(STAGES[-1][1](spark, docs, sf_dir))
