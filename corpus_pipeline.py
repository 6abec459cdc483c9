"""The corpus pipeline: quality rules, line dedup, n-gram join, decontamination, packing.

Each stage takes ``(spark, docs, sf_dir)`` and gives a DataFrame, which is written as Parquet and read again
as the next stage's ``docs``.  All but the last return the columns of documents.  Decisions take effect: the
first drops what the rules reject; the second takes repeated runs of lines out of the texts and drops
documents that lose all; the third keeps one document of each group; the fourth drops contaminated documents;
the last places every piece of what is left.  Empty tables, null texts and extra columns pass through the
stages as each operator's module says.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lodestone.llm import decontaminate, linededup, ngramjoin, packing, quality
from lodestone.llm.common import materialise


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return linededup.dedup_lines(docs)


def ngram_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngramjoin.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("ngram_join", ngram_join),
    ("decontamination", decontamination),
    ("best_fit_packing", best_fit_packing),
]

#: Packing needs the tokenizer, which SQL does not have; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
