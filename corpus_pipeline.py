"""A cleaning pipeline over `documents`: quality rules, near-duplicates, benchmark decontamination, packing.

Each stage is (spark, docs, sf_dir) -> DataFrame; its result is written as Parquet and read again as the next one's docs."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sedimenta.llm import common, decontamination, packing, quality, simhash

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the forest keep, in one pass that carries all columns. Null and empty texts fail the base rules; repeated rows and rows
    without an id are judged each by its text."""
    return quality.keep(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that five-word shingles of similarity 0.8 or more link, the one with the smallest id. Null, empty and blank texts are copies of each
    other; an id that repeats with other texts stays for each of its groups; documents without an id can't be named and stay."""
    return simhash.one_of_each(docs, words=5, similarity=0.8)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark window; what surrounds a leaked passage is usually about it, so the whole document goes. Null and empty texts are clean;
    repeated rows and rows without an id are judged each."""
    return decontamination.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), "drop")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces with their token ids and their places in sequences of at most 2048 tokens. A null or empty text is its end id alone; repeated rows and rows without
    an id are packed each. Every stage gives an empty table for an empty one."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), ids=True)


#: Rows of a batch that goes to a Python worker. Texts are long: the usual 10,000 of them stand in memory several times over, on both sides.
BATCH_ROWS = "2000"


def _sized(stage: Stage) -> Stage:
    """The stage under the pipeline's own setting for batches, which is read when its result is computed."""

    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
        return stage(spark, docs, sf_dir)

    return run


STAGES: list[tuple[str, Stage]] = [("quality_rules", _sized(quality_rules)), ("near_duplicates", _sized(near_duplicates)), ("decontaminated", _sized(decontaminated)), ("packed", _sized(packed))]

#: Stages that fit a forest, hash with XXH64 and merge tokens are beyond SQL; tests compare run() with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = common.stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
