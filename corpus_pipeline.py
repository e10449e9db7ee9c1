"""The corpus pipeline: documents in, token ids out, one operator a stage.

Each stage takes all rows its predecessor kept and returns the columns of documents,
but for the last, which returns the rows of the token files. A stage's result is
written to Parquet below ``spark.checkpoint.dir`` and read again by the next, so a lost
executor costs at most the running stage, and no plan spans two stages.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tierstone.llm import decontaminate, mixing, quality_rules, simhash_dedup, token_ids
from tierstone.llm.queries import table, tokenizer_path
from tierstone.session import shared_scratch

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def reject_junk(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    forest = quality_rules.fit(docs, table(spark, sf_dir, "labels"))
    return quality_rules.filter_quality(docs, forest)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return simhash_dedup.drop_near_copies(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in the proportions of their sources, a row for each time they are taken."""
    return mixing.mix(docs)


def write_token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mixture, and what they hold for each row."""
    return token_ids.store(docs, tokenizer_path())


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", reject_junk),
    ("simhash_near_dedup", drop_near_copies),
    ("decontamination", drop_leaks),
    ("mixing", mix_sources),
    ("token_ids", write_token_ids),
]

#: Isolation forests and Hamming graphs are beyond SQL; tests compare with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = shared_scratch(spark, f"pipeline_{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
