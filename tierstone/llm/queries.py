"""The operators as queries over the benchmark tables, with the parameters of production."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import ship_package
from . import (
    cross_tokenizer,
    decontaminate,
    lang_id,
    line_dedup,
    lm_scoring,
    mixing,
    phrases,
    quality_classifier,
    quality_rules,
    simhash_dedup,
    suffix_dedup,
    token_ids,
    warc,
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mixing.plan_mix(table(spark, sf_dir, "documents"))
    return plan.select("doc_id", "size", "source_size", "target", "taken")


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return decontaminate.report(docs, benchmark)


def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score(table(spark, sf_dir, "documents"))


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op4_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_ids.store(table(spark, sf_dir, "documents"), tokenizer_path())


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive(table(spark, sf_dir, "pages"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.report(table(spark, sf_dir, "documents"))


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.removed(table(spark, sf_dir, "documents"))


def op8_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup.near_copies(table(spark, sf_dir, "documents"))


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return quality_classifier.classify(docs, labels)


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return quality_rules.rate(docs, quality_rules.fit(docs, labels))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


def op12_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lang_id.identify(table(spark, sf_dir, "documents"))


def op13_cross_tokenizer(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    pieces = public_tokenizers.path("piece_bpe_32k.model")
    return cross_tokenizer.report(table(spark, sf_dir, "documents"), tokenizer_path(), pieces)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mixing": op1_mixing,
    "op2_decontaminate": op2_decontaminate,
    "op3_lm_scoring": op3_lm_scoring,
    "op4_token_ids": op4_token_ids,
    "op5_warc": op5_warc,
    "op6_line_dedup": op6_line_dedup,
    "op7_suffix_dedup": op7_suffix_dedup,
    "op8_simhash_dedup": op8_simhash_dedup,
    "op9_quality_classifier": op9_quality_classifier,
    "op10_quality_rules": op10_quality_rules,
    "op11_collocations": op11_collocations,
    "op12_language_id": op12_language_id,
    "op13_cross_tokenizer": op13_cross_tokenizer,
}
ORACLES: dict[str, str] = {
    "op1_mixing": r"""
        WITH docs AS (
            SELECT doc_id, source,
                   len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
                   substr(md5(coalesce(doc_id::VARCHAR, '') || ':mix'), 1, 13) AS random
            FROM documents
        ), sums AS (
            SELECT source, sum(size)::BIGINT AS source_size,
                   [3.0, 1.0, 2.0][(row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1]::DOUBLE AS weight
            FROM docs GROUP BY source
        ), levels AS (
            SELECT *, 2.0::DOUBLE * source_size AS cap,
                   (1.5::DOUBLE * (SELECT sum(source_size)::DOUBLE FROM sums)
                    - coalesce(sum(2.0::DOUBLE * source_size) OVER (fullest ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                   / sum(weight) OVER (fullest ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
            FROM sums
            WINDOW fullest AS (ORDER BY 2.0::DOUBLE * source_size / weight, source IS NULL, source)
        ), goals AS (
            SELECT source, source_size,
                   least(cap, coalesce((SELECT max(level) FROM levels WHERE level * weight <= cap), 'inf'::DOUBLE) * weight) AS target
            FROM levels
        ), placed AS (
            SELECT d.doc_id, d.size, g.source_size, g.target,
                   CASE WHEN g.source_size > 0 THEN floor(g.target / g.source_size) ELSE 0 END::BIGINT AS full_epochs,
                   coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.random, d.doc_id, d.size
                                              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
            FROM docs d JOIN goals g ON d.source IS NOT DISTINCT FROM g.source
        )
        SELECT doc_id, size, source_size, target,
               (size * (full_epochs + CASE WHEN size > 0
                        AND before + size / 2 <= target - full_epochs * source_size THEN 1 ELSE 0 END))::BIGINT AS taken
        FROM placed
    """,
}
