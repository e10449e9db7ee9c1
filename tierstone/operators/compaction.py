"""Compaction of Silver: places with many small files are rewritten in files of a proper size.

Appends leave files in every place they touch, so a table of many runs has more files than
its rows need. A place is rewritten if a rewrite would save at least ``MIN_SAVED`` of its
files: sizes come from the scan's file metadata, one row a file after the first aggregation,
so no folder is listed a second time and no file name comes to the driver.

Only the places to rewrite are read and replaced, each as a whole, with dynamic partition
overwrite: the others keep their files. Rows are balanced by place, and adaptive execution
cuts a place beyond the advisory size, so one that holds a third of all rows is many tasks
and files. A lost executor costs its tasks only. Nothing else may write the table at the same
time, and a driver lost in the commit itself, while folders are exchanged, leaves the rows of
places not yet exchanged in the ``.spark-staging`` folder of the table: readers of the table in
that moment, or after such a loss, lack them. A table that a stream owns is refused, since
readers see only the files in its log.

Cases: an empty or missing table, or one without such a place, is left as it is. A null key
stays null. Rows keep their values and repeats; their order within a place is not kept.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..errors import LoadError
from ..schemas import SILVER, SILVER_PARTITIONS
from ..session import path_exists, shared_scratch
from ..sources.layers import scan_silver
from .sinks import balance_silver, has_sink_log

TARGET_BYTES = 128 << 20
MIN_SAVED = 0.5


@dataclass(frozen=True)
class Compacted:
    places: int
    files: int


def place_files(spark: SparkSession, path: str) -> DataFrame:
    """``country, state_province, files, bytes`` of each place of a Silver table."""
    scan = spark.read.schema(SILVER).parquet(path)
    files = scan.groupBy(*SILVER_PARTITIONS, F.col("_metadata.file_path").alias("file")).agg(
        F.max("_metadata.file_size").alias("bytes")
    )
    return files.groupBy(*SILVER_PARTITIONS).agg(
        F.count(F.lit(1)).alias("files"), F.sum("bytes").alias("bytes")
    )


def worth_rewriting(target_bytes: int, min_saved: float) -> Column:
    needed = F.ceil(F.col("bytes") / target_bytes)
    return F.col("files") - needed >= F.greatest(F.lit(1.0), F.col("files") * min_saved)


def compact_silver(
    spark: SparkSession,
    path: str,
    *,
    target_bytes: int = TARGET_BYTES,
    min_saved: float = MIN_SAVED,
) -> Compacted:
    """Rewrite the places worth it; how many there were, and how many files they had."""
    if not path_exists(spark, path):
        return Compacted(0, 0)
    if has_sink_log(spark, path):
        raise LoadError(f"Silver in {path} is kept by incremental runs; its files are in their log")
    small = place_files(spark, path).where(worth_rewriting(target_bytes, min_saved))
    # Written first: the table they are read from changes below.
    chosen = f"{shared_scratch(spark, 'compaction')}/places"
    small.write.parquet(chosen)
    places = spark.read.schema(small.schema).parquet(chosen)
    total = places.agg(F.count(F.lit(1)).alias("places"), F.sum("files").alias("files")).first()
    if not total["places"]:
        return Compacted(0, 0)
    keys = places.select(*(F.col(name).alias(f"_{name}") for name in SILVER_PARTITIONS))
    same = F.lit(True)
    for name in SILVER_PARTITIONS:
        same = same & F.col(name).eqNullSafe(F.col(f"_{name}"))
    rows = scan_silver(spark, path).join(keys, same, "left_semi")
    writer = balance_silver(rows).write.mode("overwrite").format("parquet")
    try:
        writer.option("partitionOverwriteMode", "dynamic").partitionBy(*SILVER_PARTITIONS).save(path)
    except Exception as exc:
        raise LoadError(f"Silver in {path} could not be compacted: {exc}") from exc
    return Compacted(total["places"], total["files"])
