"""Bronze -> Silver for new Bronze files only.

A re-run of the plain append reads all of Bronze again. Here the checkpoint of a
streaming query remembers which files were read and the sink's log which were
written, so each Bronze row reaches Silver once, whatever is retried.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..errors import LoadError
from ..operators.silver import all_null, to_silver
from ..operators.sinks import balance_silver, has_sink_log
from ..schemas import BRONZE, SILVER, SILVER_PARTITIONS
from ..sources.layers import stored


@dataclass
class Followed:
    rows: int
    null_rows: int


def bronze_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Bronze files not read before, oldest first.

    ``max_files`` bounds one batch; what is left follows in the next. The age
    limit is raised so that no file is ever passed over as too old.
    """
    reader = spark.readStream.schema(BRONZE).option("maxFileAge", "3650d")
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def start_following(
    bronze: DataFrame, silver_path: str, checkpoint: str, partitions: int | None = None
) -> StreamingQuery:
    """Append what ``bronze`` has now to Silver, then stop."""
    counted = balance_silver(to_silver(bronze), partitions).observe(
        "silver", F.count(F.lit(1)).alias("rows"), F.count_if(all_null()).alias("null_rows")
    )
    return (
        counted.writeStream.format("parquet")
        .partitionBy(*SILVER_PARTITIONS)
        .option("path", silver_path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def follow_bronze(
    spark: SparkSession,
    bronze_path: str,
    silver_path: str,
    checkpoint: str,
    *,
    max_files: int | None = None,
    partitions: int | None = None,
) -> Followed:
    """Run ``start_following`` to its end and add up what its batches wrote."""
    if not has_sink_log(spark, silver_path) and not stored(spark, silver_path, SILVER).isEmpty():
        raise LoadError(f"Silver in {silver_path} is kept by plain runs; a stream would hide it")
    query = start_following(
        bronze_stream(spark, bronze_path, max_files), silver_path, checkpoint, partitions
    )
    written = {}
    try:
        ended = False
        while not ended:  # a query remembers only its latest progress reports
            ended = query.awaitTermination(1)
            for progress in query.recentProgress:
                if "silver" in progress.observedMetrics:
                    written[progress.batchId] = progress.observedMetrics["silver"]
    except Exception as exc:
        raise LoadError(f"Silver could not be written to {silver_path}: {exc}") from exc
    return Followed(
        sum(m["rows"] for m in written.values()), sum(m["null_rows"] for m in written.values())
    )
