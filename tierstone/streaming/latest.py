"""The latest record of each id, kept from run to run by keyed state.

The state of the stream is one row an id. A batch reads the Bronze files not seen before,
takes the newest row of each id in a task before the shuffle, and writes the ids whose
latest row changed to a folder of its own, which a repeated batch replaces. The latest of
those folders is the table. Rows without an id are no repeats and stay with Silver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..errors import LoadError
from ..operators.silver import latest_by_id, to_silver
from ..schemas import SILVER
from ..sources.layers import stored
from .incremental import bronze_stream


def follow_latest(spark: SparkSession, bronze_path: str, path: str, checkpoint: str, *, max_files: int | None = None) -> None:
    """Bring the table of latest records up to what Bronze has now."""
    silver = to_silver(bronze_stream(spark, bronze_path, max_files)).where(F.col("id").isNotNull())
    fields = [name for name in silver.columns if name not in ("ingestion_timestamp", "id")]
    newest = silver.groupBy("id").agg(F.max(F.struct("ingestion_timestamp", *fields)).alias("newest"))
    changed = newest.select("id", "newest.*").select(*SILVER.names)

    def write(rows: DataFrame, batch: int) -> None:
        rows.write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch={batch}")

    query = (
        changed.writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(write)
        .trigger(availableNow=True)
        .start()
    )
    try:
        query.awaitTermination()
    except Exception as exc:
        raise LoadError(f"latest records could not be written to {path}: {exc}") from exc


def scan_latest(spark: SparkSession, path: str, silver: DataFrame | None = None) -> DataFrame:
    """One row an id, and the rows of ``silver`` that have none."""
    changes = stored(spark, path, SILVER).select(*SILVER.names)
    latest = latest_by_id(changes)
    return latest if silver is None else latest.unionByName(silver.where(F.col("id").isNull()))
