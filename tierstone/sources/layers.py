"""Scans of stored layers, always with their declared schema and column order."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ..schemas import BRONZE, GOLD, QUARANTINE, SILVER
from ..session import path_exists


def stored(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """A Parquet table. A path that was never written reads as a table without rows."""
    if path_exists(spark, path):
        return spark.read.schema(schema).parquet(path)
    return spark.createDataFrame([], schema)


def scan_bronze(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(BRONZE).parquet(path).select(*BRONZE.names)


def scan_silver(spark: SparkSession, path: str) -> DataFrame:
    """Partition columns stay text and return to their place in the declared order."""
    return spark.read.schema(SILVER).parquet(path).select(*SILVER.names)


def scan_quarantine(spark: SparkSession, path: str) -> DataFrame:
    """Rows of a checked Silver that were not read: their status, timestamp and payload."""
    rows = spark.read.schema(QUARANTINE).parquet(path)
    return rows.where("status <> 'read'").select(*QUARANTINE.names)


def scan_checked_silver(spark: SparkSession, path: str) -> DataFrame:
    """Silver of a checked table: the rows that were read."""
    return scan_silver(spark, f"{path.rstrip('/')}/status=read")


def scan_gold(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(GOLD).parquet(path).select(*GOLD.names)
