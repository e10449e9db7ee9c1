"""Gold kept from run to run: each run adds its own counts, and Gold is their sum.

A run reads its own Bronze rows, never all of Silver. Its counts lie in a folder of its
own, which a repeat of the run replaces, so nothing counts twice. They are at most one
row a group and run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import BRONZE, GOLD, GOLD_COUNT, GOLD_KEYS, SILVER_PARTITIONS
from .bronze import Run
from .gold import count_by_place
from .silver import to_silver
from .sinks import _save, bronze_run_path


def run_bronze(spark: SparkSession, path: str, run: Run) -> DataFrame:
    """The Bronze rows of one incremental run, from its own folder."""
    rows = spark.read.schema(BRONZE).option("basePath", path).parquet(bronze_run_path(path, run))
    return rows.select(*BRONZE.names)


def as_stored(silver: DataFrame) -> DataFrame:
    """Silver as its table gives it back: an empty partition value is null."""
    return silver.withColumns({name: F.nullif(name, F.lit("")) for name in SILVER_PARTITIONS if name in silver.columns})


def run_counts(bronze: DataFrame) -> DataFrame:
    """What the rows of one run add to each group; only the four keys are parsed."""
    return count_by_place(as_stored(to_silver(bronze, GOLD_KEYS)))


def write_run_counts(counts: DataFrame, path: str, run: Run) -> None:
    """Replace the counts of one run and of no other."""
    _save(counts.write.mode("overwrite").format("parquet"), f"{path.rstrip('/')}/run_id={run.run_id}", "counts")


def merge_counts(counts: DataFrame) -> DataFrame:
    """Gold as the sum of the counts of all runs, largest first as ever."""
    merged = counts.groupBy(*GOLD_KEYS).agg(F.sum(GOLD_COUNT).alias(GOLD_COUNT))
    return merged.orderBy(F.desc(GOLD_COUNT), *GOLD_KEYS)


def scan_counts(spark: SparkSession, path: str) -> DataFrame:
    """Counts of all runs. Runs whose write broke off have no files yet."""
    return spark.read.schema(GOLD).parquet(path).select(*GOLD.names)
