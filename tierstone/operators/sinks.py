"""Writes of the RAW files and of the three layers."""

from __future__ import annotations

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F

from ..errors import LoadError
from ..schemas import BRONZE_PARTITIONS, SILVER_PARTITIONS
from ..session import path_exists
from ..sources.raw import encode_line
from .bronze import Run
from .publish import Audit, audited_write


#: Lines of a RAW file at most: a compressed file is read by one task, so files stay small.
RAW_FILE_LINES = 250_000


def _save(writer: DataFrameWriter, path: str, what: str) -> None:
    try:
        writer.save(path)
    except Exception as exc:
        raise LoadError(f"{what} could not be written to {path}: {exc}") from exc


def raw_path(root: str, run_id: str) -> str:
    return f"{root.rstrip('/')}/run_id={run_id}"


def write_raw(payloads: DataFrame, root: str, run_id: str) -> str:
    """RAW landing of one run, one payload per line; a retry replaces it.

    A record stands as it is; what a line cannot hold stands as a JSON string, so that
    ``read_raw_lines`` has every payload back as it was, nulls and blanks included.
    Text that repeats its keys in every line is by far the largest layer, so its files
    are compressed, each of at most ``RAW_FILE_LINES`` lines.
    """
    path = raw_path(root, run_id)
    lines = payloads.select(encode_line(F.col("payload")).alias("value"))
    writer = lines.write.mode("overwrite").format("text").option("lineSep", "\n")
    writer = writer.option("compression", "gzip").option("maxRecordsPerFile", RAW_FILE_LINES)
    _save(writer, path, "RAW")
    return path


def _aside(what: str, *partitions: str):
    """A write to a folder that nobody reads yet, for :func:`audited_write`."""

    def write(df: DataFrame, staged: str) -> None:
        _save(df.write.mode("overwrite").format("parquet").partitionBy(*partitions), staged, what)

    return write


def write_bronze(bronze: DataFrame, path: str, audit: Audit | None = None) -> None:
    """Append, partitioned by date. A run has one date, so no shuffle is needed."""
    if audit:
        audited_write(bronze, path, audit, _aside("Bronze", *BRONZE_PARTITIONS))
        return
    writer = bronze.write.mode("append").format("parquet").partitionBy(*BRONZE_PARTITIONS)
    _save(writer, path, "Bronze")


def write_bronze_run(bronze: DataFrame, path: str, run: Run, audit: Audit | None = None) -> None:
    """Write the folder of one run and no other; writing it again replaces it.

    The committer puts its success mark into the folder after the last file, and only
    a folder with the mark counts as done, so a commit that broke off is written anew.
    """
    if audit:
        rows, folder = bronze.drop(*BRONZE_PARTITIONS), bronze_run_path(path, run)
        audited_write(rows, folder, audit, _aside("Bronze"), replace=True, done_mark=True)
        return
    writer = bronze.drop(*BRONZE_PARTITIONS).write.mode("overwrite").format("parquet")
    writer = writer.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "true")
    _save(writer, bronze_run_path(path, run), "Bronze")


def bronze_run_path(path: str, run: Run) -> str:
    return f"{path.rstrip('/')}/ingestion_date={run.date.isoformat()}/run_id={run.run_id}"


def bronze_run_is_done(spark: SparkSession, path: str, run: Run) -> bool:
    """Whether the folder of the run is there, whole: its success mark is written last."""
    return path_exists(spark, f"{bronze_run_path(path, run)}/_SUCCESS")


def bronze_mode(spark: SparkSession, path: str) -> str | None:
    """How Bronze at a path is kept: by plain or by incremental runs; None if there is none."""
    if not path_exists(spark, path):
        return None
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    folder = hadoop.Path(path)
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for day in files.listStatus(folder):
        if not day.getPath().getName().startswith("ingestion_date="):
            continue
        for found in files.listStatus(day.getPath()):
            name = found.getPath().getName()
            if name.startswith("run_id="):
                return "incremental"
            if not name.startswith(("_", ".")):
                return "append_all"
    return None


def balance_silver(silver: DataFrame, partitions: int | None = None) -> DataFrame:
    """Bring the rows of a place together before a partitioned write.

    Without it every task writes a file for every place it meets. The rebalance
    hint lets adaptive execution split a place that outgrows the advisory
    partition size over several tasks and join small ones, so a place holding a
    third of the rows is neither one task nor one file. ``partitions`` is best
    a few times the number of places, so that a place split over many tasks seldom
    takes small ones along; by default the session's shuffle partitions.
    """
    counts = () if partitions is None else (partitions,)
    return silver.hint("rebalance", *counts, *SILVER_PARTITIONS)


def has_sink_log(spark: SparkSession, path: str) -> bool:
    """Whether a stream writes this table. Readers then see only the files in its log."""
    return path_exists(spark, f"{path.rstrip('/')}/_spark_metadata")


def write_silver(
    silver: DataFrame, path: str, partitions: int | None = None, audit: Audit | None = None
) -> None:
    """Append, partitioned by country and state; see ``balance_silver``."""
    if has_sink_log(silver.sparkSession, path):
        raise LoadError(f"Silver in {path} is kept by incremental runs; an append would not show")
    balanced = balance_silver(silver, partitions)
    if audit:
        audited_write(balanced, path, audit, _aside("Silver", *SILVER_PARTITIONS))
        return
    writer = balanced.write.mode("append").format("parquet").partitionBy(*SILVER_PARTITIONS)
    _save(writer, path, "Silver")


def write_checked_silver(checked: DataFrame, path: str, partitions: int | None = None) -> None:
    """Append rows of ``to_checked_silver``: a folder for each status, Silver's own layout in it.

    One parse and one write fill Silver, in ``status=read``, and the quarantine.
    """
    keys = ["status", *SILVER_PARTITIONS]
    counts = () if partitions is None else (partitions,)
    writer = checked.hint("rebalance", *counts, *keys).write.mode("append").format("parquet")
    _save(writer.partitionBy(*keys), path, "Silver")


def write_gold(gold: DataFrame, path: str, audit: Audit | None = None) -> None:
    """Replace the table. Its path must not be among the inputs of ``gold``."""
    if audit:
        audited_write(gold, path, audit, _aside("Gold"), replace=True, done_mark=True)
        return
    _save(gold.write.mode("overwrite").format("parquet"), path, "Gold")
