"""Silver: the payload parsed once with the declared schema and laid out flat."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..errors import TransformError
from ..functions.records import CORRUPT, parse_payload, parse_status, record_schema
from ..schemas import SILVER_FIELDS, table


def to_silver(bronze: DataFrame, fields: Sequence[str] | None = None) -> DataFrame:
    """Bronze -> ``ingestion_timestamp`` and the record fields, one row per row.

    ``fields`` narrows both the parse and the result.
    """
    if bronze is None:
        raise TransformError("bronze is None")
    wanted = SILVER_FIELDS if fields is None else [f for f in SILVER_FIELDS if f in set(fields)]
    return bronze.select(
        "ingestion_timestamp", parse_payload("payload", record_schema(wanted)).alias("record")
    ).select("ingestion_timestamp", *(f"record.{name}" for name in wanted))


def to_checked_silver(bronze: DataFrame) -> DataFrame:
    """Silver with a ``status`` (see ``parse_status``), and the payload of rows not ``read``.

    The same single parse as ``to_silver``, which also keeps what it could not read.
    """
    if bronze is None:
        raise TransformError("bronze is None")
    schema = StructType([*record_schema(SILVER_FIELDS), *table(f"{CORRUPT} string")])
    parsed = F.col("record")
    rows = bronze.select("ingestion_timestamp", "payload", parse_payload("payload", schema).alias("record"))
    rows = rows.withColumn("status", parse_status(parsed, SILVER_FIELDS))
    unread = F.when(F.col("status") != "read", F.col("payload"))
    return rows.select(
        "ingestion_timestamp", *(parsed[name].alias(name) for name in SILVER_FIELDS), "status", unread.alias("payload")
    )


def latest_by_id(silver: DataFrame) -> DataFrame:
    """The latest row of each id, by the clock of its run; equal clocks fall to the largest row.

    Rows without an id are no repeats of each other and all stay. Taken before the
    shuffle, so an id that holds a third of the rows is one row a task.
    """
    fields = [name for name in silver.columns if name not in ("ingestion_timestamp", "id")]
    known = silver.where(F.col("id").isNotNull())
    newest = F.max(F.struct("ingestion_timestamp", *fields)).alias("newest")
    latest = known.groupBy("id").agg(newest).select("id", "newest.*")
    return latest.unionByName(silver.where(F.col("id").isNull())).select(*silver.columns)


def all_null(fields: Sequence[str] = SILVER_FIELDS) -> Column:
    """True for a row of which no field could be read."""
    return F.coalesce(*(F.col(name).cast("string") for name in fields)).isNull()
