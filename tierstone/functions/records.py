"""Between records, JSON text and typed columns; all built-in functions."""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..errors import TransformError
from ..schemas import RECORD


def to_payload(*columns: Column | str) -> Column:
    """One record as JSON text. Null fields are kept, so every record shows all its keys."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def payload_rows(records: DataFrame) -> DataFrame:
    """A table of records -> one ``payload`` column of JSON text."""
    return records.select(to_payload(*records.columns).alias("payload"))


def payloads_from_list(spark: SparkSession, records: list[Mapping[str, Any]]) -> DataFrame:
    """Records the caller already holds in Python -> ``payload`` rows.

    For small batches and tests; larger inputs arrive through ``sources``.
    """
    if not isinstance(records, list):
        raise TransformError("records must be a list of dictionaries")
    try:
        rows = [(json.dumps(record, ensure_ascii=False),) for record in records]
    except (TypeError, ValueError) as exc:
        raise TransformError(f"a record cannot be written as JSON: {exc}") from exc
    return spark.createDataFrame(rows, "payload STRING")


def record_schema(fields: Iterable[str] | None = None) -> StructType:
    """The record schema, or the part of it a caller needs, see ``parse_payload``."""
    return RECORD if fields is None else StructType([RECORD[name] for name in fields])


def parse_payload(payload: Column | str, schema: StructType | str = RECORD) -> Column:
    """JSON text -> struct. Malformed text gives a row of nulls, never an error.

    Catalyst does not narrow the schema of a parse that feeds several columns, so
    a caller that needs few fields passes those: the rest is skipped unread.
    """
    return F.from_json(payload, schema)


CORRUPT = "_corrupt_record"


def parse_status(parsed: Column, fields: Iterable[str]) -> Column:
    """How a parse with a ``_corrupt_record`` field went.

    ``read``, or ``mistyped`` where some field did not fit its type, ``malformed`` where the
    text gave none of the fields (a JSON null or list among it), ``missing`` where there is no text.
    """
    corrupt = parsed[CORRUPT].isNotNull()
    some = F.coalesce(*(parsed[name].cast("string") for name in fields)).isNotNull()
    return (
        F.when(corrupt & some, "mistyped")
        .when(corrupt, "malformed")
        .when(parsed.isNull(), "missing")
        .otherwise("read")
    )


def typed_records(payloads: DataFrame) -> DataFrame:
    """``payload`` rows -> the sixteen record columns in record order.

    A missing key is null, an extra key is dropped. A whole number in a DOUBLE
    field is widened.
    """
    return payloads.select(parse_payload("payload").alias("r")).select("r.*")


def conform(records: DataFrame) -> DataFrame:
    """A table with any columns -> the sixteen record columns, by exact name."""
    return records.select(
        *(
            (F.col(f"`{field.name}`") if field.name in records.columns else F.lit(None))
            .cast(field.dataType)
            .alias(field.name)
            for field in RECORD
        )
    )
