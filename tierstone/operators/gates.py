"""Quality gates: checks a layer has to pass before it is written."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..errors import EtlError, ExtractionError, GateError, TransformError
from ..schemas import BRONZE, GOLD


def require_columns(
    df: DataFrame, columns: Iterable[str], error: type[EtlError] = TransformError
) -> None:
    """Column names, compared by case; the message names the missing ones."""
    missing = [name for name in columns if name not in df.columns]
    if missing:
        raise error(f"missing columns: {missing}")


@dataclass(frozen=True)
class Gate:
    """What a layer must have. ``null_rate`` limits the share of nulls in a column, from 0
    to 1, the limit included; none by default. ``publish`` holds it before a layer shows.
    """

    name: str
    columns: tuple[str, ...]
    min_rows: int = 1
    null_rate: Mapping[str, float] = field(default_factory=dict, hash=False)


BRONZE_GATE = Gate("bronze", tuple(BRONZE.names))
# The Silver gate does not ask for address_2, address_3 and ingestion_timestamp.
SILVER_GATE = Gate(
    "silver",
    (
        "id", "name", "brewery_type", "address_1", "city", "state_province", "country",
        "postal_code", "longitude", "latitude", "phone", "website_url", "state", "street",
    ),
)
GOLD_GATE = Gate("gold", tuple(GOLD.names))


def enforce(df: DataFrame, gate: Gate, *inputs: DataFrame) -> DataFrame:
    """``df`` itself if it passes, else ``GateError``.

    Names are looked up in the schema. Rows are counted without their columns, up to
    ``min_rows``, and none reaches the driver. ``inputs``
    are asked in place of ``df`` where that is equal and cheaper: a grouped count
    has a row exactly when its input has.
    """
    require_columns(df, gate.columns, GateError)
    for rows in inputs or (df,):
        if rows.select(F.lit(1)).limit(gate.min_rows).count() < gate.min_rows:
            raise GateError(f"{gate.name} has fewer than {gate.min_rows} rows")
    return df


def report(df: DataFrame, gate: Gate) -> DataFrame:
    """One row per check, as a table: gate, check_name, observed, passed."""
    return report_counts(df.agg(F.count(F.lit(1)).alias("n")), (gate, df.columns, F.col("n")))


def report_counts(counts: DataFrame, *layers: tuple[Gate, Sequence[str], Column]) -> DataFrame:
    """The same for several layers whose row counts stand in one row.

    Silver has the rows of Bronze, and Gold counts them, so one pass gives all three.
    """

    def check(gate, name, observed, passed):
        return F.struct(
            F.lit(gate.name).alias("gate"),
            F.lit(name).alias("check_name"),
            observed.cast("bigint").alias("observed"),
            passed.alias("passed"),
        )

    checks = []
    for gate, columns, rows in layers:
        checks.append(check(gate, "row_count", rows, rows >= gate.min_rows))
        for name in gate.columns:
            present = F.lit(name in columns)
            checks.append(check(gate, f"column {name}", present, present))
    return counts.select(F.inline(F.array(*checks)))


def rate_report(df: DataFrame, gate: Gate) -> DataFrame:
    """One row per limited column: gate, column_name, n_rows, n_nulls, max_rate, passed."""
    limits = list(gate.null_rate.items())
    counts = [F.count_if(F.col(f"`{name}`").isNull()) for name, _ in limits]
    rows = df.agg(F.count(F.lit(1)).alias("n"), F.array(*counts).alias("nulls"))
    found = [
        F.struct(
            F.lit(gate.name).alias("gate"),
            F.lit(name).alias("column_name"),
            F.col("n").alias("n_rows"),
            F.col("nulls")[i].alias("n_nulls"),
            F.lit(float(limit)).alias("max_rate"),
            (F.col("nulls")[i] <= limit * F.col("n")).alias("passed"),
        )
        for i, (name, limit) in enumerate(limits)
    ]
    return rows.select(F.inline(F.array(*found)))


def probe(records: DataFrame) -> DataFrame:
    """``records`` itself if the source has any, else ``ExtractionError``."""
    if records.isEmpty():
        raise ExtractionError("the source answered with no record")
    return records
