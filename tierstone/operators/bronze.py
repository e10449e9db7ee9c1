"""Bronze: each record as JSON text, stamped with where and when it came from."""

from __future__ import annotations

import re
from dataclasses import dataclass
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..errors import TransformError
from ..schemas import BRONZE


@dataclass(frozen=True)
class Run:
    """One ingestion: its clock, read once, and the label of its source.

    Both stamps derive from ``ts`` in UTC, so the date never disagrees with the
    timestamp and neither depends on the time zone of the driver process.
    A ``ts`` without time zone is taken as UTC.
    """

    ts: datetime
    source_system: str

    def __post_init__(self) -> None:
        aware = self.ts if self.ts.tzinfo else self.ts.replace(tzinfo=timezone.utc)
        object.__setattr__(self, "ts", aware.astimezone(timezone.utc))

    @property
    def date(self) -> date:
        return self.ts.date()

    @property
    def run_id(self) -> str:
        """Clock and source: runs of two sources at one time are two runs."""
        micros = f"{self.ts.microsecond:06d}" if self.ts.microsecond else ""
        source = re.sub(
            "[^A-Za-z0-9_.]",
            lambda found: "".join(f"-{byte:02X}" for byte in found[0].encode()),
            self.source_system or "",
        )
        return f"{self.ts.strftime('%Y%m%dT%H%M%S')}{micros}-{source}"


def to_bronze(payloads: DataFrame, run: Run) -> DataFrame:
    """``payload`` rows -> Bronze rows. A projection: no shuffle, no action."""
    if payloads is None:
        raise TransformError("payloads is None")
    if "payload" not in payloads.columns:
        raise TransformError(f"no payload column among {payloads.columns}")
    return payloads.select(
        F.lit(run.ts).alias("ingestion_timestamp"),
        F.lit(run.date).alias("ingestion_date"),
        F.lit(run.source_system).cast("string").alias("source_system"),
        F.col("payload").cast(BRONZE["payload"].dataType).alias("payload"),
    )
