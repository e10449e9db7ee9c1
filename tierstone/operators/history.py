"""Run history: what each step of each run read, wrote and could not read.

Counts are observed on the rows being written, so they cost no pass of their
own. They sit directly under the write, in its last stage: Spark adds up the
result of each of those tasks once, also when a lost executor makes it run twice.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import astuple, dataclass, field
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..errors import LoadError
from ..schemas import table

HISTORY = table(
    "run_id string, layer string, rows_in bigint, rows_out bigint, null_rows bigint, "
    "started timestamp, ended timestamp, status string"
)


def _now() -> datetime:
    return datetime.now(timezone.utc)


@dataclass
class Step:
    """One row of the history; counts are None where a step takes none."""

    run_id: str
    layer: str
    rows_in: int | None = None
    rows_out: int | None = None
    null_rows: int | None = None
    started: datetime = field(default_factory=_now)
    ended: datetime = field(default_factory=_now)
    status: str = "ok"


def counting(df: DataFrame, step: Step, **extra: Column) -> tuple[DataFrame, Callable[[], None]]:
    """``df`` with its rows counted while it is written, and a call that fills ``step``.

    ``rows_out`` is the row count; ``extra`` adds aggregates by the name of the
    ``Step`` field they fill. ``rows_in`` equals ``rows_out`` unless given.
    """
    seen = Observation()
    metrics = {"rows_out": F.count(F.lit(1)), **extra}
    observed = df.observe(seen, *(column.alias(name) for name, column in metrics.items()))

    def fill() -> None:
        values = seen.get
        for name in metrics:
            setattr(step, name, values[name] or 0)
        if "rows_in" not in metrics:
            step.rows_in = step.rows_out
        step.ended = _now()

    return observed, fill


@contextmanager
def recorded(steps: list[Step], run_id: str, layer: str) -> Iterator[Step]:
    """Time a step and keep how it ended: ``ok``, or the class of its failure."""
    step = Step(run_id, layer)
    steps.append(step)
    try:
        yield step
    except Exception as exc:
        step.status = f"failed: {type(exc).__name__}"
        raise
    finally:
        step.ended = _now()


def step_rows(spark: SparkSession, steps: list[Step]) -> DataFrame:
    """The steps of one run, a handful of rows."""
    return spark.createDataFrame([astuple(step) for step in steps], HISTORY)


def append_history(spark: SparkSession, steps: list[Step], path: str) -> None:
    """Add the steps of one run as one file."""
    rows = step_rows(spark, steps)
    try:
        rows.coalesce(1).write.mode("append").parquet(path)
    except Exception as exc:
        raise LoadError(f"run history could not be written to {path}: {exc}") from exc


def scan_history(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(HISTORY).parquet(path)
