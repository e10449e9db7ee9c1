"""Gold: how many records of each type each place has."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..errors import TransformError
from ..schemas import GOLD_COUNT, GOLD_KEYS
from .gates import require_columns


def count_by_place(silver: DataFrame) -> DataFrame:
    """Rows per type, country, state and city, in no order. Null keys are groups.

    Counted before the shuffle, so a group holding a third of the rows sends one
    row per task.
    """
    if silver is None:
        raise TransformError("silver is None")
    require_columns(silver, GOLD_KEYS)
    return silver.groupBy(*GOLD_KEYS).agg(F.count(F.lit(1)).alias(GOLD_COUNT))


def to_gold(silver: DataFrame) -> DataFrame:
    """``count_by_place``, largest first.

    The keys break ties. That makes the order total, and lets the range
    partitioning of the sort cut through a count that many groups share.
    """
    return count_by_place(silver).orderBy(F.desc(GOLD_COUNT), *GOLD_KEYS)
