"""Which pages of a paged source count, and the records on them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def page_size(pages: DataFrame) -> Column:
    """Records on a page, from ``n_records`` where the table has it (no array is read then)."""
    return F.col("n_records") if "n_records" in pages.columns else F.size("records")


def page_prefix(pages: DataFrame, max_pages: int | None = None) -> DataFrame:
    """Pages 1, 2, ... up to the first one that is empty or absent, or ``max_pages``.

    ``pages`` holds ``page_number`` and ``records ARRAY<STRING>``; pages after the
    end are dropped, whatever they hold. ``max_pages=None`` sets no cap; zero or
    less keeps nothing.

    The end is one number from a scalar subquery: of the pages after a filled
    one, the first that is not filled. That is an anti-join of page numbers alone,
    one row per page, so no key repeats. ``pages`` is read more than once: pass a
    written table, not a live source.
    """
    candidates = pages.where("page_number >= 1")
    if max_pages is not None:
        candidates = candidates.where(F.col("page_number") <= F.lit(max_pages))
    filled = candidates.where(page_size(pages) > 0)
    numbers = filled.select(F.col("page_number").cast("bigint").alias("page_number"))
    start = numbers.agg(F.min("page_number")).scalar()
    end = (
        numbers.select((F.col("page_number") + 1).alias("page_number"))
        .join(numbers, "page_number", "left_anti")
        .agg(F.min("page_number"))
        .scalar()
    )
    return filled.where((start == 1) & (F.col("page_number") < end))


def explode_pages(pages: DataFrame) -> DataFrame:
    """Pages -> one ``payload`` row per record."""
    return pages.select(F.explode("records").alias("payload"))
