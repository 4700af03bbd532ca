"""Ordered pages of a snapshot or of a tracking table, and checks of the ordering column."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeloom.names import (
    CONTROL_COLUMNS,
    DEFAULT_BATCH_SIZE,
    MAX_BATCH_SIZE,
    MIN_BATCH_SIZE,
    TRACKING_ID,
    require_columns,
)
from changeloom.operators.capture import rank_rows


def _page(df: DataFrame, ordering: str, after: Any, limit: int) -> DataFrame:
    if not MIN_BATCH_SIZE <= limit <= MAX_BATCH_SIZE:
        raise ValueError(f"batch size must lie in {MIN_BATCH_SIZE}..{MAX_BATCH_SIZE}")
    if after is not None:
        last = after if isinstance(after, Column) else F.lit(after)
        df = df.where(F.col(ordering) > last)
    return df.orderBy(F.col(ordering).asc_nulls_last()).limit(limit)


def snapshot_page(
    rows: DataFrame,
    ordering: str,
    after: Any = None,
    limit: int = DEFAULT_BATCH_SIZE,
    columns: list[str] | None = None,
) -> DataFrame:
    """The next ``limit`` rows in ordering-column order, strictly after a value.

    Without ``after`` the page starts at the first row; NULLs come last. Rows that tie with the
    last value of a page are not on the next one: see ``ordering_audit``.
    """
    require_columns(rows, [ordering, *(columns or [])], "column")
    page = _page(rows, ordering, after, limit)
    return page.select(*columns) if columns else page


def change_page(
    feed: DataFrame,
    after: Any = None,
    limit: int = DEFAULT_BATCH_SIZE,
    columns: list[str] | None = None,
) -> DataFrame:
    """The next ``limit`` changes in tracking-id order; control columns are always kept.

    A change that was committed late, with an id at or below ``after``, is not returned.
    """
    page = _page(feed, TRACKING_ID, after, limit)
    return page.select(*columns, *CONTROL_COLUMNS) if columns else page


def ordering_audit(rows: DataFrame, ordering: str) -> DataFrame:
    """Values of the ordering column that break paging: repeated ones, and NULL."""
    return (
        rows.groupBy(F.col(ordering).alias("ordering_value"))
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .where((F.col("n_rows") > 1) | F.col("ordering_value").isNull())
    )


def page_index(rows: DataFrame, ordering: str, limit: int = DEFAULT_BATCH_SIZE) -> DataFrame:
    """Every row with the number of its ``page`` (from 0), all pages at once.

    Pages are those that successive calls of ``snapshot_page`` give, as long as ordering values are unique; of
    rows that tie, none is lost here. Rows with NULL there follow no value and have no page. The sorted rows
    are written to the shared folder with their place in their partition (see ``capture.number_changes``); what
    is looked at together is one row per partition.
    """
    if not MIN_BATCH_SIZE <= limit <= MAX_BATCH_SIZE:
        raise ValueError(f"batch size must lie in {MIN_BATCH_SIZE}..{MAX_BATCH_SIZE}")
    require_columns(rows, [ordering], "column")
    placed = rank_rows(rows.where(F.col(ordering).isNotNull()), [F.col(ordering)], "_rank")
    paged = placed.withColumn("page", F.expr(f"(_rank - 1) div {limit}")).drop("_rank")
    return paged.unionByName(rows.where(F.col(ordering).isNull()).withColumn("page", F.lit(None).cast("bigint")))
