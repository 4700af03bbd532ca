"""Removing acknowledged changes from a tracking table."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeloom.names import MODE_CDC, TRACKING_ID


def acknowledged_ids(positions: DataFrame, position: str = "position") -> DataFrame:
    """The tracking ids of acknowledged positions; snapshot positions name no tracked change."""
    cdc = positions.where(F.col(f"{position}.mode") == MODE_CDC)
    return cdc.select(F.col(f"{position}.last_processed_val").alias(TRACKING_ID))


def purge_acknowledged(feed: DataFrame, acknowledged: DataFrame) -> DataFrame:
    """What stays in the feed: an anti join, so any number of ids can be given."""
    return feed.join(acknowledged.select(TRACKING_ID), TRACKING_ID, "left_anti")


def purge_through(feed: DataFrame, position: Any) -> DataFrame:
    """What stays when everything up to a position was acknowledged: a filter, no join."""
    last = position if isinstance(position, Column) else F.lit(position)
    return feed.where(F.col(TRACKING_ID) > last)
