"""Names shared by every module: control columns, operations and record fields."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame

# The control columns of a tracking table.
TRACKING_ID = "CONNECTOR_TRACKING_ID"
OPERATION_TYPE = "CONNECTOR_OPERATION_TYPE"
CREATED_AT = "CONNECTOR_TRACKING_CREATED_AT"
CONTROL_COLUMNS = [TRACKING_ID, OPERATION_TYPE, CREATED_AT]

# The operations a tracking table may hold, and the record operation each becomes.
TRACKED_OPERATIONS = {"insert": "create", "update": "update", "delete": "delete"}

# The metadata entry that names a record's table, and the two reading modes.
METADATA_TABLE = "oracle.table"
MODE_SNAPSHOT = "snapshot"
MODE_CDC = "cdc"

# Rows per page, by default and at the limits.
DEFAULT_BATCH_SIZE = 1000
MIN_BATCH_SIZE = 1
MAX_BATCH_SIZE = 100000

# What a table or column name may look like.
OBJECT_NAME_PATTERN = r"^[a-zA-Z]+[a-zA-Z\d#$_]*\z"
MAX_OBJECT_NAME_BYTES = 127

# Order of a snapshot row in a feed: before every tracked change.
SNAPSHOT_SEQ = -1

REASON = "reject_reason"


class Split(NamedTuple):
    """Rows an operator accepted, and the rows it set aside with a ``reject_reason``."""

    good: DataFrame
    rejects: DataFrame


class ColumnType(NamedTuple):
    """A database column type: its name, and for numbers the precision and scale."""

    name: str
    precision: int | None = None
    scale: int | None = None

    @property
    def is_number(self) -> bool:
        return self.name.upper() == "NUMBER"

    @property
    def is_flag(self) -> bool:
        return self.is_number and self.precision == 1 and self.scale == 0

    @property
    def is_time(self) -> bool:
        return self.name.upper() == "DATE" or "TIMESTAMP" in self.name.upper()

    @property
    def is_blob(self) -> bool:
        return "BLOB" in self.name.upper()


def require_columns(df: DataFrame, wanted: list[str], what: str) -> None:
    """Fail while the plan is built, not at the first row, when a named column is absent."""
    absent = [name for name in wanted if name not in df.columns]
    if absent:
        raise ValueError(f"{what} not found: {', '.join(absent)}")


def split_on(df: DataFrame, reason: Column) -> Split:
    """Part the rows of ``df`` by a reason column that is NULL for good rows."""
    marked = df.withColumn(REASON, reason)
    return Split(
        good=marked.where(marked[REASON].isNull()).drop(REASON),
        rejects=marked.where(marked[REASON].isNotNull()),
    )
