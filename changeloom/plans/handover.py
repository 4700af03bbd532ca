"""The source side end to end: which rows and changes a reader gets from a starting position."""

from __future__ import annotations

from typing import Any, NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changeloom.functions.convert import read_rows
from changeloom.names import MODE_CDC, MODE_SNAPSHOT, REASON, TRACKING_ID, ColumnType, Split
from changeloom.operators.envelope import cdc_records, key_columns, snapshot_records
from changeloom.sources.scratch import new_folder
from changeloom.sources.versions import take_snapshot

# What snapshot and change records have in common.
COMMON_COLUMNS = ["position", "operation", "metadata", "seq", "key", "after", "present"]


class Position(NamedTuple):
    mode: str
    last_processed_val: Any


def snapshot_then_cdc(snapshot: DataFrame, changes: DataFrame) -> DataFrame:
    """Snapshot records (``seq`` -1), then every change from the start of the feed.

    The feed is opened before the copy is taken, so a change may be in both: its record is then
    applied to a row that already shows it, which alters nothing.
    """
    types = [df.schema["position"].dataType["last_processed_val"].dataType for df in (snapshot, changes)]
    if types[0] != types[1]:
        snapshot, changes = _alike(snapshot, changes, types)
    return snapshot.select(COMMON_COLUMNS).unionByName(changes.select(COMMON_COLUMNS))


def _alike(snapshot: DataFrame, changes: DataFrame, types: list[T.DataType]) -> tuple[DataFrame, DataFrame]:
    """Both with positions of one type, in which they can still be compared."""
    mode, last = F.col("position.mode").alias("mode"), F.col("position.last_processed_val")
    if all(isinstance(t, (T.IntegralType, T.DecimalType)) for t in types):
        scale = max(getattr(t, "scale", 0) for t in types)
        wide = "bigint" if not any(isinstance(t, T.DecimalType) for t in types) else f"decimal(38,{scale})"
        position = F.struct(mode, last.cast(wide).alias("last_processed_val"))
        return snapshot.withColumn("position", position), changes.withColumn("position", position)
    # Text to write down, and each kind's own value to compare by.
    def position(of_snapshot: bool) -> Column:
        values = [last if of_snapshot else F.lit(None).cast(types[0]), F.lit(None).cast(types[1]) if of_snapshot else last]
        return F.struct(
            mode, last.cast("string").alias("last_processed_val"), values[0].alias("snapshot_val"), values[1].alias("tracking_val")
        )

    return snapshot.withColumn("position", position(True)), changes.withColumn("position", position(False))


def source_records(
    rows: DataFrame,
    feed: DataFrame,
    table: str,
    ordering: str,
    keys: list[str] | None = None,
    primary_keys: list[str] | None = None,
    columns: list[str] | None = None,
    snapshot: bool = True,
    position: Position | None = None,
    types: dict[str, ColumnType] | None = None,
    copy: str | None = None,
    ordered: bool = True,
) -> Split:
    """All records from a position on, and as JSON text the rows of which none can be made.

    With a snapshot wanted, and no position or one inside the snapshot: the rest of the snapshot,
    then the feed from its start. Otherwise only changes: those beyond a change position, or all.
    Columns with a database type are converted (see ``read_rows``).

    The snapshot is read from a point-in-time copy. It is made at ``copy``, where a resumed reader finds the
    one it began with; without it a resumed reader makes a new one, and rows that changed meanwhile
    come with the feed. Its records come in order of the
    ordering column, NULLs last, so that a position stands for all before it; only a reader that never
    resumes may go without. Values of the ordering column must be unique (see ``ordering_audit``).
    """
    keys = key_columns(keys, primary_keys, ordering)
    in_cdc = position is not None and position.mode == MODE_CDC
    if in_cdc:
        feed = feed.where(F.col(TRACKING_ID) > position.last_processed_val)
    feed, bad_changes = read_rows(feed, types or {})
    changes, unknown = cdc_records(feed, table, ordering, keys)
    rejects = _as_text(bad_changes).unionByName(_as_text(unknown))
    if in_cdc or not snapshot:
        return Split(changes, rejects)
    inside = position is not None and position.mode == MODE_SNAPSHOT
    if inside and copy is not None:
        rows = rows.sparkSession.read.schema(rows.schema).parquet(copy)
    else:
        rows = take_snapshot(rows, copy or new_folder(rows.sparkSession, "copy"))
    if inside:
        rows = rows.where((F.col(ordering) > position.last_processed_val) | F.col(ordering).isNull())
    rows, bad_rows = read_rows(rows, types or {})
    copied = snapshot_records(rows, table, ordering, keys, columns=columns, ordered=ordered)
    return Split(snapshot_then_cdc(copied, changes), rejects.unionByName(_as_text(bad_rows)))


def _as_text(rejects: DataFrame) -> DataFrame:
    """Rows of different shapes in one form."""
    row = F.struct(*[F.col(c) for c in rejects.columns if c != REASON])
    return rejects.select(F.to_json(row).alias("row_json"), REASON)
