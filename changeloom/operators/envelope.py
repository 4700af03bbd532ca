"""Records: the envelope around each row, its key and its position."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeloom.functions.binding import evaluate_once
from changeloom.names import (
    CREATED_AT,
    METADATA_TABLE,
    MODE_CDC,
    MODE_SNAPSHOT,
    OPERATION_TYPE,
    SNAPSHOT_SEQ,
    TRACKED_OPERATIONS,
    TRACKING_ID,
    Split,
    require_columns,
    split_on,
)

# The fields of a written position.
POSITION_FIELDS = ["mode", "last_processed_val", "tracking_table", "trigger", "snapshot_table"]


def key_columns(
    keys: list[str] | None, primary_keys: list[str] | None, ordering: str
) -> list[str]:
    """The columns that make the record key: the ones asked for, else the table's primary key,
    else the ordering column."""
    return list(keys or primary_keys or [ordering])


def key_struct(df: DataFrame, keys: list[str]) -> Column:
    require_columns(df, keys, "key column")
    return F.struct(*[F.col(k) for k in keys])


def _metadata(table: str, created_at: Column | None) -> Column:
    entries = [F.lit(METADATA_TABLE), F.lit(table)]
    if created_at is not None:
        entries += [F.lit("created_at"), created_at.cast("string")]
    return F.create_map(*entries)


def _position(mode: str, last: Column) -> Column:
    return F.struct(F.lit(mode).alias("mode"), last.alias("last_processed_val"))


def snapshot_records(
    rows: DataFrame,
    table: str,
    ordering: str,
    keys: list[str] | None = None,
    primary_keys: list[str] | None = None,
    columns: list[str] | None = None,
    ordered: bool = False,
) -> DataFrame:
    """One ``snapshot`` record per row of a point-in-time copy.

    Every row is read in one partitioned scan. The order of records matters only to a reader that
    stops half-way, so the range sort is left out unless asked for.
    """
    require_columns(rows, [ordering], "ordering column")
    payload = columns or rows.columns
    keys = key_columns(keys, primary_keys, ordering)
    require_columns(rows, payload, "column")
    absent = [c for c in [ordering, *keys] if c not in payload]
    if absent:
        raise ValueError(f"columns must include {', '.join(absent)}")
    if ordered:
        rows = rows.orderBy(F.col(ordering).asc_nulls_last())
    return rows.select(
        _position(MODE_SNAPSHOT, F.col(ordering)).alias("position"),
        F.lit("snapshot").alias("operation"),
        _metadata(table, F.current_timestamp()).alias("metadata"),
        F.lit(SNAPSHOT_SEQ).cast("bigint").alias("seq"),
        key_struct(rows, keys).alias("key"),
        F.struct(*[F.col(c) for c in payload]).alias("after"),
        F.array(*[F.lit(c) for c in payload]).alias("present"),
    )


def split_operations(feed: DataFrame) -> Split:
    """Rows of a tracking table with a known operation, and the rest."""
    known = F.col(OPERATION_TYPE).isin(*TRACKED_OPERATIONS)
    return split_on(
        feed, F.when(~F.coalesce(known, F.lit(False)), F.lit("unknown operation type"))
    )


def payload_columns(feed: DataFrame) -> list[str]:
    """The columns of a tracking table without its control columns."""
    return [c for c in feed.columns if c not in (TRACKING_ID, OPERATION_TYPE, CREATED_AT)]


def cdc_records(
    feed: DataFrame,
    table: str,
    ordering: str | None = None,
    keys: list[str] | None = None,
    primary_keys: list[str] | None = None,
) -> Split:
    """One record per row of a tracking table; a delete carries its key and no payload."""
    good, rejects = split_operations(feed)
    payload = payload_columns(feed)
    keys = key_columns(keys, primary_keys, ordering)
    operation = F.create_map(*[F.lit(x) for pair in TRACKED_OPERATIONS.items() for x in pair])
    is_delete = F.col(OPERATION_TYPE) == "delete"
    records = good.select(
        _position(MODE_CDC, F.col(TRACKING_ID)).alias("position"),
        operation[F.col(OPERATION_TYPE)].alias("operation"),
        _metadata(table, F.current_timestamp()).alias("metadata"),
        F.col(TRACKING_ID).alias("seq"),
        key_struct(feed, keys).alias("key"),
        F.when(~is_delete, F.struct(*[F.col(c) for c in payload])).alias("after"),
        F.when(~is_delete, F.array(*[F.lit(c) for c in payload])).alias("present"),
    )
    return Split(records, rejects)


def position_to_json(
    mode: Column,
    last: Column,
    tracking_table: Column | None = None,
    trigger: Column | None = None,
    snapshot_table: Column | None = None,
) -> Column:
    """A position as JSON text, every field written; NULL when there is no mode."""
    names = [tracking_table, trigger, snapshot_table]
    empty = F.lit("")
    fields = [mode, last, *[F.coalesce(c, empty) if c is not None else empty for c in names]]
    struct = F.struct(*[c.alias(n) for c, n in zip(fields, POSITION_FIELDS, strict=True)])
    return F.when(mode.isNotNull(), F.to_json(struct, {"ignoreNullFields": "false"}))


def _position_schema(value_type: str) -> str:
    return (
        f"mode string, last_processed_val {value_type}, tracking_table string, "
        "trigger string, snapshot_table string"
    )


def position_from_json(text: Column, value_type: str = "bigint") -> Column:
    """The position written in ``text``: NULL for NULL, an error for text that is no position."""
    parsed = F.from_json(text, _position_schema(value_type), {"mode": "FAILFAST"})
    return F.when(text.isNotNull(), parsed)


def split_positions(df: DataFrame, column: str, value_type: str = "bigint") -> Split:
    """Like ``position_from_json`` for a column in which bad text is set aside, not fatal.

    Bad is what is no JSON object, is cut off, or has a field of another type.
    """
    text = F.col(column)
    schema = _position_schema(value_type) + ", _corrupt string"
    parsed = evaluate_once(
        df, {"_parsed": F.from_json(text, schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})}
    )
    is_object = F.coalesce(text.rlike("^\\s*\\{"), F.lit(True))
    whole = is_object & F.col("_parsed._corrupt").isNull()
    good, rejects = split_on(parsed, F.when(~whole, F.lit("position is not a JSON object of its type")))
    fields = F.struct(*[F.col(f"_parsed.{name}").alias(name) for name in POSITION_FIELDS])
    return Split(good.withColumn(column, F.when(text.isNotNull(), fields)).drop("_parsed"), rejects.drop("_parsed"))


def resume_positions(records: DataFrame) -> DataFrame:
    """Per reading mode the last value processed: where a restarted reader goes on.

    Positions of both kinds are compared as what they are (see ``snapshot_then_cdc``); where one is
    a number and the other is not, the result has them as text.
    """
    mode = F.col("position.mode").alias("mode")
    last = F.max("position.last_processed_val")
    if "tracking_val" in records.schema["position"].dataType.names:
        last = F.coalesce(F.max("position.tracking_val").cast("string"), F.max("position.snapshot_val").cast("string"))
    return records.groupBy(mode).agg(last.alias("last_processed_val"))
