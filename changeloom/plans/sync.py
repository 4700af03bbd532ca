"""The target side end to end: JSON records into one or many keyed tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changeloom.names import REASON
from changeloom.operators.apply import apply_changes, apply_summary, keyless_inserts, split_unordered, summarise, without_key
from changeloom.operators.otherkeys import apply_any_key
from changeloom.operators.records import (
    UNKNOWN_TABLE,
    applied_prefix,
    parse_records,
    prefix_count,
    rejected,
    table_of,
    typed_records,
)
from changeloom.sources.scratch import new_folder
from changeloom.sources.versions import take_snapshot

# A summary is broadcast only when its rows were measured to be at most this. In the hash table of a
# broadcast they take about four times as much.
BROADCAST_BYTES = 64 << 20
# Parsing tasks per core, so that one that is slower than the others is not waited for long.
PARTS_PER_CORE = 3


def upper_schema(df: DataFrame) -> T.StructType:
    return T.StructType([T.StructField(f.name.upper(), f.dataType, True) for f in df.schema])


def land_records(
    records: DataFrame, schema: T.StructType, tables: list[str], default_table: str, default_key: str
) -> DataFrame:
    """JSON records as typed changes for tables of one schema (see ``typed_records``).

    They are written to the shared folder: parsing is the costly step, and the changes are read
    more than once afterwards. The records are spread first, so that all cores parse alike, however few
    files or partitions they come in.
    """
    parts = PARTS_PER_CORE * records.sparkSession.sparkContext.defaultParallelism
    spread = records.repartition(parts, "seq", "key_json", "after_json")
    typed = typed_records(parse_records(spread, default_table, default_key), schema, tables)
    return take_snapshot(typed, new_folder(records.sparkSession, "records"))


def apply_records(
    target: DataFrame, records: DataFrame, table: str, key: str, stop_at_first_bad: bool = False
) -> tuple[DataFrame, DataFrame]:
    """The target after the records that go to it, and the records set aside.

    With ``stop_at_first_bad`` only those before the first bad one are applied. Records may name
    different key columns (see ``otherkeys``).
    """
    after = target.toDF(*[c.upper() for c in target.columns])
    typed = land_records(records, upper_schema(target), [table], table, key)
    if stop_at_first_bad:
        good = applied_prefix(typed, "_seq", "_reason")
    else:
        good = typed.where(F.col("_reason").isNull())

    return apply_any_key(after, good, key.upper()).toDF(*target.columns), rejected(typed)


def apply_prefix(
    target: DataFrame, records: DataFrame, table: str, key: str
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """For writers that stop at the first failure: the target, the records set aside, and one row with
    how many records were acknowledged (``n_applied``).

    The records are parsed and landed once for all three.
    """
    upper = target.toDF(*[c.upper() for c in target.columns])
    typed = land_records(records, upper_schema(target), [table], table, key)
    after = apply_any_key(upper, applied_prefix(typed, "_seq", "_reason"), key.upper())
    return after.toDF(*target.columns), rejected(typed), prefix_count(typed, "_seq", "_reason")


def apply_routed(
    targets: dict[str, DataFrame],
    feed: DataFrame,
    key: str,
    columns: list[str],
    present: str | None = None,
    table: str = "table_name",
    seq: str = "seq",
    operation: str = "operation",
) -> DataFrame:
    """Many tables of one shape, in one pass: the table's name is a part of the key.

    ``table`` is the feed's column with that name; the result has it too. Rows for other tables
    must be set aside before (see ``reason_of``).
    """
    named = [target.withColumn(table, F.lit(name)) for name, target in targets.items()]
    together = reduce(DataFrame.unionByName, named)
    return apply_changes(together, feed, [table, key], columns, present, seq, operation)


def split_by_table(feed: DataFrame) -> DataFrame:
    """A feed for tables of many shapes, written once with a folder per table.

    A filter on ``table_name`` then reads the folder of that table only.
    """
    path = new_folder(feed.sparkSession, "routed")
    feed.write.partitionBy("table_name").parquet(path)
    # An empty feed leaves no file to take the columns from.
    return feed.sparkSession.read.schema(feed.schema).parquet(path)


def apply_to_tables(
    targets: dict[str, DataFrame], records: DataFrame, default_table: str, keys: dict[str, str]
) -> tuple[dict[str, DataFrame], DataFrame]:
    """Tables of many shapes after the records that go to each, and the records set aside.

    ``keys`` has the configured key column per table. The records are split by table first, so
    that each is parsed once, for its own table.
    """
    named = records.withColumn("table_name", table_of(default_table))
    known = F.col("table_name").isin(*[name.upper() for name in targets])
    # Names come from the data: only those of known tables may make folders.
    split = split_by_table(named.where(known))
    unknown = named.where(~F.coalesce(known, F.lit(False)))
    rejects = unknown.select("seq", "key_json", "after_json", F.lit(UNKNOWN_TABLE).alias(REASON))
    after = {}
    for name, target in targets.items():
        own = split.where(F.col("table_name") == name.upper()).drop("table_name")
        after[name], bad = apply_records(target, own, name, keys[name])
        rejects = rejects.unionByName(bad)
    return after, rejects


def apply_measured(
    target: DataFrame,
    feed: DataFrame,
    key: str,
    columns: list[str],
    present: str | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Like ``apply_changes``, for a target much larger than the feed.

    The summary is written first. When its size in memory, estimated from rows and row width, is
    below the limit it is broadcast and the target is read without a shuffle; else both sides are
    shuffled as usual. Rows without an order change nothing.
    """
    spark = feed.sparkSession
    feed = split_unordered(feed).good
    path = new_folder(spark, "summary")
    summarise(feed.where(~without_key(feed, key)), key, columns, present).write.parquet(path)
    summary = spark.read.parquet(path)
    size = summary.agg(F.sum(_row_bytes(summary.schema))).first()[0] or 0
    applied = apply_summary(target, summary, key, columns, broadcast_summary=size <= broadcast_bytes)
    return applied.unionByName(keyless_inserts(target, feed, key, columns, present))


def _row_bytes(schema: T.StructType):
    """Bytes of a row: eight per column and the row header, and the length of what is variable."""
    size = F.lit(8 * (len(schema) + 2)).cast("bigint")
    for field in schema:
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            size = size + F.coalesce(F.octet_length(field.name), F.lit(0))
        elif not isinstance(field.dataType, (T.NumericType, T.BooleanType, T.DatetimeType)):
            size = size + F.coalesce(F.octet_length(F.to_json(F.struct(field.name))), F.lit(0))
    return size
