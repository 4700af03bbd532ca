"""Applying a feed to the parts of a target that it touches.

The target lies in folders by a hash of its key. A feed that meets a sliver of it reads and rewrites the parts of its
keys only; files of other parts stay as they are, with their names and times.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changeloom.operators.apply import apply_changes, without_key
from changeloom.sources.scratch import new_folder

PART = "_part"


def part_of(df: DataFrame, key: str | list[str], parts: int) -> Column:
    """The number of a row's part: by the key, or, for rows without one, below zero and by the whole row.

    No change ever meets a row without a key, so such rows need not lie together, and equal NULLs would.
    """
    keys = [key] if isinstance(key, str) else list(key)
    # The same value has the same part in target and feed, whatever their types are.
    keyed = F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in keys]), F.lit(parts))
    content = [F.col(f.name) for f in df.schema if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    keyless = -1 - F.pmod(F.xxhash64(*content), F.lit(parts))
    return F.when(without_key(df, keys), keyless).otherwise(keyed).cast("int")


class Staged(NamedTuple):
    """Rewritten parts that wait to take their place."""

    folder: str
    parts: list[int]


class PartitionedTarget:
    """A table under ``path`` in ``parts`` parts by the hash of its key. One writer at a time.

    Choose ``parts`` so that one is a few hundred MB: the parts that a feed meets are read and written whole, and their
    numbers, nothing else, reach the driver.
    """

    def __init__(self, spark: SparkSession, path: str, key: str | list[str], schema: T.StructType, parts: int):
        self.spark, self.path, self.key, self.schema, self.parts = spark, path.rstrip("/"), key, schema, parts

    def _stored(self) -> DataFrame:
        return self.spark.read.schema(T.StructType([*self.schema, T.StructField(PART, T.IntegerType())])).parquet(self.path)

    def read(self) -> DataFrame:
        return self._stored().drop(PART)

    def _write(self, rows: DataFrame, path: str, mode: str) -> None:
        marked = rows.select(*self.schema.names).withColumn(PART, part_of(rows, self.key, self.parts))
        # Adaptive execution splits parts that are large and puts small ones together, a folder per part all the same.
        marked.hint("rebalance", PART).write.partitionBy(PART).mode(mode).parquet(path)

    def create(self, rows: DataFrame) -> None:
        self._write(rows, self.path, "errorifexists")

    def stage(self, feed: DataFrame, columns: list[str], present: str | None = None, seq: str | list[str] = "seq", operation: str = "operation") -> Staged:
        """Work out the parts that the feed touches, without a change of the table."""
        keyless = without_key(feed, self.key)
        # What a record without a key becomes is known only when it is applied: its part is new, not touched.
        met = feed.where(~keyless).select(part_of(feed, self.key, self.parts).alias(PART)).distinct()
        touched = sorted(row[0] for row in met.collect())
        held = self._stored().where(F.col(PART).isin(touched)).drop(PART)
        after = apply_changes(held, feed.where(~keyless), self.key, columns, present, seq, operation)
        folder = new_folder(self.spark, "touched")
        self._write(after, f"{folder}/keyed", "errorifexists")
        fresh = apply_changes(held.limit(0), feed.where(keyless), self.key, columns, present, seq, operation)
        fresh_parts = fresh.select(part_of(fresh, self.key, self.parts).alias(PART)).distinct()
        more = sorted(row[0] for row in fresh_parts.collect())
        if more:
            beside = self._stored().where(F.col(PART).isin(more)).drop(PART)
            self._write(beside.unionByName(fresh), f"{folder}/keyless", "errorifexists")
        return Staged(folder, touched + more)

    def publish(self, staged: Staged) -> None:
        """Put the parts in their places. After a failure in between, publish them once more: that changes nothing else."""
        there = set()
        for kind, wanted in (("keyed", [p for p in staged.parts if p >= 0]), ("keyless", [p for p in staged.parts if p < 0])):
            if not wanted:
                continue
            schema = T.StructType([*self.schema, T.StructField(PART, T.IntegerType())])
            rows = self.spark.read.schema(schema).parquet(f"{staged.folder}/{kind}")
            there |= {row[0] for row in rows.select(PART).distinct().collect()}
            rows.hint("rebalance", PART).write.partitionBy(PART).mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(self.path)
        # An overwrite by partition says nothing about those that have lost all their rows.
        nothing = self.spark.createDataFrame([], self.schema)
        for part in staged.parts:
            if part not in there:
                nothing.write.mode("overwrite").parquet(f"{self.path}/{PART}={part}")

    def apply(self, feed: DataFrame, columns: list[str], present: str | None = None, seq: str | list[str] = "seq", operation: str = "operation") -> None:
        self.publish(self.stage(feed, columns, present, seq, operation))
