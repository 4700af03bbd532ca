"""Versioned tables whose folders are all bucketed by one key.

Rows of one key lie in the same bucket of each write, so writes are merged, and joined with a target bucketed
alike, bucket by bucket where they lie: no shuffle. Each write is a partition of one external table, so that one scan
reads the same bucket of all. Spark knows of buckets through its catalog alone: the table is declared there
when it is read, in a new session as in the one that wrote it.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changeloom.sources.versions import Entry, VersionedTable


# The column that names the write a row came with.
ENTRY = "entry"


def declare_bucketed(spark: SparkSession, path: str, schema: T.StructType, key: str, buckets: int, partition: str | None = None) -> DataFrame:
    """A folder of rows that were written with ``write_bucketed``, with its buckets known.

    With ``partition`` they lie in folders by the text of that column.
    """
    name = _name(path)
    if not spark.catalog.tableExists(name):
        columns = [f"`{f.name}` {f.dataType.simpleString()}" for f in schema]
        parted = ""
        if partition:
            columns.append(f"`{partition}` string")
            parted = f"PARTITIONED BY (`{partition}`)"
        location = path.replace("'", "\\'")
        spark.sql(
            f"CREATE TABLE {name} ({', '.join(columns)}) USING parquet {parted} CLUSTERED BY (`{key}`) INTO {buckets} BUCKETS LOCATION '{location}'"
        )
    spark.catalog.refreshTable(name)
    return spark.table(name)


def write_bucketed(df: DataFrame, path: str, key: str, buckets: int, is_dealt: bool = False) -> None:
    """Write rows into ``buckets`` buckets of ``key``. Say ``is_dealt`` when they are partitioned so already."""
    dealt = df if is_dealt else df.repartition(buckets, key)
    writer = dealt.write.format("parquet").bucketBy(buckets, key).mode("overwrite")
    name = f"{_name(path)}_written"
    writer.option("path", path).saveAsTable(name)
    # The table was a way to write; its files stay.
    df.sparkSession.sql(f"DROP TABLE {name}")


def _name(path: str) -> str:
    return "changeloom_" + hashlib.sha256(path.encode()).hexdigest()[:32]


class BucketedTable(VersionedTable):
    """A versioned table in ``buckets`` buckets of ``key``."""

    def __init__(self, spark: SparkSession, root: str, key: str, buckets: int):
        super().__init__(spark, root)
        self.key, self.buckets = key, buckets
        self.is_dealt = False

    def _folder(self, number: int) -> str:
        return f"{ENTRY}={number}-{uuid.uuid4().hex}"

    def _write(self, df: DataFrame, folder: str) -> None:
        # Buckets without rows have no file that could tell the columns.
        df.limit(0).write.mode("ignore").parquet(f"{self.root}/_columns")
        write_bucketed(df, f"{self.root}/{folder}", self.key, self.buckets, self.is_dealt)

    def read_entries(self, entries: list[Entry]) -> DataFrame:
        schema = self.spark.read.parquet(f"{self.root}/_columns").schema
        declare_bucketed(self.spark, self.root, schema, self.key, self.buckets, ENTRY)
        names = [e.folder.split("=")[1] for e in entries]
        added = " ".join(f"PARTITION ({ENTRY} = '{name}')" for name in names)
        self.spark.sql(f"ALTER TABLE {_name(self.root)} ADD IF NOT EXISTS {added}")
        return self.spark.table(_name(self.root)).where(F.col(ENTRY).isin(names)).drop(ENTRY)

    def replace_dealt(self, df: DataFrame, first: int, level: int) -> int:
        """Like ``replace``, for rows that come from buckets and still lie so."""
        self.is_dealt = True
        try:
            return self.replace(df, first, level)
        finally:
            self.is_dealt = False
