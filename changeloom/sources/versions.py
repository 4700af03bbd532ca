"""Tables kept as immutable folders and a log.

Plain parquet has no MERGE and must not be overwritten while it is read. So each new state of a
table, or each addition to it, is written to a folder of its own, and afterwards one row that names
the folder is appended to a small log. A reader follows the log, so it sees no half-written folder.
"""

from __future__ import annotations

import uuid
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class Entry(NamedTuple):
    """A write: its number, its folder, the first entry it stands for, and how often its rows
    have been put together with others."""

    number: int
    folder: str
    first: int
    level: int


_LOG_SCHEMA = "number bigint, folder string, first bigint, level int"


class VersionedTable:
    """A table under ``root``. One writer at a time, any number of readers."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._live: list[Entry] | None = None

    def _log(self) -> DataFrame | None:
        try:
            return self.spark.read.schema(_LOG_SCHEMA).parquet(f"{self.root}/_entries")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def own_entries(self) -> list[Entry]:
        """The live writes as the one writer knows them, without reading the log each time."""
        if self._live is None:
            self._live = self.live_entries()
        return self._live

    def last_entry(self) -> int:
        """The number of the last write; -1 when there was none."""
        return self.own_entries()[-1].number if self.own_entries() else -1

    def live_entries(self, through: int | None = None) -> list[Entry]:
        """The writes that make up the table, now or after an earlier write, oldest first.

        Only names are collected: one for the last full state and one for each write since then.
        """
        log = self._log()
        if log is None:
            return []
        if through is not None:
            log = log.where(F.col("number") <= through)
        full = log.where("first = 0").agg(F.coalesce(F.max("number"), F.lit(0))).scalar()
        recent = log.where(F.col("number") >= full).orderBy(F.col("number").desc())
        live: list[Entry] = []
        for row in recent.collect():
            if not live or row.number < live[-1].first:
                live.append(Entry(*row))
        return live[::-1]

    def read_entries(self, entries: list[Entry]) -> DataFrame:
        return self.spark.read.parquet(*[f"{self.root}/{entry.folder}" for entry in entries])

    def read(self, through: int | None = None) -> DataFrame:
        """The table now, or as it was after an earlier write."""
        entries = self.live_entries(through)
        if not entries:
            raise ValueError(f"nothing was written to {self.root}")
        return self.read_entries(entries)

    def _folder(self, number: int) -> str:
        return f"part-{number}-{uuid.uuid4().hex}"

    def _write(self, df: DataFrame, folder: str) -> None:
        df.write.parquet(f"{self.root}/{folder}")

    def append(self, df: DataFrame) -> int:
        """Add the rows of ``df``."""
        return self.replace(df, first=self.last_entry() + 1)

    def replace(self, df: DataFrame, first: int = 0, level: int = 0) -> int:
        """Put ``df``, which may be built from earlier writes, in the place of all since ``first``."""
        number = self.last_entry() + 1
        entry = Entry(number, self._folder(number), first, level)
        self._write(df, entry.folder)
        row = self.spark.range(1).select(
            F.lit(number).cast("bigint").alias("number"),
            F.lit(entry.folder).alias("folder"),
            F.lit(first).cast("bigint").alias("first"),
            F.lit(level).alias("level"),
        )
        row.coalesce(1).write.mode("append").parquet(f"{self.root}/_entries")
        self._live = [e for e in self.own_entries() if e.number < first] + [entry]
        return number


def take_snapshot(df: DataFrame, path: str) -> DataFrame:
    """A point-in-time copy: later changes of the source do not reach it."""
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
