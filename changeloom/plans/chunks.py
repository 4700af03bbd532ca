"""A snapshot in chunks, taken while the table changes.

Instead of one copy of one instant, the table is read chunk by chunk, in ranges of an ordering column, each with the
position of the change feed before (``low``) and after (``high``) it was read. A row that the feed changed in between
may be of before or after its change: it is left out, and its change, which comes through the feed, stands
for it. The other rows are as they were at both positions. With the feed from the first chunk's ``low`` on they give
the table, whatever happened meanwhile. A run that is stopped goes on at the first chunk that was not written.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changeloom.names import TRACKING_ID, require_columns

DONE = "chunk int, low bigint, high bigint"


class Chunk(NamedTuple):
    """Rows with ``after < ordering <= upto``; None is no bound. The last chunk has the NULLs too."""

    number: int
    after: object
    upto: object


def chunk_ranges(table: DataFrame, ordering: str, chunks: int) -> list[Chunk]:
    """Ranges with about as many rows each: a few numbers, from one pass of partial sketches."""
    require_columns(table, [ordering], "column")
    shares = [i / chunks for i in range(1, chunks)]
    found = table.agg(F.percentile_approx(ordering, shares)).first()[0] if shares else []
    edges = sorted(set(found or []))
    return [Chunk(i, a, b) for i, (a, b) in enumerate(zip([None, *edges], [*edges, None]))]


def _within(chunk: Chunk, ordering: str) -> list:
    value, tests = F.col(ordering), []
    if chunk.after is not None:
        above = value > F.lit(chunk.after)
        tests.append(above | value.isNull() if chunk.upto is None else above)
    if chunk.upto is not None:
        tests.append(value <= F.lit(chunk.upto))
    return tests


class ChunkedSnapshot:
    """Writes chunks under ``root``, a folder each, and a row for each one that is complete.

    ``read_table`` reads the table as it is at that moment, ``read_feed`` the tracking table, and ``position`` is its last
    committed id. The feed must still hold what is newer than the first chunk.
    """

    def __init__(
        self, spark: SparkSession, root: str, keys: list[str], ordering: str,
        read_table: Callable[[], DataFrame], read_feed: Callable[[], DataFrame], position: Callable[[], int],
    ):
        self.spark, self.root, self.keys, self.ordering = spark, root.rstrip("/"), keys, ordering
        self.read_table, self.read_feed, self.position = read_table, read_feed, position

    def done(self) -> DataFrame:
        """``(chunk, low, high)`` of complete chunks: where a reader of the feed has to begin, and a restart."""
        try:
            return self.spark.read.schema(DONE).parquet(f"{self.root}/done")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], DONE)

    def take(self, chunk: Chunk) -> None:
        low = self.position()
        rows = self.read_table()
        for test in _within(chunk, self.ordering):
            rows = rows.where(test)
        folder = f"{self.root}/chunks/chunk={chunk.number}"
        # A half-written folder of an earlier run is replaced.
        rows.write.mode("overwrite").parquet(f"{self.root}/read/chunk={chunk.number}")
        high = self.position()
        changed = self.read_feed().where((F.col(TRACKING_ID) > low) & (F.col(TRACKING_ID) <= high)).select(*self.keys).distinct()
        kept = self.spark.read.schema(rows.schema).parquet(f"{self.root}/read/chunk={chunk.number}").join(changed, self.keys, "left_anti")
        kept.select(*rows.columns).withColumn("seq", F.lit(low).cast("bigint")).write.mode("overwrite").parquet(folder)
        row = [(chunk.number, low, high)]
        self.spark.createDataFrame(row, DONE).coalesce(1).write.mode("append").parquet(f"{self.root}/done")

    def run(self, chunks: list[Chunk]) -> None:
        """All chunks that are not complete. Ask for the same ranges as the run that was stopped."""
        complete = {row["chunk"] for row in self.done().collect()}
        for chunk in chunks:
            if chunk.number not in complete:
                self.take(chunk)

    def rows(self) -> DataFrame:
        """The rows of complete chunks, with the position at which they held as ``seq``."""
        complete = [row["chunk"] for row in self.done().select("chunk").distinct().collect()]
        return self.spark.read.parquet(*[f"{self.root}/chunks/chunk={number}" for number in sorted(complete)])
