"""Tailing a tracking table with Structured Streaming.

The table is landed as files; a stream reads each file once and keeps its position in the
checkpoint. Files per micro-batch are the bound that a page size is for a database reader (``tail``), or rows
are, and the position is a tracking id (``tail_rows``).
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from changeloom.names import DEFAULT_BATCH_SIZE, TRACKING_ID
from changeloom.sources.scratch import new_folder
from changeloom.sources.tracking import TrackingSource
from changeloom.sources.versions import take_snapshot


# Rows of a landed file at most, so that a number of files bounds a micro-batch.
ROWS_PER_FILE = 1_000_000
# Files per core, where their number is left open: a micro-batch may then be a part of them and still have one for each core.
FILES_PER_CORE = 3


def land(
    feed: DataFrame, path: str, files: int | None = None, rows_per_file: int = ROWS_PER_FILE
) -> None:
    """Append changes to a landing folder as files of neighbouring tracking ids.

    ``files`` is how many tasks write; a task starts a new file after ``rows_per_file`` rows.
    """
    files = files or FILES_PER_CORE * feed.sparkSession.sparkContext.defaultParallelism
    ranged = feed.repartitionByRange(files, F.col(TRACKING_ID))
    ranged.write.mode("append").option("maxRecordsPerFile", rows_per_file).parquet(path)


# Ids per folder of the record of what has landed.
BLOCK_OF_IDS = 1_000_000


def landed_ids(spark: SparkSession, path: str) -> DataFrame | None:
    """The tracking ids that have landed, purged files included; None before the first landing."""
    try:
        return spark.read.schema(f"{TRACKING_ID} bigint, block bigint").parquet(f"{path.rstrip('/')}.landed")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def land_new(feed: DataFrame, path: str, files: int | None = None) -> None:
    """Append what a tracking table holds and has not landed yet; run it as often as wanted.

    Landed ids are kept beside the landing folder, in blocks of neighbouring ids, so files may be purged
    and a change that is committed late, with a lower id, is still found. Only the blocks that the
    tracking table has ids of are read: its purge bounds the work. Should the job stop between
    the two writes, changes land twice, which does not matter to ``ChangeSink``.
    """
    spark, block = feed.sparkSession, F.floor(F.col(TRACKING_ID) / BLOCK_OF_IDS).alias("block")
    known = landed_ids(spark, path)
    new = feed.where(F.col(TRACKING_ID).isNotNull())
    if known is not None:
        bounds = new.agg(F.min(block).alias("low"), F.max(block).alias("high")).first()
        seen = known.where(F.col("block").between(bounds.low, bounds.high)).select(TRACKING_ID)
        new = new.join(seen, TRACKING_ID, "left_anti").select(*feed.columns)
    # Written first: the tracking table may grow between the two writes below.
    new = take_snapshot(new, new_folder(spark, "landing"))
    if new.isEmpty():
        return
    land(new, path, files)
    ids = new.select(TRACKING_ID, block).repartition("block")
    ids.write.mode("append").partitionBy("block").parquet(f"{path.rstrip('/')}.landed")


def tail(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    max_files: int | None = None,
    max_bytes: str | None = None,
    after: int | None = None,
    purge: str = "off",
) -> DataFrame:
    """The landing folder as a stream.

    ``after`` is the position of a first start; later ones go on from their checkpoint. With
    ``purge`` = ``delete`` (or ``archive``) Spark removes a file once its batch is committed, so a
    record leaves the landing folder only after it was acknowledged.
    """
    reader = spark.readStream.schema(schema).option("cleanSource", purge)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if max_bytes is not None:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    stream = reader.parquet(path)
    return stream if after is None else stream.where(F.col(TRACKING_ID) > after)


ROW_ID = ["_source_file", "_source_row"]


def with_row_id(stream: DataFrame) -> DataFrame:
    """The rows of ``tail`` with what tells them apart in every reading: their file and their place in it."""
    place = [F.col("_metadata.file_path"), F.col("_metadata.row_index")]
    return stream.select("*", *[c.alias(name) for c, name in zip(place, ROW_ID, strict=True)])


def tail_rows(
    spark: SparkSession, path: str, schema: T.StructType, rows: int = DEFAULT_BATCH_SIZE, after: int | None = None, purge: bool = False
) -> DataFrame:
    """The landing folder as a stream with ``rows`` changes per micro-batch, in order of their ids.

    With ``purge`` files leave the folder once all their changes are in a committed batch.
    """
    spark.dataSource.register(TrackingSource)
    reader = spark.readStream.format("tracking").schema(schema).option("path", path).option("rowsPerBatch", rows)
    reader = reader.option("purge", str(purge).lower())
    return (reader if after is None else reader.option("after", after)).load()


def start(writer: DataStreamWriter, checkpoint: str, interval: str | None = None) -> StreamingQuery:
    """Start a stream that resumes from ``checkpoint``: polling at an interval, or until it has
    read what is there."""
    writer = writer.option("checkpointLocation", checkpoint)
    if interval is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=interval).start()
