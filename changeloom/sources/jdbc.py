"""Database tables over JDBC, as snapshot source, change source and apply target."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from changeloom.names import MAX_BATCH_SIZE, MIN_BATCH_SIZE, TRACKING_ID


def scan_options(
    url: str,
    table: str | None = None,
    query: str | None = None,
    partition_column: str | None = None,
    bounds: tuple[Any, Any] | None = None,
    partitions: int | None = None,
    fetch_size: int = 10000,
    driver: str | None = None,
) -> dict[str, str]:
    """Reader options of a scan; with a partition column the table is read by many tasks.

    The bounds only say how the range is cut: rows outside them, and NULLs, are read as well.
    The parts are separate statements. For one instant in all of them let ``table`` name a copy
    or a flashback query in the database.
    """
    if (table is None) == (query is None):
        raise ValueError("give either a table or a query")
    options = {"url": url, "fetchsize": str(fetch_size)}
    if driver:
        options["driver"] = driver
    if partition_column is None:
        options["dbtable" if table else "query"] = table or query
        return options
    if bounds is None or not partitions:
        raise ValueError("a partition column needs bounds and a number of partitions")
    # A query can be partitioned only as a sub-query in place of a table.
    options["dbtable"] = table or f"({query}) part_source"
    options["partitionColumn"] = partition_column
    options["lowerBound"], options["upperBound"] = str(bounds[0]), str(bounds[1])
    options["numPartitions"] = str(partitions)
    return options


def scan(spark: SparkSession, url: str, table: str | None = None, **options: Any) -> DataFrame:
    """A table or query as a DataFrame; filters and column choice reach the database."""
    return spark.read.format("jdbc").options(**scan_options(url, table, **options)).load()


def page_query(
    table: str, ordering: str, after: int | None, limit: int, columns: list[str] | None = None
) -> str:
    """One ordered page as a query, for databases in which sort and limit should run."""
    if not MIN_BATCH_SIZE <= limit <= MAX_BATCH_SIZE:
        raise ValueError(f"batch size must lie in {MIN_BATCH_SIZE}..{MAX_BATCH_SIZE}")
    chosen = ", ".join(columns) if columns else "*"
    condition = "" if after is None else f" WHERE {ordering} > {int(after)}"
    return (
        f"SELECT {chosen} FROM {table}{condition} ORDER BY {ordering} ASC FETCH NEXT {limit} ROWS ONLY"
    )


def changes_after(
    spark: SparkSession, url: str, tracking_table: str, after: int | None = None, **options: Any
) -> DataFrame:
    """The rows of a tracking table beyond a position."""
    feed = scan(spark, url, tracking_table, **options)
    return feed if after is None else feed.where(feed[TRACKING_ID] > after)


def write(
    df: DataFrame, url: str, table: str, mode: str = "append", batch_size: int = 1000, **options: str
) -> None:
    """Rows into a database table, in batches per task.

    A task that is run again writes its rows again, so let ``table`` be a staging table that the
    database merges by key, or write the whole new state with ``mode="overwrite"``.
    """
    settings = {"url": url, "dbtable": table, "batchsize": str(batch_size), **options}
    if mode == "overwrite":
        settings.setdefault("truncate", "true")
    df.write.format("jdbc").options(**settings).mode(mode).save()


def stage_batches(stream: DataFrame, url: str, table: str, **options: str) -> DataStreamWriter:
    """A stream into a staging table. Rows carry the number of their micro-batch, by which the
    database can tell a batch that was written twice."""

    def stage(batch: DataFrame, batch_id: int) -> None:
        write(batch.withColumn("batch_id", F.lit(batch_id)), url, table, **options)

    return stream.writeStream.foreachBatch(stage)
