"""Queries that run Structured Streaming over a landed change feed, and return what it produced."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changeloom.names import TRACKING_ID
from changeloom.operators import envelope
from changeloom.operators.apply import apply_changes
from changeloom.plans.chunks import ChunkedSnapshot, chunk_ranges
from changeloom.sources.bucketed import declare_bucketed, write_bucketed
from changeloom.sources.scratch import new_folder
from changeloom.streaming.prefix import PrefixSink
from changeloom.streaming.sink import ChangeSink, RecordSink, RoutedSink
from changeloom.streaming.tail import ROW_ID, land, land_new, start, tail, tail_rows, with_row_id
from workload.apply_queries import COLUMNS, FULL_SQL, OTHER_KEY_SQL, PARTIAL_SQL, TABLES, applied_sql, records_by_code, target_with_code
from workload.apply_queries import QUERIES as APPLY_QUERIES
from workload.fixtures import TRACKING_SQL, apply_target, change_feed, json_records, tracking_table
from workload.registry import Registry

QUERIES = Registry()

_RECORDS_SQL = f"""
WITH {TRACKING_SQL}
SELECT CONNECTOR_TRACKING_ID AS seq,
       CASE CONNECTOR_OPERATION_TYPE WHEN 'insert' THEN 'create' ELSE CONNECTOR_OPERATION_TYPE END
         AS operation,
       K AS k, CASE WHEN CONNECTOR_OPERATION_TYPE <> 'delete' THEN VALUE END AS value
FROM tracking"""


def _batch_files(spark: SparkSession) -> int:
    """Files per micro-batch, so that a landed feed makes a few batches at any size, each with a file for every core."""
    return spark.sparkContext.defaultParallelism


def _share_of_files(spark: SparkSession, landing: str, schema, batches: int = 12) -> int:
    """Files per micro-batch of a folder of files of fixed size, two at least, so that batches grow with it and not in number."""
    return max(2, -(-len(spark.read.schema(schema).parquet(landing).inputFiles()) // batches))


def _tail_into(
    spark: SparkSession, landing: str, out: str, checkpoint: str, schema, purge: str = "off"
) -> None:
    stream = tail(spark, landing, schema, max_files=_batch_files(spark), purge=purge)
    records = envelope.cdc_records(stream, "CUSTOMER", keys=["K"]).good
    flat = records.select(
        "seq", "operation", F.col("key.K").alias("k"), F.col("after.VALUE").alias("value")
    )
    start(flat.writeStream.format("parquet").option("path", out), checkpoint).awaitTermination()


@QUERIES.add(_RECORDS_SQL)
def stream_tail(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = new_folder(spark, "stream-tail")
    feed = tracking_table(spark, sf_dir)
    land(feed, f"{root}/landing")
    _tail_into(spark, f"{root}/landing", f"{root}/out", f"{root}/checkpoint", feed.schema)
    return spark.read.parquet(f"{root}/out")


@QUERIES.add(_RECORDS_SQL)
def stream_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two parts of the feed land one after the other; the second run reads only what is new."""
    root = new_folder(spark, "stream-resume")
    feed = tracking_table(spark, sf_dir)
    halfway = feed.agg((F.max(TRACKING_ID) / 2).cast("bigint")).scalar()
    for part in (feed.where(F.col(TRACKING_ID) <= halfway), feed.where(F.col(TRACKING_ID) > halfway)):
        land(part, f"{root}/landing")
        _tail_into(spark, f"{root}/landing", f"{root}/out", f"{root}/checkpoint", feed.schema)
    return spark.read.parquet(f"{root}/out")


def _landable(feed: DataFrame) -> DataFrame:
    return feed.withColumn(TRACKING_ID, F.col("seq"))


def _stream_into(spark: SparkSession, sink: ChangeSink, landing: str, checkpoint: str, schema) -> None:
    stream = tail(spark, landing, schema, max_files=_batch_files(spark))
    start(sink.writer(stream), checkpoint).awaitTermination()


@QUERIES.add(PARTIAL_SQL)
def stream_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole feed is applied twice: a second reader starts from the beginning."""
    root = new_folder(spark, "stream-replay")
    feed = _landable(change_feed(spark, sf_dir))
    land(feed, f"{root}/landing")
    sink = ChangeSink(spark, f"{root}/changes", "k", COLUMNS, present="present", merge_every=3)
    for run in (1, 2):
        _stream_into(spark, sink, f"{root}/landing", f"{root}/checkpoint-{run}", feed.schema)
    return sink.current(apply_target(spark, sf_dir))


@QUERIES.add(FULL_SQL)
def stream_bootstrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshot records fill an empty target, then the stream of changes goes on top."""
    root = new_folder(spark, "stream-bootstrap")
    snapshot = envelope.snapshot_records(apply_target(spark, sf_dir), "CUSTOMER", "k")
    sink = ChangeSink(spark, f"{root}/changes", "k", COLUMNS)
    sink.write_batch(snapshot.select("seq", "operation", "after.*"))
    feed = _landable(change_feed(spark, sf_dir)).drop("present")
    land(feed, f"{root}/landing")
    _stream_into(spark, sink, f"{root}/landing", f"{root}/checkpoint", feed.schema)
    return sink.current(apply_target(spark, sf_dir).limit(0))


@QUERIES.add(PARTIAL_SQL)
def late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deletes and purchases land after all other changes, though many have lower ids."""
    root = new_folder(spark, "stream-late")
    feed = _landable(change_feed(spark, sf_dir))
    is_late = F.col("event_type").isin("error", "purchase")
    sink = ChangeSink(spark, f"{root}/changes", "k", COLUMNS, present="present")
    for part in (feed.where(~is_late), feed.where(is_late)):
        land(part, f"{root}/landing")
        _stream_into(spark, sink, f"{root}/landing", f"{root}/checkpoint", feed.schema)
    return sink.current(apply_target(spark, sf_dir))


@QUERIES.add(PARTIAL_SQL)
def stream_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON records as they come, parsed, checked and applied batch by batch."""
    root = new_folder(spark, "stream-records")
    records = json_records(spark, sf_dir).drop("k").withColumn(
        "metadata", F.create_map().cast("map<string,string>")
    )
    feed = _landable(records)
    land(feed, f"{root}/landing")
    target = apply_target(spark, sf_dir)
    sink = RecordSink(spark, f"{root}/sink", target.schema, "CUSTOMER", "k")
    stream = tail(spark, f"{root}/landing", feed.schema, max_files=_batch_files(spark))
    start(sink.writer(stream), f"{root}/checkpoint").awaitTermination()
    return sink.current(target)


@QUERIES.add("""
SELECT CASE WHEN c_custkey % 3 <> 0 THEN c_custkey END AS k, c_acctbal AS value, c_mktsegment AS props FROM customer""")
def stream_bootstrap_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A snapshot in which a third of the rows have no key; the batch is applied twice."""
    rows = apply_target(spark, sf_dir).withColumn("k", F.when(F.col("k") % 3 != 0, F.col("k")))
    snapshot = envelope.snapshot_records(rows, "CUSTOMER", "k").select("seq", "operation", "after.*")
    sink = ChangeSink(spark, f"{new_folder(spark, 'stream-null-keys')}/changes", "k", COLUMNS)
    for _ in range(2):
        sink.write_batch(snapshot)
    return sink.current(rows.limit(0))


@QUERIES.add("SELECT c_custkey AS k, c_acctbal + 1 AS value, c_mktsegment AS props FROM customer")
def stream_resnapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two snapshots of one table: the one with the higher number counts, in whatever order they come."""
    rows = apply_target(spark, sf_dir)
    sink = ChangeSink(
        spark, f"{new_folder(spark, 'stream-resnapshot')}/changes", "k", COLUMNS, seq=["seq", "snapshot_no"], merge_every=2
    )
    for number, part in ((2, rows.withColumn("value", F.col("value") + 1)), (1, rows), (1, rows)):
        snapshot = envelope.snapshot_records(part, "CUSTOMER", "k").select("seq", "operation", "after.*")
        sink.write_batch(snapshot.withColumn("snapshot_no", F.lit(number)))
    return sink.current(rows.limit(0))


@QUERIES.add(_RECORDS_SQL)
def stream_purge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landing, reading and purging in turn, several times over the growing tracking table: no change
    is read twice, though the files it came in are gone."""
    root = new_folder(spark, "stream-purge")
    feed = tracking_table(spark, sf_dir)
    most = feed.agg(F.max(TRACKING_ID)).first()[0]
    for share in (1, 2, 3, 3):
        land_new(feed.where(F.col(TRACKING_ID) <= most * share / 3), f"{root}/landing", files=2)
        _tail_into(spark, f"{root}/landing", f"{root}/out", f"{root}/checkpoint", feed.schema, "delete")
    return spark.read.parquet(f"{root}/out")


@QUERIES.add(_RECORDS_SQL)
def land_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deletes are committed last, though many have lower ids than what has landed."""
    root = new_folder(spark, "land-late")
    feed = tracking_table(spark, sf_dir)
    for part in (feed.where("CONNECTOR_OPERATION_TYPE <> 'delete'"), feed, feed):
        land_new(part, f"{root}/landing")
    _tail_into(spark, f"{root}/landing", f"{root}/out", f"{root}/checkpoint", feed.schema)
    return spark.read.parquet(f"{root}/out")


@QUERIES.add(APPLY_QUERIES["apply_routed"].sql)
def stream_routed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON records of one stream into a table per event type."""
    root = new_folder(spark, "stream-routed")
    feed = _landable(json_records(spark, sf_dir).drop("k"))
    land(feed, f"{root}/landing")
    target = apply_target(spark, sf_dir)
    sink = RoutedSink(spark, f"{root}/sink", {name: (target.schema, "k") for name in TABLES}, "T_OTHER")
    stream = tail(spark, f"{root}/landing", feed.schema)
    start(sink.writer(stream), f"{root}/checkpoint").awaitTermination()
    tables = sink.current({name: target for name in TABLES})
    named = [after.select(F.lit(name).alias("table_name"), "*") for name, after in tables.items()]
    return reduce(DataFrame.unionByName, named)


@QUERIES.add(OTHER_KEY_SQL)
def stream_other_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of two key columns, in micro-batches that are not in order, and read twice."""
    root = new_folder(spark, "stream-other-key")
    feed, target = _landable(records_by_code(spark, sf_dir)), target_with_code(spark, sf_dir)
    land(feed, f"{root}/landing")
    sink = RecordSink(spark, f"{root}/sink", target.schema, "CUSTOMER", "k", any_key=True)
    for run in (1, 2):
        stream = tail(spark, f"{root}/landing", feed.schema, max_files=_batch_files(spark))
        start(sink.writer(stream), f"{root}/checkpoint-{run}").awaitTermination()
    return sink.current(target)


@QUERIES.add(f"""
WITH {TRACKING_SQL},
n AS (SELECT CONNECTOR_TRACKING_ID AS id, row_number() OVER (ORDER BY CONNECTOR_TRACKING_ID) AS r, count(*) OVER () // 4 + 1 AS size FROM tracking)
SELECT (r - 1) // size AS batch, count(*) AS n_rows, min(id) AS first_id, max(id) AS last_id FROM n GROUP BY batch""")
def stream_rows_bound(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four micro-batches of one number of rows; the first two are read by a run that is stopped."""
    root = new_folder(spark, "stream-rows")
    feed = tracking_table(spark, sf_dir)
    size = feed.count() // 4 + 1
    land(feed, f"{root}/landing", files=7)

    def write(batch: DataFrame, number: int) -> None:
        figures = batch.agg(F.count("*").alias("n_rows"), F.min(TRACKING_ID).alias("first_id"), F.max(TRACKING_ID).alias("last_id"))
        figures.select(F.lit(number).cast("long").alias("batch"), "*").write.mode("overwrite").parquet(f"{root}/out/number={number}")

    stream = tail_rows(spark, f"{root}/landing", feed.schema, size).writeStream.foreachBatch(write)
    query = start(stream, f"{root}/checkpoint", "0 seconds")
    while not query.lastProgress or query.lastProgress["batchId"] < 1:
        query.awaitTermination(0.05)
    query.stop()
    query = start(stream, f"{root}/checkpoint", "0 seconds")
    query.processAllAvailable()
    query.stop()
    return spark.read.parquet(f"{root}/out").drop("number")


@QUERIES.add(_RECORDS_SQL)
def stream_commit_purge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed lands in three parts; files leave the folder as their changes are committed, and none is read twice."""
    root = new_folder(spark, "stream-commit-purge")
    feed = tracking_table(spark, sf_dir)
    total, most = feed.agg(F.count("*"), F.max(TRACKING_ID)).first()
    for part in range(3):
        within = (F.col(TRACKING_ID) > (most * part / 3 if part else -1)) & (F.col(TRACKING_ID) <= most * (part + 1) / 3)
        land(feed.where(within), f"{root}/landing", files=4)
        stream = tail_rows(spark, f"{root}/landing", feed.schema, total // 9 + 1, purge=True)
        records = envelope.cdc_records(stream, "CUSTOMER", keys=["K"]).good
        flat = records.select("seq", "operation", F.col("key.K").alias("k"), F.col("after.VALUE").alias("value"))
        query = start(flat.writeStream.format("parquet").option("path", f"{root}/out"), f"{root}/checkpoint", "0 seconds")
        query.processAllAvailable()
        query.stop()
    return spark.read.parquet(f"{root}/out")


@QUERIES.add(PARTIAL_SQL)
def stream_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes and target in buckets of the key: they are merged where they lie."""
    root = new_folder(spark, "stream-bucketed")
    feed, target = _landable(change_feed(spark, sf_dir)), apply_target(spark, sf_dir)
    land(feed, f"{root}/landing")
    write_bucketed(target, f"{root}/target", "k", 8)
    sink = ChangeSink(spark, f"{root}/changes", "k", COLUMNS, present="present", merge_every=3, buckets=8)
    _stream_into(spark, sink, f"{root}/landing", f"{root}/checkpoint", feed.schema)
    return sink.current(declare_bucketed(spark, f"{root}/target", target.schema, "k", 8), unique_target=True)


@QUERIES.add("""
SELECT CASE WHEN c_custkey % 3 <> 0 THEN c_custkey END AS k, 1.5::DOUBLE AS value, 'same' AS props FROM customer
UNION ALL SELECT NULL, 1.5::DOUBLE, 'same' FROM customer WHERE c_custkey % 3 = 0""")
def stream_null_keys_repeat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Equal rows without a key lie in several files: each is a row of its own, and none is doubled by a second reader."""
    root = new_folder(spark, "stream-null-keys-repeat")
    rows = apply_target(spark, sf_dir).select(
        F.when(F.col("k") % 3 != 0, F.col("k")).alias("k"), F.lit(1.5).alias("value"), F.lit("same").alias("props")
    )
    records = envelope.snapshot_records(rows, "CUSTOMER", "k").select("seq", "operation", "after.*")
    for part in (records, records.where("k IS NULL")):
        part.write.mode("append").option("maxRecordsPerFile", 400).parquet(f"{root}/landing")
    sink = ChangeSink(spark, f"{root}/changes", "k", COLUMNS, row_id=ROW_ID)
    files = _share_of_files(spark, f"{root}/landing", records.schema)
    for run in (1, 2):
        stream = with_row_id(tail(spark, f"{root}/landing", records.schema, max_files=files))
        start(sink.writer(stream), f"{root}/checkpoint-{run}").awaitTermination()
    return sink.current(rows.limit(0))


@QUERIES.add(applied_sql("has_value", "has_props", """(SELECT * FROM feed WHERE seq < (
  SELECT min(seq) FROM feed WHERE NOT is_delete AND value = (SELECT max(value) FROM feed WHERE NOT is_delete)))"""))
def stream_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The upserts with the largest value lack a payload: the stream applies what comes before the first of them, and stops."""
    root = new_folder(spark, "stream-prefix")
    feed = change_feed(spark, sf_dir).where("operation <> 'delete'")
    largest = feed.agg(F.max("value")).first()[0]
    values = change_feed(spark, sf_dir).select("seq", F.col("value").alias("own"))
    records = json_records(spark, sf_dir).drop("k").withColumn("metadata", F.create_map().cast("map<string,string>")).join(values, "seq")
    bad = (F.col("own") == largest) & (F.col("operation") != "delete")
    records = _landable(records.withColumn("after_json", F.when(~bad, F.col("after_json"))).drop("own"))
    land(records, f"{root}/landing")
    target = apply_target(spark, sf_dir)
    sink = PrefixSink(spark, f"{root}/sink", target.schema, "CUSTOMER", "k")
    stream = tail_rows(spark, f"{root}/landing", records.schema, records.count() // 3 + 1)
    query = start(sink.writer(stream), f"{root}/checkpoint", "0 seconds")
    try:
        query.processAllAvailable()
    except StreamingQueryException as error:
        if "StoppedAtRecord" not in str(error):
            raise
    finally:
        query.stop()
    return sink.current(target)


@QUERIES.add(FULL_SQL)
def snapshot_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table is read in four chunks while a feed changes it, with a stop after two; the chunks and the feed then
    give the table as the whole feed leaves it."""
    root = new_folder(spark, "snapshot-chunks")
    feed, first = change_feed(spark, sf_dir).drop("present"), apply_target(spark, sf_dir)
    tracked = feed.withColumn(TRACKING_ID, F.col("seq"))
    last = feed.agg(F.max("seq")).first()[0]
    # The clock moves on with each look at the position; the table is read at a time between two looks.
    clock = {"now": -1}

    def position() -> int:
        clock["now"] = min(last, clock["now"] + last // 9 + 1)
        return clock["now"]

    def as_of_now() -> DataFrame:
        return apply_changes(first, feed.where(F.col("seq") <= clock["now"] + last // 20), "k", COLUMNS)

    def snapshot() -> ChunkedSnapshot:
        return ChunkedSnapshot(spark, root, ["k"], "k", as_of_now, lambda: tracked, position)

    chunks = chunk_ranges(first, "k", 4)
    snapshot().run(chunks[:2])
    snapshot().run(chunks)
    sink = ChangeSink(spark, f"{root}/changes", "k", COLUMNS)
    sink.write_batch(snapshot().rows().withColumn("operation", F.lit("snapshot")))
    begin = snapshot().done().agg(F.min("low")).first()[0]
    sink.write_batch(feed.where(F.col("seq") > begin))
    return sink.current(first.limit(0))
