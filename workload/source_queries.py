"""Queries of the source side: snapshots, pages, tracking tables, records and positions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changeloom.functions.convert import format_datetime
from changeloom.names import CREATED_AT, MODE_CDC, MODE_SNAPSHOT, OPERATION_TYPE, REASON, TRACKING_ID
from changeloom.operators import capture, digests, envelope, paging, purge
from changeloom.plans import figures
from changeloom.plans.handover import Position, source_records
from changeloom.plans.handover import snapshot_then_cdc as hand_over
from changeloom.sources.scratch import new_folder
from workload.fixtures import (
    TARGET_SQL,
    TRACKING_SQL,
    VERSIONS_SQL,
    apply_target,
    table,
    table_versions,
    tracked_operation,
    tracking_table,
)
from workload.registry import Registry

QUERIES = Registry()


def _flat(records: DataFrame, *after: str) -> DataFrame:
    """Records without the time they were made at, which no second run repeats."""
    return records.select(
        F.col("position.mode").alias("mode"),
        F.col("position.last_processed_val").alias("last_processed_val"),
        "operation",
        F.col("metadata")["oracle.table"].alias("table_name"),
        "seq",
        F.to_json("key").alias("key_json"),
        F.array_join("present", ",").alias("present"),
        *[F.col("after")[c].alias(f"after_{c}") for c in after],
    )


@QUERIES.add("""
SELECT 'snapshot' AS mode, o_orderkey AS last_processed_val, 'snapshot' AS operation,
       'ORDERS' AS table_name, CAST(-1 AS BIGINT) AS seq,
       '{"o_orderkey":' || o_orderkey || '}' AS key_json,
       'o_orderkey,o_custkey,o_orderstatus,o_totalprice,o_orderdate,o_orderpriority' AS present,
       o_orderkey AS after_o_orderkey, o_custkey AS after_o_custkey,
       o_orderstatus AS after_o_orderstatus, o_totalprice AS after_o_totalprice,
       o_orderpriority AS after_o_orderpriority
FROM orders""")
def snapshot_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = envelope.snapshot_records(table(spark, sf_dir, "orders"), "ORDERS", "o_orderkey")
    return _flat(
        records, "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"
    )


@QUERIES.add("""
SELECT o_orderkey AS after_o_orderkey, o_totalprice AS after_o_totalprice,
       'o_orderkey,o_totalprice' AS present, 'snapshot' AS operation
FROM orders""")
def snapshot_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = envelope.snapshot_records(
        table(spark, sf_dir, "orders"), "ORDERS", "o_orderkey", columns=["o_orderkey", "o_totalprice"]
    )
    return _flat(records, "o_orderkey", "o_totalprice").select(
        "after_o_orderkey", "after_o_totalprice", "present", "operation"
    )


@QUERIES.add("""
SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_orderkey NULLS LAST LIMIT 1000""")
def snapshot_page_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paging.snapshot_page(
        table(spark, sf_dir, "orders"), "o_orderkey", columns=["o_orderkey", "o_custkey", "o_totalprice"]
    )


@QUERIES.add("""
SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderkey > 499
ORDER BY o_orderkey NULLS LAST LIMIT 1000""")
def snapshot_page_after(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paging.snapshot_page(
        table(spark, sf_dir, "orders"),
        "o_orderkey",
        after=499,
        columns=["o_orderkey", "o_custkey", "o_totalprice"],
    )


@QUERIES.add(f"""
WITH {TRACKING_SQL}
SELECT K, VALUE, PROPS, CONNECTOR_TRACKING_ID, CONNECTOR_OPERATION_TYPE
FROM tracking ORDER BY CONNECTOR_TRACKING_ID LIMIT 1000""")
def cdc_page_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paging.change_page(tracking_table(spark, sf_dir)).drop(CREATED_AT)


@QUERIES.add(f"""
WITH {TRACKING_SQL}
SELECT K, VALUE, CONNECTOR_TRACKING_ID, CONNECTOR_OPERATION_TYPE,
       strftime(CONNECTOR_TRACKING_CREATED_AT, '%Y-%m-%d %H:%M:%S') AS created_at
FROM tracking WHERE CONNECTOR_TRACKING_ID > 499 ORDER BY CONNECTOR_TRACKING_ID LIMIT 100""")
def cdc_page_after(spark: SparkSession, sf_dir: str) -> DataFrame:
    page = paging.change_page(tracking_table(spark, sf_dir), after=499, limit=100, columns=["K", "VALUE"])
    return page.withColumn("created_at", format_datetime(F.col(CREATED_AT))).drop(CREATED_AT)


@QUERIES.add("""
SELECT strftime(o_orderdate, '%Y-%m-%d') AS ordering_value, count(*) AS n_rows
FROM orders GROUP BY o_orderdate HAVING count(*) > 1 OR o_orderdate IS NULL""")
def ordering_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    audit = paging.ordering_audit(table(spark, sf_dir, "orders"), "o_orderdate")
    return audit.withColumn("ordering_value", F.col("ordering_value").cast("date").cast("string"))


_CDC_RECORDS = """
SELECT 'cdc' AS mode, CONNECTOR_TRACKING_ID AS last_processed_val,
       CASE CONNECTOR_OPERATION_TYPE WHEN 'insert' THEN 'create' ELSE CONNECTOR_OPERATION_TYPE END
         AS operation,
       'CUSTOMER' AS table_name, CONNECTOR_TRACKING_ID AS seq, '{"K":' || K || '}' AS key_json,
       CASE WHEN CONNECTOR_OPERATION_TYPE <> 'delete' THEN 'K,VALUE,PROPS' END AS present,
       CASE WHEN CONNECTOR_OPERATION_TYPE <> 'delete' THEN K END AS "after_K",
       CASE WHEN CONNECTOR_OPERATION_TYPE <> 'delete' THEN VALUE END AS "after_VALUE",
       CASE WHEN CONNECTOR_OPERATION_TYPE <> 'delete' THEN PROPS END AS "after_PROPS"
FROM tracking"""
_SNAPSHOT_RECORDS = """
SELECT 'snapshot' AS mode, k AS last_processed_val, 'snapshot' AS operation, 'CUSTOMER' AS table_name,
       CAST(-1 AS BIGINT) AS seq, '{"K":' || k || '}' AS key_json, 'K,VALUE,PROPS' AS present,
       k AS "after_K", value AS "after_VALUE", props AS "after_PROPS"
FROM target"""


def _snapshot_of_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apply_target(spark, sf_dir).toDF("K", "VALUE", "PROPS")


@QUERIES.add(f"WITH {TRACKING_SQL} {_CDC_RECORDS}")
def cdc_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = envelope.cdc_records(tracking_table(spark, sf_dir), "CUSTOMER", keys=["K"]).good
    return _flat(records, "K", "VALUE", "PROPS")


@QUERIES.add(f"""
WITH {TRACKING_SQL} {_CDC_RECORDS}
WHERE CONNECTOR_TRACKING_ID > (SELECT max(event_id) // 2 FROM events)""")
def cdc_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes beyond a position, and no snapshot."""
    feed = tracking_table(spark, sf_dir)
    halfway = feed.agg((F.max(TRACKING_ID) / 2).cast("bigint")).first()[0]
    records = source_records(
        _snapshot_of_target(spark, sf_dir), feed, "CUSTOMER", "K", snapshot=False, position=Position(MODE_CDC, halfway)
    ).good
    return _flat(records, "K", "VALUE", "PROPS")


@QUERIES.add(f"""
WITH {TRACKING_SQL}, {TARGET_SQL} {_SNAPSHOT_RECORDS} WHERE k > (SELECT max(k) // 2 FROM target) UNION ALL {_CDC_RECORDS}""")
def snapshot_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The copy is read to its middle; a second reader goes on from there, then reads the feed."""
    rows, feed, copy = _snapshot_of_target(spark, sf_dir), tracking_table(spark, sf_dir), new_folder(spark, "copy")
    source_records(rows, feed, "CUSTOMER", "K", copy=copy)
    halfway = rows.agg((F.max("K") / 2).cast("bigint")).first()[0]
    position = Position(MODE_SNAPSHOT, halfway)
    records = source_records(rows.limit(0), feed, "CUSTOMER", "K", position=position, copy=copy).good
    return _flat(records, "K", "VALUE", "PROPS")


@QUERIES.add("""
SELECT event_id, 'position is not a JSON object of its type' AS reject_reason
FROM events WHERE event_type <> 'view'""")
def position_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positions that are cut off, of another type or no object."""
    kind, number = F.col("event_type"), F.col("event_id").cast("string")
    text = (
        F.when(kind == "view", F.concat(F.lit('{"mode":"cdc","last_processed_val":'), number, F.lit("}")))
        .when(kind == "click", F.concat(F.lit('{"mode":"cdc","last_processed_val":"x'), number, F.lit('"}')))
        .when(kind == "signup", F.concat(F.lit('{"mode":"cdc","last_pro'), number))
        .otherwise(F.concat(F.lit("["), number, F.lit("]")))
    )
    rows = table(spark, sf_dir, "events").select("event_id", text.alias("position"))
    return envelope.split_positions(rows, "position").rejects.select("event_id", REASON)


@QUERIES.add(f"WITH {TRACKING_SQL}, {TARGET_SQL} {_SNAPSHOT_RECORDS} UNION ALL {_CDC_RECORDS}")
def snapshot_then_cdc(spark: SparkSession, sf_dir: str) -> DataFrame:
    snapshot = envelope.snapshot_records(_snapshot_of_target(spark, sf_dir), "CUSTOMER", "K")
    changes = envelope.cdc_records(tracking_table(spark, sf_dir), "CUSTOMER", "K").good
    return _flat(hand_over(snapshot, changes), "K", "VALUE", "PROPS")


@QUERIES.add(f"WITH {TRACKING_SQL} SELECT K, VALUE, PROPS FROM tracking")
def cdc_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = tracking_table(spark, sf_dir)
    return feed.select(*envelope.payload_columns(feed))


@QUERIES.add("""
SELECT event_id AS "CONNECTOR_TRACKING_ID", event_type AS "CONNECTOR_OPERATION_TYPE",
       'unknown operation type' AS reject_reason
FROM events WHERE event_type IN ('view', 'purchase')""")
def cdc_bad_op(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    operation = F.when(kind.isin("view", "purchase"), kind).otherwise(tracked_operation())
    feed = table(spark, sf_dir, "events").select(
        F.col("event_id").alias(TRACKING_ID), operation.alias(OPERATION_TYPE)
    )
    return envelope.split_operations(feed).rejects.select(TRACKING_ID, OPERATION_TYPE, REASON)


@QUERIES.add("""
SELECT l_partkey, l_suppkey, '{"l_orderkey":' || l_orderkey || '}' AS key_json FROM lineitem""")
def key_single(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem")
    keys = envelope.key_columns(["l_orderkey"], ["l_orderkey", "l_linenumber"], "l_partkey")
    return rows.select("l_partkey", "l_suppkey", F.to_json(envelope.key_struct(rows, keys)).alias("key_json"))


@QUERIES.add("""
SELECT l_partkey, l_suppkey,
       '{"l_orderkey":' || l_orderkey || ',"l_linenumber":' || l_linenumber || '}' AS key_json
FROM lineitem""")
def key_composite(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem")
    keys = envelope.key_columns(None, ["l_orderkey", "l_linenumber"], "l_partkey")
    return rows.select("l_partkey", "l_suppkey", F.to_json(envelope.key_struct(rows, keys)).alias("key_json"))


@QUERIES.add("""
SELECT l_partkey, l_suppkey, '{"l_partkey":' || l_partkey || '}' AS key_json FROM lineitem""")
def key_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem")
    keys = envelope.key_columns(None, None, "l_partkey")
    return rows.select("l_partkey", "l_suppkey", F.to_json(envelope.key_struct(rows, keys)).alias("key_json"))


@QUERIES.add("""
SELECT event_id, 'cdc' AS mode, event_id AS last_processed_val,
       '{"mode":"cdc","last_processed_val":' || event_id ||
       ',"tracking_table":"TRACK_EVENTS","trigger":"TRIG_EVENTS","snapshot_table":""}' AS position
FROM events""")
def position_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    written = table(spark, sf_dir, "events").select(
        "event_id",
        envelope.position_to_json(
            F.lit("cdc"), F.col("event_id"), F.lit("TRACK_EVENTS"), F.lit("TRIG_EVENTS")
        ).alias("position"),
    )
    parsed = envelope.position_from_json(F.col("position"))
    return written.select(
        "event_id",
        parsed["mode"].alias("mode"),
        parsed["last_processed_val"].alias("last_processed_val"),
        "position",
    )


@QUERIES.add("""
SELECT 'decimal' AS ordering, 'snapshot' AS mode, CAST(max(c_custkey) AS BIGINT) AS last_processed_val FROM customer
UNION ALL SELECT 'decimal', 'cdc', max(event_id) FROM events
UNION ALL SELECT 'int', 'snapshot', max(c_custkey) FROM customer UNION ALL SELECT 'int', 'cdc', max(event_id) FROM events""")
def resume_position_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ordering columns whose type is not that of tracking ids."""
    found = []
    for name, kind in (("decimal", "decimal(18,2)"), ("int", "int")):
        rows = _snapshot_of_target(spark, sf_dir).withColumn("K", F.col("K").cast(kind))
        feed = tracking_table(spark, sf_dir).withColumn("K", F.col("K").cast(kind))
        positions = envelope.resume_positions(source_records(rows, feed, "CUSTOMER", "K").good)
        found.append(positions.select(F.lit(name).alias("ordering"), "mode", F.col("last_processed_val").cast("bigint")))
    return found[0].union(found[1])


@QUERIES.add("""
SELECT 'snapshot' AS mode, max(c_custkey) AS last_processed_val FROM customer
UNION ALL SELECT 'cdc', max(event_id) FROM events""")
def resume_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    snapshot = envelope.snapshot_records(_snapshot_of_target(spark, sf_dir), "CUSTOMER", "K")
    changes = envelope.cdc_records(tracking_table(spark, sf_dir), "CUSTOMER", "K").good
    return envelope.resume_positions(hand_over(snapshot, changes))


@QUERIES.add(f"""
WITH {TRACKING_SQL}
SELECT K, VALUE, PROPS, CONNECTOR_TRACKING_ID, CONNECTOR_OPERATION_TYPE
FROM tracking WHERE CONNECTOR_OPERATION_TYPE <> 'update'""")
def purge_acked(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = tracking_table(spark, sf_dir)
    records = envelope.cdc_records(feed, "CUSTOMER", "K").good
    acknowledged = purge.acknowledged_ids(records.where(F.col("operation") == "update"))
    return purge.purge_acknowledged(feed, acknowledged).drop(CREATED_AT)


_DIFF = """
SELECT coalesce(n.c_custkey, o.c_custkey) AS c_custkey,
       CASE WHEN n.c_custkey IS NULL THEN o.c_name ELSE n.c_name END AS c_name,
       CASE WHEN n.c_custkey IS NULL THEN o.c_nationkey ELSE n.c_nationkey END AS c_nationkey,
       CASE WHEN n.c_custkey IS NULL THEN o.c_acctbal ELSE n.c_acctbal END AS c_acctbal,
       CASE WHEN n.c_custkey IS NULL THEN o.c_mktsegment ELSE n.c_mktsegment END AS c_mktsegment,
       CASE WHEN n.c_custkey IS NULL THEN 'delete' WHEN o.c_custkey IS NULL THEN 'insert'
            ELSE 'update' END AS "CONNECTOR_OPERATION_TYPE"
FROM old_v o FULL OUTER JOIN new_v n ON o.c_custkey = n.c_custkey
WHERE o.c_custkey IS NULL OR n.c_custkey IS NULL OR o.c_name IS DISTINCT FROM n.c_name
   OR o.c_nationkey IS DISTINCT FROM n.c_nationkey OR o.c_acctbal IS DISTINCT FROM n.c_acctbal
   OR o.c_mktsegment IS DISTINCT FROM n.c_mktsegment"""


@QUERIES.add(f"WITH {VERSIONS_SQL} {_DIFF}")
def capture_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, new = table_versions(spark, sf_dir)
    return capture.capture_diff(old, new, ["c_custkey"])


@QUERIES.add(f"WITH {VERSIONS_SQL} {_DIFF}")
def capture_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same changes, from the key ranges whose digests differ."""
    old, new = table_versions(spark, sf_dir)
    return digests.capture_by_digest(old, new, ["c_custkey"], coarse=64, fine=256)


@QUERIES.add(f"""
WITH {VERSIONS_SQL}
SELECT c_custkey, c_mktsegment, "CONNECTOR_OPERATION_TYPE" FROM ({_DIFF})""")
def capture_diff_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, new = table_versions(spark, sf_dir)
    return capture.capture_diff(old, new, ["c_custkey"], columns=["c_custkey", "c_mktsegment"])


@QUERIES.add(f"""
WITH {VERSIONS_SQL}
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, "CONNECTOR_OPERATION_TYPE",
       row_number() OVER (ORDER BY c_custkey) AS "CONNECTOR_TRACKING_ID"
FROM ({_DIFF})""")
def tracking_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, new = table_versions(spark, sf_dir)
    changes = capture.capture_diff(old, new, ["c_custkey"], copy_number="copy")
    return capture.number_changes(changes, ["c_custkey", OPERATION_TYPE]).drop(CREATED_AT, "copy")


@QUERIES.add("SELECT o_orderkey, o_totalprice, (row_number() OVER (ORDER BY o_orderkey) - 1) // 1000 AS page FROM orders")
def snapshot_page_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages of 1000 rows at once."""
    return paging.page_index(table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"), "o_orderkey", 1000)


@QUERIES.add("""
SELECT max(event_id) AS last_seq, count(*) AS n_records, count(*) FILTER (event_type = 'error') AS n_deletes,
       count(*) FILTER (value > 99 AND event_type <> 'error') AS n_bad,
       min(event_id) FILTER (value > 99 AND event_type <> 'error') AS first_bad FROM events""")
def observed_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Position, counts and the first bad record of a run, from the pass that writes its records."""
    records = envelope.cdc_records(tracking_table(spark, sf_dir), "CUSTOMER", keys=["K"]).good
    marked = records.withColumn(REASON, F.when(F.col("after.VALUE") > 99, "too large"))
    watched, found = figures.observed(marked)
    watched.write.parquet(new_folder(spark, "observed"))
    return figures.figures_row(marked, found)
