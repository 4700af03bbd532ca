"""The test tables in the roles of a change-data-capture set-up, for Spark and for SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changeloom.names import CREATED_AT, METADATA_TABLE, OPERATION_TYPE, TRACKING_ID


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tracked_operation(event_type: str = "event_type"):
    return (
        F.when(F.col(event_type) == "signup", "insert")
        .when(F.col(event_type) == "error", "delete")
        .otherwise("update")
    )


def tracking_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as a tracking table."""
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("K"),
        F.col("value").alias("VALUE"),
        F.col("props").alias("PROPS"),
        F.col("event_id").alias(TRACKING_ID),
        tracked_operation().alias(OPERATION_TYPE),
        F.col("ts").alias(CREATED_AT),
    )


TRACKING_SQL = """
tracking AS (
  SELECT user_id AS K, value AS VALUE, props AS PROPS, event_id AS CONNECTOR_TRACKING_ID,
         CASE event_type WHEN 'signup' THEN 'insert' WHEN 'error' THEN 'delete' ELSE 'update' END
           AS CONNECTOR_OPERATION_TYPE,
         ts AS CONNECTOR_TRACKING_CREATED_AT
  FROM events
)"""


def change_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as typed changes with partial images."""
    present = (
        F.when(F.col("event_type").isin("signup", "purchase"), F.array(F.lit("value"), F.lit("props")))
        .when(F.col("event_type") == "click", F.array(F.lit("value")))
        .when(F.col("event_type") == "view", F.array(F.lit("props")))
    )
    operation = (
        F.when(F.col("event_type") == "signup", "create")
        .when(F.col("event_type") == "error", "delete")
        .otherwise("update")
    )
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("seq"),
        operation.alias("operation"),
        F.col("user_id").alias("k"),
        "value",
        "props",
        present.alias("present"),
        "event_type",
    )


FEED_SQL = """
feed AS (
  SELECT event_id AS seq, user_id AS k, value, props, event_type,
         event_type = 'error' AS is_delete,
         event_type IN ('signup', 'purchase', 'click') AS has_value,
         event_type IN ('signup', 'purchase', 'view') AS has_props
  FROM events
)"""


def apply_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``customer`` as the table that changes are applied to."""
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("k"),
        F.col("c_acctbal").alias("value"),
        F.col("c_mktsegment").alias("props"),
    )


TARGET_SQL = """
target AS (SELECT c_custkey AS k, c_acctbal AS value, c_mktsegment AS props FROM customer)"""


def json_records(spark: SparkSession, sf_dir: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """``events`` as JSON records, with columns of the feed to ``keep``. The names are in mixed case; some keys are only in the record
    key, and each event type has a table of its own, but ``view`` goes to the default table."""
    feed = change_feed(spark, sf_dir)
    key, value, props = F.col("k"), F.col("value"), F.col("props")
    after = (
        F.when(F.col("event_type") == "signup", F.to_json(F.struct(key.alias("k"), value, props.alias("Props"))))
        .when(F.col("event_type") == "purchase", F.to_json(F.struct(value.alias("VALUE"), props)))
        .when(F.col("event_type") == "click", F.to_json(F.struct(key.alias("K"), value.alias("Value"))))
        .when(F.col("event_type") == "view", F.to_json(F.struct(props.alias("pRops"))))
    )
    routed = F.create_map(F.lit(METADATA_TABLE), F.concat(F.lit("T_"), F.upper("event_type")))
    return feed.select(
        "seq",
        "operation",
        F.when(F.col("event_type") != "view", routed)
        .otherwise(F.create_map().cast("map<string,string>"))
        .alias("metadata"),
        F.to_json(F.struct(key.alias("k"))).alias("key_json"),
        after.alias("after_json"),
        "event_type",
        "k",
        *keep,
    )


def table_versions(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """``customer`` before and after deletes, updates and inserts."""
    old = table(spark, sf_dir, "customer")
    key = F.col("c_custkey")
    kept = old.where(key % 10 != 0).withColumn(
        "c_acctbal", F.when(key % 10 == 1, F.col("c_acctbal") + 1).otherwise(F.col("c_acctbal"))
    )
    added = old.where(key % 10 == 2).withColumn("c_custkey", key + 1000000)
    return old, kept.unionByName(added)


VERSIONS_SQL = """
old_v AS (SELECT * FROM customer),
new_v AS (
  SELECT c_custkey, c_name, c_nationkey,
         CASE WHEN c_custkey % 10 = 1 THEN c_acctbal + 1 ELSE c_acctbal END AS c_acctbal,
         c_mktsegment
  FROM customer WHERE c_custkey % 10 <> 0
  UNION ALL
  SELECT c_custkey + 1000000, c_name, c_nationkey, c_acctbal, c_mktsegment
  FROM customer WHERE c_custkey % 10 = 2
)"""
