"""Queries of the target side: applying changes, routing, and setting bad records aside."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changeloom.functions.jsontext import object_names, parse_object
from changeloom.names import REASON
from changeloom.operators import apply as apply_ops
from changeloom.operators import records as record_ops
from changeloom.plans import sync
from changeloom.plans.touched import PartitionedTarget
from changeloom.sources.scratch import new_folder
from workload.fixtures import (
    FEED_SQL,
    TARGET_SQL,
    apply_target,
    change_feed,
    json_records,
    table,
)
from workload.registry import Registry

QUERIES = Registry()

COLUMNS = ["value", "props"]


def applied_sql(sent_value: str, sent_props: str, rows: str = "feed", keyless: str = "") -> str:
    """The target after the changes in ``rows``. ``arg_max_null`` keeps a NULL that was sent last."""
    return f"""
WITH {FEED_SQL}, {TARGET_SQL},
deleted AS (SELECT k, max(seq) AS d FROM {rows} WHERE is_delete GROUP BY k),
live AS (
  SELECT f.*, d FROM {rows} f LEFT JOIN deleted USING (k)
  WHERE NOT is_delete AND (d IS NULL OR seq > d)
),
latest AS (
  SELECT k, any_value(d) AS d,
         count(*) FILTER ({sent_value}) AS n_value, arg_max_null(value, seq) FILTER ({sent_value}) AS value,
         count(*) FILTER ({sent_props}) AS n_props, arg_max_null(props, seq) FILTER ({sent_props}) AS props
  FROM live GROUP BY k
)
SELECT t.k,
       CASE WHEN l.n_value > 0 THEN l.value ELSE t.value END AS value,
       CASE WHEN l.n_props > 0 THEN l.props ELSE t.props END AS props
FROM target t LEFT JOIN latest l ON t.k = l.k
WHERE t.k NOT IN (SELECT k FROM deleted)
UNION ALL
SELECT k, CASE WHEN n_value > 0 THEN value END, CASE WHEN n_props > 0 THEN props END
FROM latest WHERE d IS NOT NULL OR k NOT IN (SELECT k FROM target)
{keyless}"""


PARTIAL_SQL = applied_sql("has_value", "has_props")
FULL_SQL = applied_sql("true", "true")


@QUERIES.add(PARTIAL_SQL)
def apply_partial(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apply_ops.apply_changes(
        apply_target(spark, sf_dir), change_feed(spark, sf_dir), "k", COLUMNS, present="present"
    )


@QUERIES.add(PARTIAL_SQL)
def apply_partial_measured(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sync.apply_measured(
        apply_target(spark, sf_dir), change_feed(spark, sf_dir), "k", COLUMNS, present="present"
    )


@QUERIES.add(FULL_SQL)
def apply_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apply_ops.apply_changes(apply_target(spark, sf_dir), change_feed(spark, sf_dir), "k", COLUMNS)


@QUERIES.add(f"""
WITH {FEED_SQL}, {TARGET_SQL}
SELECT * FROM target WHERE k NOT IN (SELECT k FROM feed WHERE is_delete)""")
def apply_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    deletes = change_feed(spark, sf_dir).where(F.col("operation") == "delete")
    return apply_ops.delete_keys(apply_target(spark, sf_dir), deletes, "k")


@QUERIES.add(f"""
WITH {FEED_SQL}, {TARGET_SQL},
latest AS (SELECT k, value, props FROM feed QUALIFY row_number() OVER (PARTITION BY k ORDER BY seq DESC) = 1)
SELECT * FROM latest UNION ALL SELECT * FROM target WHERE k NOT IN (SELECT k FROM latest)""")
def apply_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only upserts, arriving in an order that has nothing to do with ``seq``."""
    feed = change_feed(spark, sf_dir).withColumn("operation", F.lit("update"))
    shuffled = feed.repartition("props").sortWithinPartitions(F.hash("seq"))
    return apply_ops.apply_changes(apply_target(spark, sf_dir), shuffled, "k", COLUMNS)


@QUERIES.add(
    applied_sql(
        "has_value",
        "has_props",
        "keyed",
        "UNION ALL SELECT NULL, NULL, props FROM feed WHERE event_type = 'view'",
    ).replace("deleted AS (", "keyed AS (SELECT * FROM feed WHERE event_type <> 'view'),\ndeleted AS (", 1)
)
def apply_null_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = change_feed(spark, sf_dir).withColumn(
        "k", F.when(F.col("event_type") != "view", F.col("k"))
    )
    return apply_ops.apply_changes(apply_target(spark, sf_dir), feed, "k", COLUMNS, present="present")


TABLES = ["T_SIGNUP", "T_PURCHASE", "T_CLICK", "T_ERROR", "T_OTHER"]
_TABLE_NAME = "CASE event_type WHEN 'view' THEN 'T_OTHER' ELSE 'T_' || upper(event_type) END"


@QUERIES.add(f"SELECT {_TABLE_NAME} AS table_name, count(*) AS n_records FROM events GROUP BY 1")
def route_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = json_records(spark, sf_dir)
    return records.groupBy(record_ops.table_of("t_other").alias("table_name")).agg(
        F.count(F.lit(1)).alias("n_records")
    )


@QUERIES.add(f"""
WITH {TARGET_SQL}, names AS (SELECT unnest({TABLES}) AS table_name),
changed AS (
  SELECT {_TABLE_NAME} AS table_name, user_id AS k, event_type,
         arg_max(value, event_id) AS value, arg_max(props, event_id) AS props
  FROM events GROUP BY ALL
)
SELECT n.table_name, t.k,
       CASE WHEN event_type IN ('signup', 'purchase', 'click') THEN c.value ELSE t.value END AS value,
       CASE WHEN event_type IN ('signup', 'purchase', 'view') THEN c.props ELSE t.props END AS props
FROM names n CROSS JOIN target t LEFT JOIN changed c ON c.table_name = n.table_name AND c.k = t.k
WHERE event_type IS DISTINCT FROM 'error'
UNION ALL
SELECT table_name, k, CASE WHEN event_type <> 'view' THEN value END,
       CASE WHEN event_type <> 'click' THEN props END
FROM changed WHERE event_type <> 'error' AND k NOT IN (SELECT k FROM target)""")
def apply_routed(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = apply_target(spark, sf_dir).toDF("K", "VALUE", "PROPS")
    records = json_records(spark, sf_dir).drop("k")
    feed = sync.land_records(records, target.schema, TABLES, "T_OTHER", "K").where("_reason IS NULL")
    routed = sync.apply_routed(
        {t: target for t in TABLES}, feed, "K", ["VALUE", "PROPS"], "_present", "_table", "_seq", "_operation"
    )
    return routed.select(
        F.col("_table").alias("table_name"), *[F.col(c).alias(c.lower()) for c in target.columns]
    )


@QUERIES.add(PARTIAL_SQL)
def apply_key_injection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON records; most payloads lack the key column, which is then taken from the record key."""
    records = json_records(spark, sf_dir).drop("k").withColumn(
        "metadata", F.create_map().cast("map<string,string>")
    )
    return sync.apply_records(apply_target(spark, sf_dir), records, "CUSTOMER", "k")[0]


@QUERIES.add("""
WITH upserts AS (SELECT event_id, value FROM events WHERE event_type <> 'error'),
bad AS (SELECT min(event_id) AS first_bad FROM upserts WHERE value = (SELECT max(value) FROM upserts))
SELECT event_id AS seq FROM events, bad WHERE event_id < first_bad""")
def prefix_ack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The upserts with the largest value lack a payload: what comes before the first is kept."""
    target = apply_target(spark, sf_dir).toDF("K", "VALUE", "PROPS")
    typed = sync.land_records(_with_bad_records(spark, sf_dir), target.schema, ["T_OTHER"], "T_OTHER", "K")
    return record_ops.applied_prefix(typed, "_seq", "_reason").select(F.col("_seq").alias("seq"))


def _with_bad_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records for one table, of which the upserts with the largest value lack a payload."""
    largest = table(spark, sf_dir, "events").where(F.col("event_type") != "error").agg(F.max("value")).first()[0]
    records = json_records(spark, sf_dir, keep=("value",)).drop("k").withColumn("metadata", F.create_map().cast("map<string,string>"))
    return records.withColumn("after_json", F.when(F.col("value") < largest, F.col("after_json"))).drop("value")


@QUERIES.add("""
SELECT event_id AS seq,
       CASE event_type WHEN 'signup' THEN 'USER_ID' WHEN 'purchase' THEN 'EVENTID' ELSE 'K' END AS key_column
FROM events""")
def key_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    key_json = (
        F.when(kind == "signup", F.to_json(F.struct(F.col("user_id"))))
        .when(kind == "purchase", F.to_json(F.struct(F.col("event_id").alias("EventId"))))
        .when(kind == "click", "{}")
        .when(kind == "view", "no key")
    )
    records = table(spark, sf_dir, "events").select(F.col("event_id").alias("seq"), key_json.alias("key_json"))
    names = object_names(parse_object(F.col("key_json")))
    return records.select("seq", record_ops.key_column_of(names, "k").alias("key_column"))


@QUERIES.add("""
SELECT l_orderkey, l_linenumber, 'composite keys are not supported' AS reject_reason
FROM lineitem WHERE l_returnflag <> 'N'""")
def reject_composite(spark: SparkSession, sf_dir: str) -> DataFrame:
    two = F.to_json(F.struct("l_orderkey", "l_linenumber"))
    one = F.to_json(F.struct("l_orderkey"))
    records = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("seq"),
        F.when(F.col("l_linestatus") == "O", "delete").otherwise("update").alias("operation"),
        F.create_map().cast("map<string,string>").alias("metadata"),
        F.when(F.col("l_returnflag") != "N", two).otherwise(one).alias("key_json"),
        F.to_json(F.struct("l_quantity")).alias("after_json"),
    )
    parsed = record_ops.parse_records(records, "LINEITEM", "L_ORDERKEY")
    return record_ops.check_records(parsed).rejects.select("l_orderkey", "l_linenumber", REASON)


def _rejects(spark: SparkSession, sf_dir: str, records: DataFrame) -> DataFrame:
    target = apply_target(spark, sf_dir).toDF("K", "VALUE", "PROPS")
    parsed = record_ops.parse_records(records.drop("k"), "T_OTHER", "K")
    return record_ops.check_records(parsed, target.schema).rejects.select("seq", "operation", REASON)


@QUERIES.add("""
SELECT event_id AS seq, CASE event_type WHEN 'signup' THEN 'create' ELSE 'update' END AS operation,
       'payload is empty' AS reject_reason
FROM events WHERE event_type IN ('signup', 'view')""")
def reject_empty_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    after = F.when(kind == "signup", "").when(kind == "purchase", "{}").when(kind == "click", "null")
    return _rejects(spark, sf_dir, json_records(spark, sf_dir).withColumn("after_json", after))


@QUERIES.add("""
SELECT event_id AS seq, 'delete' AS operation, 'key value is missing' AS reject_reason
FROM events WHERE event_type <> 'error'""")
def reject_empty_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    key = (
        F.when(kind == "error", F.col("key_json")).when(kind == "signup", "").when(kind == "click", "{}")
        .when(kind == "view", "null")
    )
    records = json_records(spark, sf_dir).withColumns({"operation": F.lit("delete"), "key_json": key})
    return _rejects(spark, sf_dir, records)


@QUERIES.add("""
SELECT event_id AS seq, 'delete' AS operation, 'key is not a JSON object' AS reject_reason
FROM events WHERE event_type = 'error'""")
def reject_bad_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rejects(spark, sf_dir, json_records(spark, sf_dir).withColumn("key_json", F.lit("42, not JSON")))


@QUERIES.add("""
SELECT event_id AS seq, 'update' AS operation, 'unknown column' AS reject_reason
FROM events WHERE event_type = 'purchase'""")
def reject_unknown_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    wrong = F.concat(F.lit('{"wrong_column":1,'), F.substring("after_json", 2, 1 << 30))
    after = F.when(F.col("event_type") == "purchase", wrong).otherwise(F.col("after_json"))
    return _rejects(spark, sf_dir, json_records(spark, sf_dir).withColumn("after_json", after))


@QUERIES.add(PARTIAL_SQL)
def apply_any_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order is a time before 1970 for some rows and negative as a number for all."""
    order = F.timestamp_micros(F.col("seq") - (1 << 40))
    feed = change_feed(spark, sf_dir).withColumn("seq", order)
    return apply_ops.apply_changes(apply_target(spark, sf_dir), feed, "k", COLUMNS, present="present")


@QUERIES.add(PARTIAL_SQL)
def apply_unique_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A target without repeated keys: one full outer join."""
    feed = change_feed(spark, sf_dir).withColumn("seq", F.col("seq") - (1 << 40))
    return apply_ops.apply_changes(
        apply_target(spark, sf_dir), feed, "k", COLUMNS, present="present", unique_target=True
    )


@QUERIES.add("""
SELECT event_id AS seq, CASE event_type WHEN 'error' THEN 'delete' WHEN 'signup' THEN 'create' ELSE 'update' END AS operation,
       'value does not fit the column ' || CASE WHEN event_type IN ('error', 'click') THEN 'K' ELSE 'VALUE' END AS reject_reason
FROM events WHERE event_type IN ('error', 'click')
   OR (event_type = 'purchase' AND round(value * 100) / 100 <> value)""")
def reject_fraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fractions in whole-number keys, and values with more digits than the column has."""
    kind, key = F.col("event_type"), F.col("k")
    half = F.concat(F.lit('{"k":'), key.cast("string"), F.lit(".5}"))
    records = json_records(spark, sf_dir).drop("after_json").join(
        table(spark, sf_dir, "events").select(F.col("event_id").alias("seq"), "value"), "seq"
    )
    records = records.withColumns({
        "key_json": F.when(kind.isin("error", "click"), half).otherwise(F.col("key_json")),
        "after_json": F.when(kind == "purchase", F.to_json(F.struct("value"))).when(kind != "error", '{"props":"p"}'),
    })
    target = apply_target(spark, sf_dir).toDF("K", "VALUE", "PROPS")
    target = target.select(F.col("K").cast("int").alias("K"), F.col("VALUE").cast("decimal(18,2)").alias("VALUE"), "PROPS")
    parsed = record_ops.parse_records(records.drop("k"), "T_OTHER", "K")
    return record_ops.check_records(parsed, target.schema).rejects.select("seq", "operation", REASON)


@QUERIES.add("""
WITH upserts AS (SELECT event_id, value FROM events WHERE event_type <> 'error'),
bad AS (SELECT min(event_id) AS first_bad FROM upserts WHERE value = (SELECT max(value) FROM upserts))
SELECT count(*) AS n_applied FROM events, bad WHERE event_id < first_bad""")
def prefix_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many records a writer acknowledges that stops at the first one without a payload."""
    records = _with_bad_records(spark, sf_dir)
    return sync.apply_prefix(apply_target(spark, sf_dir), records, "T_OTHER", "k")[2]


# Purchases name their row by its code alone; those whose row may be gone are left out.
_BY_CODE_FEED = """(SELECT * FROM feed WHERE event_type <> 'purchase' OR (
  k IN (SELECT k FROM target) AND k NOT IN (SELECT k FROM feed WHERE is_delete)))"""
OTHER_KEY_SQL = (
    "SELECT k, value, props, 'C' || k AS code FROM (" + applied_sql("has_value", "has_props", _BY_CODE_FEED) + ")"
)


def records_by_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records that take turns in naming their row by ``k`` and by ``code``, which is another unique column."""
    feed, target = change_feed(spark, sf_dir), apply_target(spark, sf_dir)
    stays = target.select("k").join(feed.where("operation = 'delete'").select("k"), "k", "left_anti")
    others, purchases = feed.where("event_type <> 'purchase'"), feed.where("event_type = 'purchase'")
    feed = others.unionByName(purchases.join(stays, "k", "left_semi").select(*feed.columns))
    code, kind = F.concat(F.lit("C"), F.col("k")).alias("code"), F.col("event_type")
    after = (
        F.when(kind == "signup", F.to_json(F.struct("k", code, "value", "props")))
        .when(kind == "click", F.to_json(F.struct("k", code, "value")))
        .when(kind == "view", F.to_json(F.struct("k", code, "props")))
        .when(kind == "purchase", F.to_json(F.struct("value", "props")))
    )
    by_code = F.to_json(F.struct(code))
    key = F.when(kind.isin("click", "purchase"), by_code).otherwise(F.to_json(F.struct("k")))
    return feed.select("seq", "operation", F.create_map().cast("map<string,string>").alias("metadata"), key.alias("key_json"), after.alias("after_json"))


def target_with_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apply_target(spark, sf_dir).withColumn("code", F.concat(F.lit("C"), F.col("k")))


@QUERIES.add(OTHER_KEY_SQL)
def apply_other_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of two key columns in one step."""
    return sync.apply_records(target_with_code(spark, sf_dir), records_by_code(spark, sf_dir), "CUSTOMER", "k")[0]


_SLIVER = "(SELECT * FROM feed WHERE k % 97 = 0)"


@QUERIES.add(applied_sql("has_value", "has_props", _SLIVER))
def apply_touched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes of a few keys: only the parts of the target that hold them are rewritten."""
    rows = apply_target(spark, sf_dir)
    target = PartitionedTarget(spark, f"{new_folder(spark, 'target')}/table", "k", rows.schema, parts=32)
    target.create(rows)
    target.apply(change_feed(spark, sf_dir).where("k % 97 = 0"), COLUMNS, present="present")
    return target.read()


@QUERIES.add(applied_sql("has_value", "has_props", "(SELECT * FROM feed WHERE k IS NOT NULL)"))
def apply_measured_unordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Beside the changes come as many without an order, half of them without a key: they change nothing."""
    feed = change_feed(spark, sf_dir)
    unordered = feed.withColumns({"seq": F.lit(None).cast("bigint"), "k": F.when(F.col("seq") % 2 == 0, F.col("k")), "props": F.lit("lost")})
    return sync.apply_measured(apply_target(spark, sf_dir), feed.unionByName(unordered), "k", COLUMNS, present="present")
