"""Queries of value conversion: numbers, flags, dates, bytes, JSON text and names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changeloom.functions import convert, jsontext
from changeloom.functions.binding import evaluate_once
from changeloom.names import REASON, ColumnType
from workload.fixtures import json_records, table
from workload.registry import Registry

QUERIES = Registry()

NUMBER = ColumnType("NUMBER")
FLAG = ColumnType("NUMBER", 1, 0)


@QUERIES.add("""
SELECT l_orderkey, l_linenumber, CAST(l_quantity AS BIGINT) AS l_quantity FROM lineitem
WHERE l_quantity = floor(l_quantity)""")
def number_to_int(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return convert.read_rows(rows, {"L_QUANTITY": NUMBER}).good


@QUERIES.add("""
SELECT o_orderkey, o_totalprice, 'o_totalprice: not a whole number' AS reject_reason
FROM orders WHERE o_totalprice <> floor(o_totalprice)""")
def number_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return convert.read_rows(rows, {"O_TOTALPRICE": NUMBER}).rejects


@QUERIES.add("""
SELECT l_orderkey, l_partkey, l_linenumber = 1 AS l_linenumber FROM lineitem""")
def number1_to_bool(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber")
    return convert.read_rows(rows, {"L_LINENUMBER": FLAG}).good


@QUERIES.add("""
SELECT doc_id, CASE WHEN quality = 1 THEN true END AS quality,
       CASE WHEN toxic = 1 THEN CAST(1 AS BIGINT) END AS toxic
FROM labels""")
def convert_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "labels").select(
        "doc_id", F.nullif("quality", F.lit(0)).alias("quality"), F.nullif("toxic", F.lit(0)).alias("toxic")
    )
    return convert.read_rows(rows, {"QUALITY": FLAG, "TOXIC": NUMBER}).good


@QUERIES.add("SELECT doc_id, quality, toxic FROM labels")
def bool_to_number1(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "labels").select(
        "doc_id", (F.col("quality") == 1).alias("quality"), "toxic"
    )
    return convert.write_rows(rows, {"QUALITY": FLAG, "TOXIC": FLAG}).good


@QUERIES.add("""
SELECT event_id, strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') AS ts FROM events""")
def format_datetime(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select("event_id", "ts")
    return rows.select("event_id", convert.format_datetime(F.col("ts")).alias("ts"))


# Layouts of full dates, as Spark patterns, with the letters around them.
_WRITTEN = [
    "yyyy-MM-dd'T'HH:mm:ss'Z'",
    "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+02:00'",
    "MM/dd hh:mm:ssa ''yy '-0700'",
    "E MMM d HH:mm:ss yyyy",
    "E MMM d HH:mm:ss 'MST' yyyy",
    "E MMM dd HH:mm:ss '+0200' yyyy",
    "dd MMM yy HH:mm 'UTC'",
    "dd MMM yy HH:mm '-0330'",
    "EEEE, dd-MMM-yy HH:mm:ss 'CEST'",
    "E, dd MMM yyyy HH:mm:ss 'GMT'",
    "E, dd MMM yyyy HH:mm:ss '+0530'",
]
_MINUTES_ONLY = [i for i, pattern in enumerate(_WRITTEN) if ":ss" not in pattern]


def _dates_as_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event time as text, the layouts taking turns."""
    turn = F.col("event_id") % len(_WRITTEN)
    text = F.lit(None).cast("string")
    for i, pattern in enumerate(_WRITTEN):
        text = F.when(turn == i, F.date_format("ts", pattern)).otherwise(text)
    return table(spark, sf_dir, "events").select("event_id", text.alias("ts"))


@QUERIES.add(f"""
SELECT event_id,
       strftime(date_trunc(CASE WHEN event_id % {len(_WRITTEN)} IN ({", ".join(map(str, _MINUTES_ONLY))})
                           THEN 'minute' ELSE 'second' END, ts), '%Y-%m-%d %H:%M:%S') AS ts
FROM events""")
def parse_datetime(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _dates_as_text(spark, sf_dir)
    good = convert.write_rows(rows, {"TS": ColumnType("DATE")}).good
    return good.select("event_id", convert.format_datetime(F.col("ts")).alias("ts"))


@QUERIES.add("""
SELECT event_id, 'ts: unknown date layout' AS reject_reason,
       CASE event_type WHEN 'click' THEN strftime(ts, '%Y-%m-%d %H:%M:%S')
                       WHEN 'view' THEN strftime(ts, '%b %d %H:%M:%S')
                       WHEN 'error' THEN strftime(ts, '%I:%M%p') ELSE props END AS ts
FROM events WHERE event_type <> 'purchase'""")
def parse_datetime_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    text = (
        F.when(kind == "click", F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
        .when(kind == "view", F.date_format("ts", "MMM dd HH:mm:ss"))
        .when(kind == "error", F.date_format("ts", "hh:mma"))
        .when(kind == "purchase", F.date_format("ts", "E, dd MMM yyyy HH:mm:ss 'UTC'"))
        .otherwise(F.col("props"))
    )
    rows = table(spark, sf_dir, "events").select("event_id", text.alias("ts"))
    return convert.write_rows(rows, {"TS": ColumnType("TIMESTAMP(6)")}).rejects.select("event_id", REASON, "ts")


@QUERIES.add("SELECT doc_id, hex(CAST(encode(text) AS BLOB)) AS text_hex FROM documents")
def to_blob(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").select("doc_id", "text")
    stored = convert.write_rows(rows, {"TEXT": ColumnType("BLOB")}).good
    return stored.select("doc_id", F.hex("text").alias("text_hex"))


@QUERIES.add("""
SELECT event_id,
       CASE WHEN event_type < 'k'
            THEN '{"' || event_type || '":' || event_id || ',"k":' || json_extract_string(props, '$.k') || '}'
            ELSE '{"k":' || json_extract_string(props, '$.k') || ',"' || event_type || '":' || event_id || '}'
       END AS attributes
FROM events""")
def map_to_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select(
        "event_id",
        F.map_concat(
            F.create_map("event_type", "event_id"), F.from_json("props", "map<string,bigint>")
        ).alias("attributes"),
    )
    return convert.write_rows(rows, {}).good


@QUERIES.add("""
SELECT vec_id, '[' || array_to_string(
         list_transform(embedding, lambda x: CAST(CAST(floor(CAST(x AS DOUBLE) * 1000) AS BIGINT) AS VARCHAR)), ',')
       || ']' AS embedding
FROM embeddings""")
def array_to_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select(
        "vec_id",
        F.transform("embedding", lambda x: F.floor(x.cast("double") * 1000)).alias("embedding"),
    )
    return convert.write_rows(rows, {"EMBEDDING": ColumnType("VARCHAR2")}).good


@QUERIES.add("""
SELECT c_custkey AS "C_CUSTKEY", c_name AS "C_NAME", c_acctbal AS "C_ACCTBAL" FROM customer""")
def upper_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return convert.upper_names(
        table(spark, sf_dir, "customer").select(
            "c_custkey", F.col("c_name").alias("C_Name"), F.col("c_acctbal").alias("c_AcctBal")
        )
    )


@QUERIES.add("""
SELECT event_id AS seq,
       CASE event_type WHEN 'error' THEN 'none' WHEN 'view' THEN 'no object' ELSE 'object' END AS kind,
       CASE event_type WHEN 'signup' THEN 'K,PROPS,VALUE' WHEN 'purchase' THEN 'PROPS,VALUE'
                       WHEN 'click' THEN '' END AS names,
       CASE WHEN event_type IN ('signup', 'purchase') THEN value END AS value
FROM events""")
def parse_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    text = (
        F.when(kind == "view", F.concat(F.lit("["), F.col("after_json"), F.lit("]")))
        .when(kind == "click", "null")
        .otherwise(F.col("after_json"))
    )
    rows = json_records(spark, sf_dir).select("seq", text.alias("after_json"))
    rows = evaluate_once(rows, {"parsed": jsontext.parse_object(F.col("after_json"))})
    names = jsontext.object_names(F.col("parsed"))
    values = jsontext.object_values(F.col("parsed"), names)
    return rows.select(
        "seq",
        F.when(jsontext.is_absent(F.col("after_json")), "none")
        .when(names.isNull(), "no object")
        .otherwise("object")
        .alias("kind"),
        F.array_join(F.array_sort(names), ",").alias("names"),
        F.try_variant_get(F.element_at(values, "VALUE"), "$", "double").alias("value"),
    )


@QUERIES.add("""
SELECT name, regexp_full_match(name, '[a-zA-Z]+[a-zA-Z0-9#$_]*') AND strlen(name) <= 127 AS is_valid
FROM (SELECT p_name AS name FROM part UNION ALL SELECT c_name FROM customer)""")
def valid_object_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = table(spark, sf_dir, "part").select(F.col("p_name").alias("name")).unionByName(
        table(spark, sf_dir, "customer").select(F.col("c_name").alias("name"))
    )
    return names.select("name", convert.valid_object_name(F.col("name")).alias("is_valid"))


@QUERIES.add("""
SELECT event_id,
       '{"a":{"id":' || event_id || ',"type":"' || event_type || '"},"z":[{"k":' || json_extract_string(props, '$.k') ||
       ',"user":' || user_id || '}]}' AS attributes
FROM events""")
def nested_to_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names are in order at every level: in maps within structs, and in structs within lists."""
    inner = F.struct(
        F.array(F.map_concat(F.create_map(F.lit("user"), "user_id"), F.from_json("props", "map<string,bigint>"))).alias("z"),
        F.struct(F.col("event_type").alias("type"), F.col("event_id").alias("id")).alias("a"),
    )
    rows = table(spark, sf_dir, "events").select("event_id", inner.alias("attributes"))
    return convert.write_rows(rows, {}).good
