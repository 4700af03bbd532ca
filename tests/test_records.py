from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from changeloom.functions.jsontext import object_names, parse_object
from changeloom.names import METADATA_TABLE, REASON
from changeloom.operators import records as ops
from changeloom.plans import sync

RECORDS = "seq bigint, operation string, metadata map<string,string>, key_json string, after_json string"
TARGET = "id bigint, name string, is_active int, created timestamp_ntz, file binary, attributes string"


def reasons(spark, cases, schema=None, tables=None):
    """Reject reason per case; cases are (operation, key, payload) or with a table name."""
    data = [
        (i, c[0], {METADATA_TABLE: c[3]} if len(c) > 3 else {}, c[1], c[2]) for i, c in enumerate(cases)
    ]
    parsed = ops.parse_records(spark.createDataFrame(data, RECORDS), "users", "id")
    good, rejects = ops.check_records(parsed, schema, tables)
    found = {r.seq: r[REASON] for r in rejects.collect()}
    assert {r.seq for r in good.collect()} == set(range(len(cases))) - set(found)
    return [found.get(i) for i in range(len(cases))]


def test_reasons_in_the_order_a_record_is_worked_on(spark):
    cases = {
        ("create", '{"id":1}', '{"name":"x"}'): None,
        ("snapshot", None, '{"id":1,"name":"x"}'): None,
        ("update", None, None): ops.EMPTY_PAYLOAD,
        ("update", "{1", ""): ops.EMPTY_PAYLOAD,
        ("update", '{"id":1,"b":2}', "[1]"): ops.BAD_PAYLOAD,
        ("update", '{"id":1}', "null"): None,
        ("update", '{"id":1}', "{}"): None,
        ("update", None, "{}"): ops.NO_COLUMN,
        ("update", "not json", '{"id":1,"name":"x"}'): None,
        ("update", '{"id":1,"b":2}', '{"id":1}'): ops.COMPOSITE_KEY,
        ("update", '{"id":1}', '{"name":"x","NAME":"y"}'): ops.REPEATED_NAME,
        ("update", '{"id":1,"ID":2}', '{"name":"x"}'): ops.REPEATED_NAME,
        ("delete", '{"id":1}', None): None,
        ("delete", '{"id":null}', None): None,
        ("delete", "not json", None): ops.BAD_KEY,
        ("delete", '{"id":1,"b":2}', None): ops.COMPOSITE_KEY,
        ("delete", None, None): ops.EMPTY_KEY,
        ("delete", "", '{"id":1}'): ops.EMPTY_KEY,
        ("delete", "{}", '{"id":1}'): ops.EMPTY_KEY,
        ("delete", '{"id":1}', "not json"): None,
    }
    assert reasons(spark, list(cases)) == list(cases.values())


def test_reasons_that_need_the_target(spark):
    schema = spark.createDataFrame([], TARGET).schema
    cases = {
        ("create", None, '{"id":1,"wrong_column":"x"}'): ops.UNKNOWN_COLUMN,
        ("update", '{"code":1}', '{"name":"x"}'): ops.UNKNOWN_COLUMN,
        ("delete", '{"code":1}', None): ops.UNKNOWN_COLUMN,
        ("create", None, '{"id":1,"created":"2021-02-03 04:05:06"}'): ops.BAD_VALUE + " CREATED",
        ("create", None, '{"id":1,"created":12}'): ops.BAD_VALUE + " CREATED",
        ("create", None, '{"id":1,"file":12}'): ops.BAD_VALUE + " FILE",
        ("create", None, '{"id":"x"}'): ops.BAD_VALUE + " ID",
        ("delete", '{"id":"x"}', None): ops.BAD_VALUE + " ID",
        ("create", None, '{"id":null,"created":null,"file":null}'): None,
        ("create", None, '{"id":1}', "elsewhere"): ops.UNKNOWN_TABLE,
        ("create", None, '{"id":1}', "Users"): None,
    }
    assert reasons(spark, list(cases), schema, ["users"]) == list(cases.values())


def test_payload_values_take_the_column_types(spark, rows):
    target = spark.createDataFrame([], TARGET)
    payload = (
        '{"Id":12345678901234567,"NAME":5,"is_active":true,"created":"Wed, 04 Oct 1989 13:14:15 UTC",'
        '"file":"test123","attributes":{"b":[1,true,"<x>"],"a":null}}'
    )
    data = [(1, "create", {}, '{"id":12345678901234567}', payload), (2, "create", {}, None, '{"id":7,"is_active":0}')]
    after, rejects = sync.apply_records(target, spark.createDataFrame(data, RECORDS), "users", "id")
    assert rejects.count() == 0
    assert after.columns == target.columns
    assert rows(after) == [
        (7, None, 0, None, None, None),
        (
            12345678901234567, "5", 1, dt.datetime(1989, 10, 4, 13, 14, 15), bytearray(b"test123"),
            '{"a":null,"b":[1,true,"\\u003cx\\u003e"]}',
        ),
    ]


def test_flags_kept_as_booleans(spark, rows):
    target = spark.createDataFrame([], "id int, flag boolean")
    payloads = ["true", "false", "1", "0", "5", "null", '"x"']
    records = [(i, "create", None, f'{{"id":{i},"flag":{p}}}') for i, p in enumerate(payloads)]
    after, rejects = run(spark, target, records)
    assert rows(after) == [(0, True), (1, False), (2, True), (3, False), (4, False), (5, None)]
    assert rows(rejects, REASON) == [(ops.BAD_VALUE + " FLAG",)]


def run(spark, target, records, **options):
    frame = spark.createDataFrame([(s, o, {}, k, a) for s, o, k, a in records], RECORDS)
    return sync.apply_records(target, frame, "users", "id", **options)


def test_key_rules(spark, rows):
    target = spark.createDataFrame([(1, "one", 10), (2, "two", 20), (None, "none", 0)], "id int, name string, age int")
    records = [
        (1, "update", '{"id":1}', '{"name":"uno"}'),
        # the payload's key value goes before the record key's
        (2, "update", '{"id":1}', '{"id":2,"name":"dos"}'),
        # key text that is no JSON: the configured key column in the payload is used
        (3, "update", "raw", '{"id":3,"name":"tres"}'),
        # no key anywhere, or a NULL one: a plain insert each time
        (4, "create", None, '{"name":"nadie"}'),
        (5, "create", '{"id":null}', '{"name":"nadie"}'),
        # NULL equals nothing, so this deletes nothing
        (6, "delete", '{"id":null}', None),
        # only the key: inserted if absent
        (7, "update", '{"id":1}', "{}"),
        (8, "update", '{"id":9}', "null"),
        # sent as NULL, not left out
        (9, "update", '{"id":1}', '{"age":null}'),
    ]
    after, rejects = run(spark, target, records)
    assert rejects.count() == 0
    assert rows(after) == [
        (None, "nadie", None), (None, "nadie", None), (None, "none", 0),
        (1, "uno", None), (2, "dos", 20), (3, "tres", None), (9, None, None),
    ]


def test_columns_named_like_record_fields(spark, rows):
    target = spark.createDataFrame(
        [(1, 5, "x", "t")], "id int, seq int, operation string, table_name string"
    )
    records = [
        (1, "update", '{"id":1}', '{"seq":6,"operation":"delete"}'),
        (2, "create", None, '{"id":2,"table_name":"u"}'),
    ]
    after, _ = run(spark, target, records)
    assert rows(after) == [(1, 6, "delete", "t"), (2, None, None, "u")]


def test_records_with_different_key_columns(spark, rows):
    """Each run of records with one key column is a step of its own."""
    target = spark.createDataFrame([(1, "a", 10), (2, "b", 20)], "id int, code string, age int")
    records = [
        (1, "update", '{"id":1}', '{"code":"c"}'),
        (2, "update", '{"code":"c"}', '{"age":11}'),
        (3, "delete", '{"code":"b"}', None),
        (4, "update", '{"id":2}', '{"code":"d"}'),
        (5, "update", '{"code":"d"}', '{"age":22}'),
        (6, "update", '{"code":"a"}', '{"age":33}'),
    ]
    after, _ = run(spark, target, records)
    assert rows(after, "id", "code", "age") == [(None, "a", 33), (1, "c", 11), (2, "d", 22)]


def test_stop_at_the_first_bad_record(spark, rows):
    target = spark.createDataFrame([], "id int, name string")
    records = [
        (5, "create", None, '{"id":1,"name":"x"}'),
        (7, "create", None, '{"id":2,"other":"y"}'),
        (9, "create", None, '{"id":3,"name":"z"}'),
        (11, "create", None, None),
    ]
    after, rejects = run(spark, target, records, stop_at_first_bad=True)
    assert rows(after) == [(1, "x")]
    assert rows(rejects, "seq") == [(7,), (11,)]
    after, _ = run(spark, target, records)
    assert rows(after) == [(1, "x"), (3, "z")]
    after, _ = run(spark, target, records[:1], stop_at_first_bad=True)
    assert rows(after) == [(1, "x")]


def test_nothing_to_apply(spark, rows):
    target = spark.createDataFrame([(1, "x")], "id int, name string")
    after, rejects = run(spark, target, [(1, "create", None, None)])
    assert rows(after) == [(1, "x")] and rejects.count() == 1


def test_tables_of_different_shapes_are_split_once(spark, rows):
    feed = spark.createDataFrame([("A", 1), ("B", 2), ("A", 3)], "table_name string, n int")
    split = sync.split_by_table(feed)
    only_a = split.where("table_name = 'A'")
    assert rows(only_a, "n") == [(1,), (3,)]
    assert "PartitionFilters: [isnotnull(table_name" in only_a._jdf.queryExecution().executedPlan().toString()
    assert rows(split.where("table_name = 'B'"), "n") == [(2,)]


def test_records_for_tables_of_many_shapes(spark, rows):
    users = spark.createDataFrame([(1, "one")], "id int, name string")
    orders = spark.createDataFrame([("a", 5.0)], "code string, price double")
    data = [
        (1, "update", {METADATA_TABLE: "Users"}, '{"id":1}', '{"name":"uno"}'),
        (2, "create", {METADATA_TABLE: "orders"}, '{"code":"b"}', '{"price":7.5}'),
        (3, "delete", {METADATA_TABLE: "ORDERS"}, '{"code":"a"}', None),
        (4, "create", {}, None, '{"id":2,"name":"two"}'),
        (5, "create", {}, None, '{"id":3,"price":1}'),
        (6, "create", {METADATA_TABLE: "nowhere"}, None, '{"id":3}'),
    ]
    after, rejects = sync.apply_to_tables(
        {"users": users, "orders": orders}, spark.createDataFrame(data, RECORDS), "users",
        {"users": "id", "orders": "code"},
    )
    assert rows(after["users"]) == [(1, "uno"), (2, "two")]
    assert rows(after["orders"]) == [("b", 7.5)]
    assert rows(rejects, "seq", REASON) == [(5, ops.UNKNOWN_COLUMN), (6, ops.UNKNOWN_TABLE)]


@pytest.mark.parametrize(("key", "expected"), [('{"b":1}', "B"), ("{}", "ID"), ("x", "ID"), (None, "ID")])
def test_key_column(spark, key, expected):
    df = spark.createDataFrame([(key,)], "key_json string")
    assert df.select(ops.key_column_of(object_names(parse_object(F.col("key_json"))), "id")).first()[0] == expected
