from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from changeloom.names import CREATED_AT, OPERATION_TYPE, REASON, TRACKING_ID, ColumnType
from changeloom.operators import envelope, paging
from changeloom.plans.handover import Position, source_records
from changeloom.sources import jdbc
from changeloom.sources.versions import VersionedTable, take_snapshot

FEED = f"ID int, NAME string, {TRACKING_ID} bigint, {OPERATION_TYPE} string, {CREATED_AT} timestamp"


@pytest.fixture
def users(spark):
    return spark.createDataFrame([(1, "one"), (2, "two"), (3, "three")], "ID int, NAME string")


@pytest.fixture
def feed(spark):
    return spark.createDataFrame(
        [(4, "four", 1, "insert", None), (1, "uno", 2, "update", None), (2, "two", 3, "delete", None)], FEED
    )


def test_key_rules():
    assert envelope.key_columns(["a"], ["p", "q"], "o") == ["a"]
    assert envelope.key_columns([], ["p", "q"], "o") == ["p", "q"]
    assert envelope.key_columns(None, None, "o") == ["o"]


def test_snapshot_records(spark, users):
    record = envelope.snapshot_records(users, "USERS", "ID").where("seq = -1 AND after.ID = 2").first()
    assert (record.operation, record.key.asDict(), record.after.asDict()) == (
        "snapshot", {"ID": 2}, {"ID": 2, "NAME": "two"},
    )
    assert record.position.asDict() == {"mode": "snapshot", "last_processed_val": 2}
    assert record.metadata["oracle.table"] == "USERS" and record.metadata["created_at"]
    ordered = envelope.snapshot_records(users.orderBy(F.rand()), "USERS", "ID", ordered=True).collect()
    assert [r.key.ID for r in ordered] == [1, 2, 3]


def test_absent_columns_fail_before_any_row_is_read(users, feed):
    for options in ({"ordering": "NOPE"}, {"ordering": "ID", "keys": ["NOPE"]},
                    {"ordering": "ID", "columns": ["NAME"]}, {"ordering": "ID", "columns": ["ID", "NOPE"]}):
        with pytest.raises(ValueError):
            envelope.snapshot_records(users, "USERS", **options)
    with pytest.raises(ValueError):
        envelope.cdc_records(feed, "USERS", keys=["NOPE"])


def test_cdc_records(spark, feed):
    odd = spark.createDataFrame([(9, "x", 4, "truncate", None), (9, "x", 5, None, None)], FEED)
    good, rejects = envelope.cdc_records(feed.unionByName(odd), "USERS", keys=["ID"])
    found = {r.seq: (r.operation, r.key.ID, r.after and r.after.NAME) for r in good.collect()}
    assert found == {1: ("create", 4, "four"), 2: ("update", 1, "uno"), 3: ("delete", 2, None)}
    assert {r[TRACKING_ID]: r[REASON] for r in rejects.collect()} == dict.fromkeys((4, 5), "unknown operation type")


def read(users, feed, **options):
    records = source_records(users, feed, "USERS", "ID", **options).good
    return sorted((r.position.mode, int(r.position.last_processed_val)) for r in records.collect())


def test_reading_modes(users, feed):
    changes = [("cdc", 1), ("cdc", 2), ("cdc", 3)]
    snapshot = [("snapshot", 1), ("snapshot", 2), ("snapshot", 3)]
    assert read(users, feed) == changes + snapshot
    assert read(users, feed, snapshot=False) == changes
    assert read(users, feed, position=Position("snapshot", 2)) == changes + snapshot[2:]
    assert read(users, feed, position=Position("cdc", 2)) == changes[2:]
    # A snapshot position says nothing about tracking ids.
    assert read(users, feed, snapshot=False, position=Position("snapshot", 2)) == changes


def test_typed_rows_and_rows_set_aside(spark):
    table = "ID string, ACTIVE int"
    rows = spark.createDataFrame([("1", 1), ("2", 5), ("3.5", 0)], table)
    feed = spark.createDataFrame(
        [("4", 0, 1, "insert", None), ("x", 1, 2, "insert", None), ("5", 1, 3, "merge", None)],
        f"{table}, {TRACKING_ID} bigint, {OPERATION_TYPE} string, {CREATED_AT} timestamp",
    )
    types = {"ID": ColumnType("NUMBER"), "ACTIVE": ColumnType("NUMBER", 1, 0)}
    good, rejects = source_records(rows, feed, "USERS", "ID", types=types)
    assert {(r.after.ID, r.after.ACTIVE) for r in good.collect()} == {(1, True), (2, False), (4, False)}
    found = rejects.select(F.get_json_object("row_json", "$.ID").alias("ID"), REASON).collect()
    assert {(r.ID, r[REASON]) for r in found} == {
        ("3.5", "ID: not a whole number"), ("x", "ID: not a whole number"), ("5", "unknown operation type"),
    }


def test_an_ordering_column_of_text_can_be_handed_over(users, feed):
    records = source_records(users, feed, "USERS", "NAME", keys=["ID"]).good
    assert {r.position.last_processed_val for r in records.collect()} == {"one", "two", "three", "1", "2", "3"}


def test_empty_table(users, feed):
    assert read(users.limit(0), feed.limit(0)) == []


def test_pages_of_any_size_give_all_rows(spark):
    table = spark.range(2500).select(F.col("id").alias("ID"), (F.col("id") % 7).alias("V"))
    for size in (1000, 999, 2500):
        seen, last = [], None
        while page := paging.snapshot_page(table, "ID", last, size).collect():
            seen += [r.ID for r in page]
            last = seen[-1]
        assert seen == list(range(2500))
    assert [r.ID for r in paging.snapshot_page(table, "ID", 41, 1).collect()] == [42]
    for size in (0, 100001):
        with pytest.raises(ValueError):
            paging.snapshot_page(table, "ID", None, size)


def test_null_ordering_values_come_last_and_only_without_a_position(spark, rows):
    table = spark.createDataFrame([(None,), (2,), (1,), (2,)], "o int")
    assert [r.o for r in paging.snapshot_page(table, "o").collect()] == [1, 2, 2, None]
    assert [r.o for r in paging.snapshot_page(table, "o", 1).collect()] == [2, 2]
    assert rows(paging.ordering_audit(table, "o")) == [(None, 1), (2, 2)]


def test_change_page_keeps_control_columns(feed):
    page = paging.change_page(feed, after=1, limit=1, columns=["ID"])
    assert page.columns == ["ID", TRACKING_ID, OPERATION_TYPE, CREATED_AT]
    assert [r[TRACKING_ID] for r in page.collect()] == [2]


def test_positions(spark):
    df = spark.sql("SELECT 'snapshot' AS m, 123L AS v UNION ALL SELECT NULL, NULL")
    text = df.select(
        envelope.position_to_json(F.col("m"), F.col("v"), F.lit("abc"), F.lit("def"), F.lit("ghi")).alias("p")
    )
    written = (
        '{"mode":"snapshot","last_processed_val":123,"tracking_table":"abc","trigger":"def","snapshot_table":"ghi"}'
    )
    assert {r.p for r in text.collect()} == {written, None}
    parsed = text.select(envelope.position_from_json(F.col("p")).alias("p")).collect()
    assert {r.p and tuple(r.p) for r in parsed} == {("snapshot", 123, "abc", "def", "ghi"), None}
    bad = spark.createDataFrame([("junk",), ('{"mode":"cdc","last_processed_val":5}',)], "p string")
    good, rejects = envelope.split_positions(bad, "p")
    assert [r.p.last_processed_val for r in good.collect()] == [5]
    assert [r.p for r in rejects.collect()] == ["junk"]
    with pytest.raises(Exception, match="MALFORMED_RECORD_IN_PARSING"):
        bad.select(envelope.position_from_json(F.col("p"))).collect()


def test_resume_positions(users, feed):
    records = source_records(users, feed, "USERS", "ID").good
    found = {r.mode: int(r.last_processed_val) for r in envelope.resume_positions(records).collect()}
    assert found == {"snapshot": 3, "cdc": 3}


def test_resume_points_compare_numbers_as_numbers(spark, feed):
    for kind in ("int", "decimal(10,2)"):
        users = spark.createDataFrame([(i, "x") for i in (9, 10, 100)], "ID int, NAME string")
        users = users.withColumn("ID", F.col("ID").cast(kind))
        records = source_records(users, feed, "USERS", "ID").good
        found = {r.mode: int(r.last_processed_val) for r in envelope.resume_positions(records).collect()}
        assert found == {"snapshot": 100, "cdc": 3}


def test_resume_points_of_text_ordering(spark, feed):
    users = spark.createDataFrame([("b", "x"), ("a", "y")], "ID string, NAME string")
    more = feed.withColumn(TRACKING_ID, F.col(TRACKING_ID) + 8).withColumn("ID", F.col("ID").cast("string"))
    records = source_records(users, more, "USERS", "ID").good
    found = {r.mode: r.last_processed_val for r in envelope.resume_positions(records).collect()}
    assert found == {"snapshot": "b", "cdc": "11"}


def test_resuming_inside_a_snapshot_loses_nothing(spark, tmp_path, feed):
    users = spark.createDataFrame([(3, "c"), (1, "a"), (None, "n"), (2, "b")], "ID int, NAME string")
    copy = str(tmp_path / "copy")
    first = source_records(users, feed.limit(0), "USERS", "ID", copy=copy).good
    ids = [r.key.ID for r in first.where("operation = 'snapshot'").collect()]
    assert ids == [1, 2, 3, None]
    position = Position("snapshot", 1)
    # The table has changed meanwhile; the copy has not.
    rest = source_records(users.limit(0), feed.limit(0), "USERS", "ID", position=position, copy=copy).good
    assert [r.key.ID for r in rest.where("operation = 'snapshot'").collect()] == [2, 3, None]


def test_ill_typed_and_cut_positions_are_set_aside(spark):
    texts = ['{"mode":"cdc","last_processed_val":5}', '{"mode":"cdc","last_processed_val":"x"}', '{"mode":"cdc","last', "[1]", None]
    good, rejects = envelope.split_positions(spark.createDataFrame([(t,) for t in texts], "p string"), "p")
    assert sorted((r.p.last_processed_val if r.p else 0) for r in good.collect()) == [0, 5]
    assert {r.p for r in rejects.collect()} == set(texts[1:4])


def test_a_snapshot_does_not_see_later_changes(spark, tmp_path, rows):
    source = str(tmp_path / "source")
    spark.range(3).write.parquet(source)
    copy = take_snapshot(spark.read.parquet(source), str(tmp_path / "copy"))
    spark.range(3, 5).write.mode("append").parquet(source)
    assert rows(copy) == [(0,), (1,), (2,)]


def test_versions(spark, tmp_path, rows):
    table = VersionedTable(spark, str(tmp_path / "table"))
    with pytest.raises(ValueError):
        table.read()
    assert table.append(spark.range(2)) == 0
    assert table.append(spark.range(2, 3)) == 1
    # The new content is made from the old one.
    assert table.replace(table.read().where("id > 0")) == 2
    assert table.append(spark.range(7, 8)) == 3
    assert rows(table.read()) == [(1,), (2,), (7,)]
    assert rows(table.read(through=1)) == [(0,), (1,), (2,)]
    # A write may stand for the newest ones only.
    assert table.replace(spark.range(8, 10), first=3, level=1) == 4
    assert rows(table.read()) == [(1,), (2,), (8,), (9,)]
    assert rows(table.read(through=3)) == [(1,), (2,), (7,)]
    again = VersionedTable(spark, str(tmp_path / "table"))
    assert again.last_entry() == 4 and [e.number for e in again.live_entries()] == [2, 4]


def test_jdbc_options():
    assert jdbc.scan_options("jdbc:x", "t") == {"url": "jdbc:x", "dbtable": "t", "fetchsize": "10000"}
    parts = jdbc.scan_options("jdbc:x", query="SELECT 1", partition_column="ID", bounds=(1, 9), partitions=4)
    assert parts["dbtable"] == "(SELECT 1) part_source"
    assert (parts["partitionColumn"], parts["lowerBound"], parts["upperBound"], parts["numPartitions"]) == (
        "ID", "1", "9", "4",
    )
    for wrong in ({}, {"table": "t", "query": "q"}, {"table": "t", "partition_column": "ID"}):
        with pytest.raises(ValueError):
            jdbc.scan_options("jdbc:x", **wrong)
    assert jdbc.page_query("T", "ID", 5, 10, ["ID", "A"]) == (
        "SELECT ID, A FROM T WHERE ID > 5 ORDER BY ID ASC FETCH NEXT 10 ROWS ONLY"
    )
    assert jdbc.page_query("T", "ID", None, 10) == "SELECT * FROM T ORDER BY ID ASC FETCH NEXT 10 ROWS ONLY"
