"""Applying a feed to the parts of a target that it touches."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from changeloom.operators.apply import apply_changes
from changeloom.plans.touched import PART, PartitionedTarget

FEED = "seq bigint, operation string, k bigint, v string"


def files(root):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(root) for f in names if f.endswith(".parquet")}


@pytest.fixture
def table(spark, tmp_path):
    rows = spark.range(200).select(F.col("id").alias("k"), F.concat(F.lit("v"), "id").alias("v"))
    rows = rows.union(spark.createDataFrame([(None, "n1"), (None, "n2"), (5, "twice")], "k bigint, v string"))
    target = PartitionedTarget(spark, str(tmp_path / "t"), "k", rows.schema, 16)
    target.create(rows)
    return target


def test_untouched_files_keep_name_and_time(spark, table, rows):
    before, old = files(table.path), rows(table.read())
    feed = spark.createDataFrame([(1, "update", 5, "new"), (2, "delete", 6, None), (3, "create", 1000, "made")], FEED)
    expected = rows(apply_changes(spark.createDataFrame(old, "k bigint, v string"), feed, "k"))
    touched = {row[0] for row in table._stored().where("k IN (5, 6)").select(PART).distinct().collect()}
    table.apply(feed, ["v"])
    after = files(table.path)
    assert rows(table.read()) == expected
    changed = {p for p in before if after.get(p) != before[p]}
    assert len(changed) <= 3 and {int(p.split(f"{PART}=")[1].split("/")[0]) for p in changed} >= touched


def test_a_part_that_loses_all_rows(spark, table, rows):
    part, keys = next((p, k) for p, k in table._stored().where(f"{PART} >= 0").groupBy(PART).agg(F.collect_set("k")).collect())
    table.apply(spark.createDataFrame([(i, "delete", k, None) for i, k in enumerate(keys)], FEED), ["v"])
    assert table._stored().where(F.col(PART) == part).count() == 0
    assert {r[0] for r in rows(table.read())} == {None, *range(200)} - set(keys)
    table.apply(spark.createDataFrame([(1, "create", keys[0], "back")], FEED), ["v"])
    assert rows(table.read().where(F.col("k") == keys[0])) == [(keys[0], "back")]


def test_rows_without_a_key_and_without_an_order(spark, table, rows):
    feed = [(1, "create", None, "n3"), (2, "create", None, "n3"), (3, "delete", None, None), (None, "create", None, "lost"), (None, "delete", 7, None)]
    table.apply(spark.createDataFrame(feed, FEED), ["v"])
    found = rows(table.read())
    assert [r[1] for r in found if r[0] is None] == ["n1", "n2", "n3", "n3"] and (7, "v7") in found


def test_publishing_twice_and_an_empty_feed(spark, table, rows):
    feed = spark.createDataFrame([(1, "update", 9, "x"), (2, "create", None, "n3")], FEED)
    staged = table.stage(feed, ["v"])
    assert (9, "v9") in rows(table.read())
    table.publish(staged)
    once = rows(table.read())
    table.publish(staged)
    assert rows(table.read()) == once and (9, "x") in once and (None, "n3") in once
    before = files(table.path)
    table.apply(feed.limit(0), ["v"])
    assert files(table.path) == before
