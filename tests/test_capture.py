from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from changeloom.names import OPERATION_TYPE, TRACKED_OPERATIONS, TRACKING_ID
from changeloom.operators import capture
from changeloom.operators.apply import apply_changes
from changeloom.operators.purge import acknowledged_ids, purge_acknowledged, purge_through

VERSION = "id int, a string, b int"


def versions(spark, old, new):
    return spark.createDataFrame(old, VERSION), spark.createDataFrame(new, VERSION)


def test_insert_update_delete(spark, rows):
    old, new = versions(
        spark,
        [(1, "same", 1), (2, "old", 2), (3, None, 3), (4, "gone", 4)],
        [(1, "same", 1), (2, "new", 2), (3, "filled", 3), (5, "came", 5)],
    )
    assert rows(capture.capture_diff(old, new, ["id"])) == [
        (2, "new", 2, "update"), (3, "filled", 3, "update"), (4, "gone", 4, "delete"), (5, "came", 5, "insert"),
    ]
    # A change of a column that is not asked for is a change all the same.
    old, new = versions(spark, [(1, "x", 1)], [(1, "x", 2)])
    assert rows(capture.capture_diff(old, new, ["id"], ["id", "a"])) == [(1, "x", "update")]


def test_keys_that_are_null_or_shared(spark, rows):
    old, new = versions(
        spark,
        [(None, "same", 1), (None, "same", 1), (None, "gone", 1), (7, "x", 1), (7, "y", 1), (8, "z", 1), (8, "z", 1)],
        [(None, "same", 1), (None, "same", 1), (7, "x", 1), (7, "w", 1), (7, "v", 1), (8, "z", 1)],
    )
    assert rows(capture.capture_diff(old, new, ["id"])) == [
        (None, "gone", 1, "delete"), (7, "v", 1, "insert"), (7, "w", 1, "insert"), (7, "y", 1, "delete"),
        (8, "z", 1, "delete"),
    ]


def test_many_equal_rows_are_all_logged(spark, monkeypatch):
    monkeypatch.setattr(capture, "_COPIES_PER_STEP", 7)
    old = spark.range(100).select(F.lit(1).alias("id"), F.lit("x").alias("a"), F.lit(1).alias("b"))
    new = spark.createDataFrame([], VERSION)
    for n in (1, 6, 7, 8, 14, 100):
        changes = capture.capture_diff(old.limit(n), new, ["id"])
        assert changes.count() == n
        assert changes.distinct().count() == 1
    numbered = capture.capture_diff(old, new, ["id"], copy_number="n")
    assert sorted(r.n for r in numbered.collect()) == list(range(1, 101))
    ids = capture.number_changes(numbered, ["id"])
    assert [(r[TRACKING_ID], r.n) for r in ids.orderBy(TRACKING_ID).collect()] == [(i, i) for i in range(1, 101)]


def test_numbered_changes_lead_from_old_to_new(spark, rows):
    rng = random.Random(4)

    def version():
        return [(k, rng.choice(["x", "y"]), rng.choice([None, 1])) for k in range(200) if rng.random() < 0.6]

    old, new = versions(spark, version(), version())
    changes = capture.number_changes(capture.capture_diff(old, new, ["id"]), ["id"], start=10)
    ids = sorted(r[0] for r in changes.select(TRACKING_ID).collect())
    assert ids == list(range(11, 11 + len(ids)))
    assert [r.id for r in changes.orderBy(TRACKING_ID).collect()] == sorted(r.id for r in changes.collect())
    operation = F.col(OPERATION_TYPE)
    assert {r[0] for r in changes.select(operation).distinct().collect()} == set(TRACKED_OPERATIONS)
    feed = changes.select("id", "a", "b", F.col(TRACKING_ID).alias("seq"), operation.alias("operation"))
    assert rows(apply_changes(old, feed, "id")) == rows(new)


def test_asked_columns_must_hold_the_keys(spark):
    old, new = versions(spark, [], [])
    with pytest.raises(ValueError, match="id"):
        capture.capture_diff(old, new, ["id"], ["a"])
    with pytest.raises(ValueError, match="nope"):
        capture.capture_diff(old, new, ["nope"])


def test_purge(spark, rows):
    feed = spark.createDataFrame([(1,), (2,), (3,), (4,)], f"{TRACKING_ID} bigint")
    positions = spark.createDataFrame(
        [(("cdc", 2),), (("cdc", 3),), (("cdc", 3),), (("snapshot", 4),)],
        "position struct<mode: string, last_processed_val: bigint>",
    )
    assert rows(purge_acknowledged(feed, acknowledged_ids(positions))) == [(1,), (4,)]
    assert rows(purge_through(feed, 3)) == [(4,)]
