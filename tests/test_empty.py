"""Nothing in, nothing out, and no error."""

from __future__ import annotations

from changeloom.names import TRACKING_ID
from changeloom.operators import capture
from changeloom.operators.apply import apply_changes, delete_keys
from changeloom.plans import sync
from changeloom.streaming.sink import ChangeSink
from changeloom.streaming.tail import land, land_new, start, tail
from tests.test_records import RECORDS

FEED = f"{TRACKING_ID} bigint, seq bigint, operation string, k int, v string"


def test_no_change_between_versions(spark):
    table = spark.createDataFrame([(1, "a"), (None, "b")], "k int, v string")
    changes = capture.capture_diff(table, table, ["k"])
    assert changes.count() == 0
    assert capture.number_changes(changes, ["k"]).count() == 0


def test_empty_feed_and_empty_target(spark, rows):
    target = spark.createDataFrame([(1, "a")], "k int, v string")
    feed = spark.createDataFrame([], FEED)
    assert rows(apply_changes(target, feed, "k")) == [(1, "a")]
    assert rows(sync.apply_measured(target, feed, "k", ["v"])) == [(1, "a")]
    assert rows(delete_keys(target, feed, "k"), "k", "v") == [(1, "a")]
    one = spark.createDataFrame([(1, 1, "create", 2, "b")], FEED)
    assert rows(apply_changes(target.limit(0), one, "k")) == [(2, "b")]
    after, rejects = sync.apply_records(target, spark.createDataFrame([], RECORDS), "t", "k")
    assert rows(after) == [(1, "a")] and rejects.count() == 0


def test_empty_batches(spark, tmp_path, rows):
    target = spark.createDataFrame([(1, "a")], "k int, v string")
    feed = spark.createDataFrame([], FEED)
    sink = ChangeSink(spark, str(tmp_path / "changes"), "k", ["v"], merge_every=2)
    for _ in range(3):
        sink.write_batch(feed)
    assert rows(sink.current(target)) == [(1, "a")]
    landing = str(tmp_path / "landing")
    land(feed, landing)
    land_new(feed, landing)
    land_new(spark.createDataFrame([(1, 1, "delete", 1, None)], FEED), landing)
    start(sink.writer(tail(spark, landing, feed.schema)), str(tmp_path / "checkpoint")).awaitTermination()
    assert rows(sink.current(target)) == []
