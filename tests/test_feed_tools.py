"""Digests, page numbers, figures, chunks and the stream that stops at a bad record."""

from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F

from changeloom.operators.capture import capture_diff
from changeloom.operators.digests import capture_by_digest, differing_rows, digests
from changeloom.operators.paging import page_index, snapshot_page
from changeloom.plans.chunks import ChunkedSnapshot, chunk_ranges
from changeloom.plans.figures import figures_row, observed, observed_stream, stream_figures
from changeloom.streaming.prefix import PrefixSink, StoppedAtRecord

VERSION = "id int, a string, b int"


def test_digests_find_what_differs_and_little_else(spark, rows):
    old = spark.range(5000).select(F.col("id").cast("int").alias("id"), F.lit("a").alias("a"), (F.col("id") % 7).cast("int").alias("b"))
    new = old.where("id <> 77").withColumn("a", F.when(F.col("id") == 400, F.lit(None)).otherwise(F.col("a")))
    new = new.union(spark.createDataFrame([(9001, "new", 1)], VERSION))
    assert rows(capture_by_digest(old, new, ["id"])) == rows(capture_diff(old, new, ["id"])) and capture_diff(old, new, ["id"]).count() == 3
    # Only rows of three of 65,536 ranges are compared.
    assert sum(df.count() for df in differing_rows(old, new, ["id"])) < 20
    kept = digests(old, ["id"], 1024, 64).cache()
    assert rows(capture_by_digest(old, new, ["id"], old_digests=kept)) == rows(capture_diff(old, new, ["id"]))


def test_digests_of_repeated_and_null_keys_and_empty_versions(spark, rows):
    draw = random.Random(1)
    make = lambda: [(draw.choice([None, 1, 2, 3]), draw.choice(["x", None]), draw.randint(0, 1)) for _ in range(12)]
    for old, new in [(make(), make()), ([(1, "x", 1)] * 2 + [(1, "y", 1)], [(1, "x", 1)] + [(1, "y", 1)] * 2), ([], make()), (make(), []), ([], [])]:
        old, new = spark.createDataFrame(old, VERSION), spark.createDataFrame(new, VERSION)
        assert rows(capture_by_digest(old, new, ["id"], coarse=4, fine=4)) == rows(capture_diff(old, new, ["id"]))
    with pytest.raises(ValueError):
        capture_by_digest(old, new.drop("b"), ["id"])


def test_page_numbers_are_those_of_successive_pages(spark, rows):
    values = random.Random(2).sample(range(1000), 53)
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v int")
    numbered, last = page_index(df, "v", 10), None
    for number in range(6):
        page = rows(snapshot_page(df.where("v IS NOT NULL"), "v", last, 10))
        assert rows(numbered.where(F.col("page") == number), "v") == page
        last = page[-1][0]
    assert rows(numbered.where("page IS NULL")) == [(None, None)]
    ties = page_index(spark.createDataFrame([(1,)] * 7, "v int"), "v", 3)
    assert rows(ties.groupBy("page").count()) == [(0, 3), (1, 3), (2, 1)]
    with pytest.raises(ValueError):
        page_index(df, "v", 0)


def test_figures_of_a_run_and_of_a_stream(spark, tmp_path, rows):
    data = [(1, "create", None), (2, "delete", None), (3, "update", "bad"), (5, None, "bad"), (None, "update", None)]
    df = spark.createDataFrame(data, "seq bigint, operation string, reject_reason string")
    watched, found = observed(df)
    assert watched._jdf.queryExecution().optimizedPlan().toString().count("CollectMetrics") == 1
    assert watched.count() == 5 and rows(figures_row(df, found)) == [(5, 5, 1, 2, 3)]
    df.write.parquet(f"{tmp_path}/in")
    stream = observed_stream(spark.readStream.schema(df.schema).parquet(f"{tmp_path}/in"), "figures")
    query = stream.writeStream.format("noop").option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start()
    query.awaitTermination()
    assert stream_figures(query, "figures") == [{"batch": 0, "last_seq": 5, "n_records": 5, "n_deletes": 1, "n_bad": 2, "first_bad": 3}]


def test_chunks_leave_out_what_changed_meanwhile(spark, tmp_path, rows):
    table = {"rows": [(i, f"v{i}") for i in range(20)] + [(None, "null")]}
    feed, clock = [], {"id": 0}

    def change(key):
        clock["id"] += 1
        feed.append((clock["id"], key))

    def read():
        change(3)  # in the middle of every chunk
        return spark.createDataFrame(table["rows"], "k int, v string")

    feed_table = lambda: spark.createDataFrame(feed, "CONNECTOR_TRACKING_ID bigint, k int")
    snapshot = lambda: ChunkedSnapshot(spark, str(tmp_path), ["k"], "k", read, feed_table, lambda: clock["id"])
    chunks = chunk_ranges(spark.createDataFrame(table["rows"], "k int, v string"), "k", 3)
    assert len(chunks) == 3 and chunks[0].after is None and chunks[-1].upto is None
    snapshot().run(chunks[:1])
    snapshot().run(chunks)
    found = rows(snapshot().rows(), "k", "v", "seq")
    # Key 3 lies in the first chunk, in which it changed; the changes during later chunks do not touch theirs.
    assert [r[0] for r in found] == [None, *[i for i in range(20) if i != 3]]
    assert rows(snapshot().done()) == [(0, 0, 1), (1, 1, 2), (2, 2, 3)]
    assert chunk_ranges(spark.createDataFrame([], "k int"), "k", 3) == [(0, None, None)]


def test_a_stream_stops_at_a_bad_record_and_goes_on(spark, tmp_path, rows):
    fields = "seq bigint, operation string, metadata map<string,string>, key_json string, after_json string"
    record = lambda s, after: (s, "update", {}, json.dumps({"id": s % 3}), after)
    good = lambda s: record(s, json.dumps({"v": f"v{s}"}))
    schema = spark.createDataFrame([], "id bigint, v string").schema
    batch = spark.createDataFrame([good(1), good(2), record(3, None), good(4), record(5, "[]"), good(6)], fields)
    target = spark.createDataFrame([(0, "old")], schema)
    sink = PrefixSink(spark, str(tmp_path), schema, "t", "id")
    assert sink.acknowledged().collect() == []
    with pytest.raises(StoppedAtRecord) as stop:
        sink.write_batch(batch, 0)
    assert (stop.value.seq, rows(sink.acknowledged())) == (3, [(0, 2, 2, 3)])
    assert rows(sink.current(target)) == [(0, "old"), (1, "v1"), (2, "v2")]
    # The same once more changes nothing; with the record given up it goes on to the next bad one.
    for given_up, seq in (((), 3), ((3,), 5)):
        with pytest.raises(StoppedAtRecord) as stop:
            PrefixSink(spark, str(tmp_path), schema, "t", "id", given_up).write_batch(batch, 0)
        assert stop.value.seq == seq
    last = PrefixSink(spark, str(tmp_path), schema, "t", "id", (3, 5))
    last.write_batch(batch, 0)
    assert rows(last.acknowledged()) == [(0, 6, 4, None)] and rows(last.current(target)) == [(0, "v6"), (1, "v4"), (2, "v2")]
