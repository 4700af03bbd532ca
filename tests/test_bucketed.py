"""Changes in buckets: the same rows as without, and no shuffle when they are read."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from changeloom.sources.bucketed import declare_bucketed, write_bucketed
from changeloom.streaming.sink import ChangeSink

FEED = "seq bigint, operation string, k bigint, v string, w bigint"


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def batches(spark):
    rows = [(s, "delete" if s % 7 == 0 else "update", s * 5 % 23 if s % 11 else None, f"v{s}", s) for s in range(120)]
    return [spark.createDataFrame(rows[i::4], FEED) for i in (2, 0, 3, 1)]


def exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_reading_and_merging_shuffle_nothing(spark, tmp_path, rows, no_broadcast):
    target = spark.range(40).select(F.col("id").alias("k"), F.lit("old").alias("v"), F.lit(0).cast("bigint").alias("w"))
    write_bucketed(target, f"{tmp_path}/target", "k", 4)
    plain = ChangeSink(spark, f"{tmp_path}/plain", "k", ["v", "w"], merge_every=3)
    sink = ChangeSink(spark, f"{tmp_path}/changes", "k", ["v", "w"], merge_every=3, buckets=4)
    for batch in batches(spark):
        plain.write_batch(batch)
        sink.write_batch(batch)
        sink.write_batch(batch)
    declared = declare_bucketed(spark, f"{tmp_path}/target", target.schema, "k", 4)
    keyed = sink.changes.read()
    assert exchanges(sink._merged(keyed)) == 0
    after = sink.current(declared, unique_target=True)
    # The rows without a key, which lie apart, are the only ones that are dealt out.
    assert exchanges(after) == 1
    assert rows(after) == rows(plain.current(target)) and any(r[0] is None for r in rows(after))
    # A new session knows no tables: they are declared again.
    for name in spark.catalog.listTables():
        if name.name.startswith("changeloom_"):
            spark.sql(f"DROP TABLE {name.name}")
    again = ChangeSink(spark, f"{tmp_path}/changes", "k", ["v", "w"], merge_every=3, buckets=4)
    assert rows(again.current(declare_bucketed(spark, f"{tmp_path}/target", target.schema, "k", 4), unique_target=True)) == rows(after)
    assert len(sink.changes.live_entries()) < 8


def test_equal_rows_without_a_key(spark, tmp_path):
    """One source row read twice is one insert; two equal source rows are two."""
    batch = lambda ids: spark.createDataFrame([(-1, "snapshot", None, "v", 1, i) for i in ids], FEED + ", source bigint")
    nothing = spark.createDataFrame([], "k bigint, v string, w bigint")
    for options, wanted in (({"row_id": ["source"]}, 3), ({"row_id": ["source"], "buckets": 2}, 3), ({}, 2)):
        sink = ChangeSink(spark, f"{tmp_path}/{len(options)}", "k", ["v", "w"], **options)
        for ids in ([1, 2], [3], [2, 1]):
            sink.write_batch(batch(ids))
        assert sink.current(nothing).count() == wanted
