"""Plans that must hold at any size."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from changeloom.operators import apply as apply_ops
from changeloom.operators import capture, paging
from changeloom.operators import state as state_ops
from workload import ALL, fixtures
from tests.harness import SF_DIR

STREAMING = {"stream_tail", "stream_resume", "stream_replay", "stream_bootstrap", "late_rows", "stream_records"}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(ALL) - STREAMING))
def test_no_cross_join_no_python(spark, name):
    text = plan(ALL[name].run(spark, SF_DIR))
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "ArrowEvalPython", "BatchEvalPython", "MapInPandas"):
        assert word not in text


def test_page_filter_and_columns_reach_the_scan(spark):
    text = plan(ALL["snapshot_page_after"].run(spark, SF_DIR))
    assert "GreaterThan(o_orderkey,499)" in text
    assert "TakeOrderedAndProject" in text
    assert re.search(r"ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_totalprice:double>", text)


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_apply_shuffles_partial_aggregates_and_the_target_once(spark, no_broadcast):
    df = ALL["apply_partial"].run(spark, SF_DIR)
    df.collect()
    final = plan(df).split("== Initial Plan ==")[0]
    # The feed is read once for the keyed changes; its second use is the same exchange.
    assert "ReusedExchange" in final


SKEW = {
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
}


@pytest.fixture
def small_skew_limits(spark, no_broadcast):
    for name, value in SKEW.items():
        spark.conf.set(name, value)
    yield
    for name in SKEW:
        spark.conf.unset(name)


def hot_rows(spark, n):
    """A third of the rows have one key."""
    key = F.when(F.col("id") % 3 == 0, F.lit(5)).otherwise(F.col("id"))
    wide = F.sha2(F.col("id").cast("string"), 256)
    return spark.range(0, n, 1, 8).select(key.alias("k"), F.col("id").alias("v"), wide.alias("w"))


def test_a_hot_target_key_is_split(spark, small_skew_limits):
    target = hot_rows(spark, 200000)
    feed = spark.range(0, 100000, 1, 4).select(
        F.col("id").alias("seq"), F.lit("update").alias("operation"), F.col("id").alias("k"), F.lit(-1).alias("v")
    )
    applied = apply_ops.apply_changes(target, feed, "k", ["v"])
    counts = applied.groupBy("v").count().where("v = -1")
    df = applied.select("k", "v")
    rows = df.collect()
    assert len(rows) == 200000 + len(set(range(0, 100000, 3)) - {5})
    assert "SortMergeJoin(skew=true)" in plan(df)
    assert counts.first()["count"] == sum(1 for r in rows if r.v == -1)
    deleted = apply_ops.delete_keys(target, feed.where("k <= 5"), "k")
    assert len(deleted.collect()) == 200000 - 66667 - 4
    assert "SortMergeJoin(skew=true)" in plan(deleted)


def test_a_hot_key_of_changed_rows_is_split(spark, small_skew_limits):
    old = hot_rows(spark, 100000)
    changes = capture.capture_diff(old, old.where("v < 0"), ["k"])
    assert len(changes.collect()) == 100000
    assert "SortMergeJoin(skew=true)" in plan(changes)


def test_a_bucketed_target_stays_where_it_is(spark, no_broadcast):
    hot_rows(spark, 3000).where("k <> 5").write.bucketBy(8, "k").sortBy("k").saveAsTable("bucketed_target")
    try:
        feed = spark.range(0, 5000).select(
            F.col("id").alias("seq"), F.lit("update").alias("operation"), F.col("id").alias("k"), F.lit(-1).alias("v")
        )
        df = apply_ops.apply_changes(spark.table("bucketed_target"), feed, "k", ["v"], unique_target=True)
        joined = plan(df)
        full_join = joined[joined.index("FullOuter"):]
        # One join reads the target, once, where it lies.
        assert joined.count("Bucketed: true") == 1 and "LeftAnti" not in joined
        assert "Exchange hashpartitioning(k" not in full_join[: full_join.index("Bucketed: true")]
        assert df.count() == 5000
    finally:
        spark.sql("DROP TABLE bucketed_target")


def test_measured_apply_does_not_shuffle_the_target(spark):
    df = ALL["apply_partial_measured"].run(spark, SF_DIR)
    df.collect()
    final = plan(df).split("== Initial Plan ==")[0]
    assert "SortMergeJoin" not in final
    # Only the keys that are in both are shuffled, for their distinct.
    assert "hashpartitioning(c_acctbal" not in final


def test_records_are_parsed_once(spark):
    text = plan(ALL["reject_unknown_column"].run(spark, SF_DIR))
    assert "Generate inline" in text
    below = text.split("Generate inline")[-1]
    filters = [line for line in text.splitlines() if re.search(r"\bFilter\b", line)]
    assert all("from_json" not in line for line in filters)
    assert below


def test_a_hot_key_is_reduced_before_the_shuffle(spark, tmp_path):
    """A key with nearly all changes reaches the shuffle as one row per task."""
    feed = spark.range(0, 200000, 1, 8).select(
        F.col("id").alias("seq"), F.lit("update").alias("operation"),
        F.when(F.col("id") % 10 == 0, F.col("id")).otherwise(-1).alias("k"), F.col("id").alias("v"),
    )
    summary = apply_ops.summarise(feed, "k", ["v"])
    summary.write.parquet(str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).where("k = -1").first()._set_v == 199999
    text = plan(summary)
    assert text.index("partial_max_by") > text.index("Exchange hashpartitioning(k")


def test_capture_hashes_whole_rows(spark):
    old, new = fixtures.table_versions(spark, SF_DIR)
    text = plan(capture._net_rows(old, new))
    exchanges = [line for line in text.splitlines() if "Exchange hashpartitioning" in line]
    assert len(exchanges) == 1 and all(c in exchanges[0] for c in old.columns)


def test_state_is_shuffled_once_by_key(spark, no_broadcast):
    feed = fixtures.change_feed(spark, SF_DIR)
    state = state_ops.to_state(feed, "k", ["value"], "present")
    df = state_ops.apply_state(fixtures.apply_target(spark, SF_DIR), state, "k", ["value"])
    text = plan(df)
    assert not re.search(r"Exchange hashpartitioning\(_key_k", text)


def test_page_order(spark):
    assert "ASC NULLS LAST" in plan(paging.change_page(fixtures.tracking_table(spark, SF_DIR)))
