"""The aggregate form of apply against records applied one by one."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from changeloom.operators import apply as apply_ops
from changeloom.operators import state as state_ops
from changeloom.plans import sync

COLUMNS = ["a", "b"]
FEED = "case_id int, seq bigint, operation string, k int, a int, b string, present array<string>"
TARGET = "case_id int, k int, a int, b string, extra string"
N_CASES = 150


def one_by_one(target, feed):
    """What a writer does that executes a statement per record."""
    table = [list(row) for row in target]
    for _, _, operation, k, a, b, present in sorted(feed, key=lambda r: r[1]):
        sent = {"a": a, "b": b}
        sent = {c: v for c, v in sent.items() if present is None or c in present}
        matches = [row for row in table if k is not None and row[1] == k]
        if operation == "delete":
            table = [row for row in table if not (k is not None and row[1] == k)]
        elif matches:
            for row in matches:
                for c, v in sent.items():
                    row[2 if c == "a" else 3] = v
        else:
            case = feed[0][0]
            table.append([case, k, sent.get("a"), sent.get("b"), None])
    return [tuple(row) for row in table]


def make_cases(seed, partial=True, target_repeats=True):
    rng = random.Random(seed)
    targets, feeds = {}, {}
    for case in range(N_CASES):
        keys = list(range(rng.randint(1, 4)))
        target = []
        for k in [*keys, None]:
            copies = rng.choice([0, 1, 1, 2] if target_repeats and k is not None else [0, 1])
            target += [
                (case, k, rng.choice([None, 1, 2]), rng.choice([None, "x"]), f"e{i}") for i in range(copies)
            ]
        feed = []
        for seq in rng.sample(range(100), rng.randint(1, 10)):
            present = rng.choice([None, [], ["a"], ["b"], ["a", "b"]]) if partial else None
            feed.append(
                (case, seq, rng.choice(["delete", "create", "update", "snapshot"]),
                 rng.choice([*keys, *keys, None]), rng.choice([None, 10, 20]),
                 rng.choice([None, "p", "q"]), present)
            )
        targets[case], feeds[case] = target, feed
    return targets, feeds


def flat(by_case):
    return [row for rows in by_case.values() for row in rows]


@pytest.mark.parametrize("partial", [True, False])
@pytest.mark.parametrize("broadcast", [True, False])
def test_same_as_one_by_one(spark, rows, partial, broadcast):
    targets, feeds = make_cases(1, partial)
    expected = flat({c: one_by_one(targets[c], feeds[c]) for c in targets})
    target = spark.createDataFrame(flat(targets), TARGET)
    feed = spark.createDataFrame(flat(feeds), FEED).orderBy(F.rand(3))
    result = apply_ops.apply_changes(
        target, feed, ["case_id", "k"], COLUMNS, present="present" if partial else None,
        broadcast_summary=broadcast,
    )
    assert result.columns == target.columns
    assert rows(result) == rows(spark.createDataFrame(expected, TARGET))


def test_measured_apply_takes_either_join(spark, rows):
    targets, feeds = make_cases(2, target_repeats=False)
    target = spark.createDataFrame(flat(targets), TARGET).where("case_id = 0").drop("case_id")
    feed = spark.createDataFrame(flat(feeds), FEED).where("case_id = 0").drop("case_id")
    expected = [r[1:] for r in one_by_one(targets[0], feeds[0])]
    for limit in (0, 1 << 20):
        result = sync.apply_measured(target, feed, "k", COLUMNS, "present", broadcast_bytes=limit)
        assert rows(result) == rows(spark.createDataFrame(expected, TARGET.split(", ", 1)[1]))


def states_key(df):
    """One key column that stands for case and key, NULL where the key is."""
    return df.withColumn("ck", F.col("case_id") * 1000 + F.col("k"))


def test_state_takes_any_split_order_and_repeat(spark, rows):
    targets, feeds = make_cases(3)
    expected = flat({c: one_by_one(targets[c], feeds[c]) for c in targets})
    target = states_key(spark.createDataFrame(flat(targets), TARGET))
    feed = states_key(spark.createDataFrame(flat(feeds), FEED)).withColumn(
        # seq must be unique over the whole feed, as it is in a tracking table
        "seq", F.col("seq") * 1000 + F.col("case_id")
    ).withColumn("part", F.pmod(F.hash("seq"), F.lit(4)))
    columns = ["case_id", *COLUMNS]
    feed = feed.withColumn(
        "present",
        F.when(F.col("present").isNotNull(), F.array_append("present", F.lit("case_id"))),
    )
    parts = [
        state_ops.to_state(feed.where(F.col("part") == p), "ck", columns, "present")
        for p in (3, 1, 0, 2, 1, 3)
    ]
    merged = state_ops.merge_states(
        [state_ops.merge_states(parts[:3], "ck", columns), *parts[3:]], "ck", columns
    )
    result = state_ops.apply_state(target, merged, "ck", columns).select("case_id", "ck", "a", "b", "extra")
    wanted = states_key(spark.createDataFrame(expected, TARGET)).select("case_id", "ck", "a", "b", "extra")
    assert rows(result) == rows(wanted)


def test_new_rows_take_defaults(spark, rows):
    target = spark.createDataFrame([(1, 1, "old")], "k int, a int, status string")
    feed = spark.createDataFrame([(1, "create", 2, 5), (2, "update", 1, 6)], "seq int, operation string, k int, a int")
    result = apply_ops.apply_changes(target, feed, "k", ["a"], defaults={"status": F.lit("new")})
    assert rows(result) == [(1, 6, "old"), (2, 5, "new")]


def test_delete_of_an_absent_key_changes_nothing(spark, rows):
    target = spark.createDataFrame([(1, "x"), (None, "y")], "k int, v string")
    deletes = spark.createDataFrame([(1,), (7,), (None,)], "k int")
    assert rows(apply_ops.delete_keys(target, deletes, "k"), "k", "v") == [(None, "y")]


def test_columns_must_exist(spark):
    target = spark.createDataFrame([(1, "x")], "k int, v string")
    feed = spark.createDataFrame([(1, "create", 1, "x")], "seq int, operation string, k int, w string")
    with pytest.raises(ValueError, match="v"):
        apply_ops.apply_changes(target, feed, "k")
