"""Records keyed by any column against records applied one by one."""

from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F

from changeloom.operators import otherkeys
from changeloom.plans import sync

RECORDS = "seq bigint, operation string, metadata map<string,string>, key_json string, after_json string"
TARGET = "id bigint, mail string, n int, note string"
NAMES = ["id", "mail", "n", "note"]


def one_by_one(rows, records):
    rows = [dict(r) for r in rows]
    for _, operation, _, key_json, after_json in sorted(records, key=lambda r: r[0]):
        key = json.loads(key_json) if key_json else {}
        after = json.loads(after_json) if after_json else {}
        column = next(iter(key), "id")
        value = after.get(column, key.get(column)) if operation != "delete" else key[column]
        hit = [r for r in rows if value is not None and r[column] == value]
        if operation == "delete":
            rows = [r for r in rows if r not in hit] if hit else rows
        elif hit:
            for row in hit:
                # The key that a record is matched by, and the target's own, are not written.
                row.update({c: v for c, v in after.items() if c != column})
        else:
            rows.append({c: after.get(c, value if c == column else None) for c in NAMES})
    return sorted((tuple(r[c] for c in NAMES) for r in rows), key=str)


def applied(spark, rows, records):
    target = spark.createDataFrame([tuple(r[c] for c in NAMES) for r in rows], TARGET)
    after, rejects = sync.apply_records(target, spark.createDataFrame(records, RECORDS), "users", "id")
    assert rejects.count() == 0
    return sorted((tuple(r) for r in after.collect()), key=str)


def random_case(seed, renames):
    draw = random.Random(seed)
    mails = [f"m{i}" for i in range(6)]
    rows = [dict(id=i, mail=draw.choice([*mails, None]), n=i, note="old") for i in range(5)]
    records = []
    for seq in range(draw.randint(4, 9)):
        column = draw.choice(["id", "id", "mail", "mail", "n"] if renames else ["id", "mail", "mail"])
        value = {"id": draw.randint(0, 7), "mail": draw.choice(mails), "n": draw.randint(0, 6)}[column]
        if draw.random() < 0.2:
            records.append((seq, "delete", {}, json.dumps({column: value}), None))
            continue
        after = {c: {"id": draw.randint(0, 7), "mail": draw.choice(mails), "n": draw.randint(0, 6), "note": f"s{seq}"}[c] for c in NAMES if draw.random() < 0.5}
        if column != "id":
            after.pop("id", None) if draw.random() < 0.7 else None
        else:
            after.pop("id", None)
        after.pop(column, None)
        if not renames:
            after.pop("id", None)
        after = after or {"note": f"s{seq}"}
        records.append((seq, "update", {}, json.dumps({column: value}), json.dumps(after)))
    return rows, records


@pytest.mark.parametrize("seed", range(4))
def test_agrees_with_one_by_one(spark, seed):
    rows, records = random_case(seed, renames=seed % 2 == 1)
    assert applied(spark, rows, records) == one_by_one(rows, records)


def alternating(n):
    """Every other record names its row by mail."""
    rows = [dict(id=i, mail=f"m{i}", n=0, note=None) for i in range(n)]
    records = [
        (s, "update", {}, json.dumps({"id": s % n} if s % 2 else {"mail": f"m{s % n}"}), json.dumps({"n": s} if s % 3 else {"note": f"s{s}"}))
        for s in range(3 * n)
    ]
    return rows, records


def test_turns_of_key_columns_are_one_step(spark, monkeypatch):
    steps = []
    monkeypatch.setattr(otherkeys, "apply_changes", lambda *a, apply=otherkeys.apply_changes, **k: steps.append(1) or apply(*a, **k))
    rows, records = alternating(4)
    assert applied(spark, rows, records) == one_by_one(rows, records) and len(steps) == 1


def test_a_value_finds_the_row_that_holds_it_at_that_time(spark):
    rows = [dict(id=1, mail="a", n=0, note=None), dict(id=2, mail="b", n=0, note=None)]
    change = lambda s, key, after: (s, "update", {}, json.dumps(key), json.dumps(after))
    records = [
        change(1, {"mail": "a"}, {"n": 1}), change(2, {"id": 1}, {"mail": "c"}), change(3, {"id": 2}, {"mail": "a"}),
        change(4, {"mail": "a"}, {"n": 4}), (5, "delete", {}, '{"id":2}', None), change(6, {"mail": "a"}, {"n": 6, "id": 9}),
        change(7, {"mail": "a"}, {"note": "found by id too"}), change(8, {"id": 9}, {"n": 8}), change(9, {"mail": None}, {"note": "no key"}),
        (10, "delete", {}, '{"mail":"nobody"}', None),
    ]
    expected = one_by_one(rows, records)
    assert (9, "a", 8, "found by id too") in expected and (1, "c", 1, None) in expected
    assert applied(spark, rows, records) == expected


def test_rows_without_or_with_a_shared_key_are_met_one_by_one(spark):
    rows = [dict(id=None, mail="a", n=0, note=None), dict(id=3, mail="b", n=0, note=None), dict(id=3, mail="c", n=0, note=None)]
    records = [(s, "update", {}, json.dumps({"mail": m}), json.dumps({"n": s})) for s, m in enumerate(["a", "b", "new", "new", "c"])]
    records += [(7, "delete", {}, '{"mail":"b"}', None), (8, "update", {}, '{"id":3}', '{"note":"x"}')]
    assert applied(spark, rows, records) == one_by_one(rows, records)


def test_one_seq_for_many_snapshot_records(spark):
    rows = [dict(id=i, mail=f"m{i}", n=0, note=None) for i in range(3)]
    records = [(-1, "snapshot", {}, json.dumps({"mail": f"m{i}"} if i else {"id": 0}), json.dumps({"n": i + 5})) for i in range(3)]
    assert applied(spark, rows, records) == [(0, "m0", 5, None), (1, "m1", 6, None), (2, "m2", 7, None)]


def test_no_records(spark):
    rows = [dict(id=1, mail="a", n=0, note=None)]
    target = spark.createDataFrame([(1, "a", 0, None)], TARGET)
    after, _ = sync.apply_records(target, spark.createDataFrame([], RECORDS), "users", "id")
    assert after.collect() == target.collect() and rows


def test_texts_of_values(spark):
    df = spark.createDataFrame([(0.0, bytearray(b"\x01"), 5), (-0.0, bytearray(b"\x02"), None)], "f double, b binary, i int")
    found = df.select(*[otherkeys.key_text(f.name, f.dataType).alias(f.name) for f in df.schema]).collect()
    assert [tuple(r) for r in found] == [("0.0", "01", "5"), ("0.0", "02", None)]
    assert df.select(F.col("i")).count() == 2


def test_records_of_one_partition_are_parsed_by_many_tasks(spark):
    rows = [(i, "create", {}, f'{{"id":{i}}}', f'{{"n":{i}}}') for i in range(200)]
    records = spark.createDataFrame(rows, RECORDS).coalesce(1)
    typed = sync.land_records(records, sync.upper_schema(spark.createDataFrame([], TARGET)), ["users"], "users", "id")
    assert len(typed.inputFiles()) >= spark.sparkContext.defaultParallelism
    assert sorted((r["_seq"], r["ID"], r["N"]) for r in typed.collect()) == [(i, i, i) for i in range(200)]
