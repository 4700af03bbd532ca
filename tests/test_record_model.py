"""JSON records against a plain model of a writer that executes them one by one."""

from __future__ import annotations

import json
import random

import pytest

from changeloom.names import REASON
from changeloom.operators import records as ops
from changeloom.plans import sync
from tests.test_records import RECORDS

COLUMNS = ["ID", "NAME", "AGE"]


class Refused(Exception):
    pass


def parse(text, reason):
    if text is None or text == "":
        return None
    try:
        value = json.loads(text)
    except ValueError:
        raise Refused(reason) from None
    if value is None:
        return {}
    if not isinstance(value, dict):
        raise Refused(reason)
    return {name.upper(): v for name, v in value.items()}


def key_column(key):
    if key and len(key) > 1:
        raise Refused(ops.COMPOSITE_KEY)
    return next(iter(key)) if key else "ID"


def write(table, operation, key_text, payload_text):
    """Executes one record, or refuses it."""
    if operation == "delete":
        key = parse(key_text, ops.BAD_KEY)
        column = key_column(key)
        if not key or column not in key:
            raise Refused(ops.EMPTY_KEY)
        if column not in COLUMNS:
            raise Refused(ops.UNKNOWN_COLUMN)
        if key[column] is not None:
            table[:] = [row for row in table if row[column] != key[column]]
        return
    payload = parse(payload_text, ops.BAD_PAYLOAD)
    if payload is None:
        raise Refused(ops.EMPTY_PAYLOAD)
    try:
        key = parse(key_text, None)
    except Refused:
        key = None
    column = key_column(key)
    if column not in payload and key and column in key:
        payload[column] = key[column]
    if not payload:
        raise Refused(ops.NO_COLUMN)
    if set(payload) - set(COLUMNS) or column not in COLUMNS:
        raise Refused(ops.UNKNOWN_COLUMN)
    value = payload.get(column)
    matches = [row for row in table if value is not None and row[column] == value]
    if matches:
        for row in matches:
            row.update({c: v for c, v in payload.items() if c != column})
    else:
        table.append(dict.fromkeys(COLUMNS) | payload)


def some_case(rng, name):
    return rng.choice([name.upper(), name.lower(), name.capitalize()])


def random_record(rng, key_columns):
    ids = [None, *range(8)]
    names = [None, "a", "b", "c"]
    values = {"ID": ids, "NAME": names, "AGE": [None, 1, 2]}
    column = rng.choice(key_columns)
    key = rng.choice(
        [json.dumps({some_case(rng, column): rng.choice(values[column][1:])})] * 8
        + [json.dumps({column: None}), json.dumps({"id": 1, "b": 2}), json.dumps({"code": 1}), "{}", "null", "", None]
        + ["no json", "[1]", '{"id":1} x']
    )
    sent = rng.sample(COLUMNS, rng.randint(0, 3))
    payload = {some_case(rng, c): rng.choice(values[c]) for c in sent}
    if rng.random() < 0.05:
        payload["extra"] = 1
    text = rng.choice([json.dumps(payload)] * 9 + [None, "", "null", "{}", "[]", "{1}"])
    return rng.choice(["create", "update", "snapshot", "delete"]), key, text


@pytest.mark.parametrize(
    ("seed", "n_records", "key_columns"), [(1, 400, ["ID"]), (2, 400, ["ID"]), (3, 14, ["ID", "ID", "NAME"])]
)
def test_same_table_and_same_refusals(spark, rows, seed, n_records, key_columns):
    rng = random.Random(seed)
    start = [{"ID": i, "NAME": "x", "AGE": i} for i in range(4)] + [{"ID": None, "NAME": "y", "AGE": 0}]
    records = [(seq, *random_record(rng, key_columns)) for seq in range(n_records)]
    table, refused = [dict(row) for row in start], []
    for seq, operation, key, payload in records:
        try:
            write(table, operation, key, payload)
        except Refused as refusal:
            refused.append((seq, str(refusal)))

    as_rows = [tuple(row[c] for c in COLUMNS) for row in start]
    target = spark.createDataFrame(as_rows, "ID int, NAME string, AGE int")
    shuffled = [(s, o, {}, k, p) for s, o, k, p in records]
    rng.shuffle(shuffled)
    after, rejects = sync.apply_records(target, spark.createDataFrame(shuffled, RECORDS), "users", "id")
    assert rows(rejects, "seq", REASON) == sorted(refused)
    expected = spark.createDataFrame([tuple(row[c] for c in COLUMNS) for row in table], target.schema)
    assert rows(after) == rows(expected)
