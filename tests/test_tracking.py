"""The stream source over a landed tracking table: batches by rows, restarts, purges."""

from __future__ import annotations

import random

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changeloom.names import TRACKING_ID
from changeloom.sources import tracking
from changeloom.sources.tracking import TrackingReader
from changeloom.streaming.tail import start, tail_rows

SCHEMA = T.StructType().add("K", "string").add(TRACKING_ID, "long")


def write(path, name, ids, **options):
    path.mkdir(exist_ok=True)
    pq.write_table(pa.table({TRACKING_ID: pa.array(ids, pa.int64()), "K": [f"k{i}" for i in ids], "more": ids}), path / name, **options)


def reader(path, **options):
    return TrackingReader(SCHEMA, {"path": str(path), **{k: str(v) for k, v in options.items()}})


def ids_of(source, first, last):
    parts = source.partitions(first, last)
    return sorted(i for part in parts for batch in source.read(part) for i in batch.column(TRACKING_ID).to_pylist())


@pytest.mark.parametrize("size", [1, 3, 7, 100])
def test_batches_are_pages_however_the_ids_lie(tmp_path, size):
    draw = random.Random(size)
    ids = draw.sample(range(500), 40)
    for n in range(4):
        write(tmp_path / "t", f"{n}.parquet", ids[n::4], row_group_size=draw.choice([1, 4, 100]), write_statistics=n != 2)
    (tmp_path / "t" / "_SUCCESS").touch()
    source, at, found = reader(tmp_path / "t", rowsPerBatch=size), None, []
    at = source.initialOffset()
    while (end := source.latestOffset()) != at:
        found.append(ids_of(source, at, end))
        at = end
    assert found == [sorted(ids)[i : i + size] for i in range(0, 40, size)]


def test_a_new_reader_goes_on_where_the_last_planned_batch_ended(tmp_path):
    write(tmp_path / "t", "a.parquet", range(10))
    first = reader(tmp_path / "t", rowsPerBatch=4)
    at, end = first.initialOffset(), first.latestOffset()
    assert (at, end) == ({"id": -1}, {"id": 3})
    # Planned and not committed: the engine plans it once more, and asks for the next end then.
    again = reader(tmp_path / "t", rowsPerBatch=4)
    assert ids_of(again, at, end) == [0, 1, 2, 3] and again.latestOffset() == {"id": 7}
    third = reader(tmp_path / "t", rowsPerBatch=4)
    assert third.latestOffset() == {"id": 7}
    # A query without a checkpoint begins at the beginning, or after a position of its own.
    assert third.initialOffset() == {"id": -1} and third.latestOffset() == {"id": 3}
    late = reader(tmp_path / "t", rowsPerBatch=4, after=8)
    assert late.initialOffset() == {"id": 8} and late.latestOffset() == {"id": 9}


def test_commit_removes_files_that_hold_nothing_else(tmp_path):
    write(tmp_path / "t", "a.parquet", [1, 2, 3])
    write(tmp_path / "t", "b.parquet", [3, 4, 9], row_group_size=1)
    write(tmp_path / "t", "c.parquet", [5, 6])
    left = lambda: sorted(f.name for f in (tmp_path / "t").iterdir())
    reader(tmp_path / "t").commit({"id": 9})
    assert left() == ["a.parquet", "b.parquet", "c.parquet"]
    source = reader(tmp_path / "t", purge="true")
    source.commit({"id": 4})
    assert left() == ["b.parquet", "c.parquet"]
    source.commit({"id": 8})
    assert left() == ["b.parquet"]
    source.commit({"id": 9})
    assert left() == [] and source.latestOffset() == {"id": -1}


def test_no_folder_no_rows_and_nulls(tmp_path):
    source = reader(tmp_path / "none")
    assert source.latestOffset() == source.initialOffset() == {"id": -1}
    write(tmp_path / "t", "a.parquet", [])
    pq.write_table(pa.table({TRACKING_ID: pa.array([None, 4, None], pa.int64()), "K": ["x", "y", "z"]}), tmp_path / "t" / "b.parquet")
    source = reader(tmp_path / "t")
    assert source.latestOffset() == {"id": 4} and ids_of(source, {"id": -1}, {"id": 4}) == [4]
    with pytest.raises(ValueError):
        reader(tmp_path / "t", rowsPerBatch=0)


def test_a_batch_whose_commit_was_lost_is_read_again(spark, tmp_path):
    """The sink fails after its second batch: the restart begins with that batch, whole."""
    write(tmp_path / "t", "a.parquet", range(0, 12, 2))
    write(tmp_path / "t", "b.parquet", range(1, 13, 2))
    seen = []

    def sink(batch, number):
        seen.append((number, sorted(r[0] for r in batch.select(TRACKING_ID).collect())))
        if len(seen) == 2:
            raise RuntimeError("lost")

    stream = tail_rows(spark, str(tmp_path / "t"), SCHEMA, 5, purge=True).select(F.col(TRACKING_ID)).writeStream.foreachBatch(sink)
    with pytest.raises(Exception, match="lost"):
        start(stream, str(tmp_path / "checkpoint"), "0 seconds").processAllAvailable()
    query = start(stream, str(tmp_path / "checkpoint"), "0 seconds")
    query.processAllAvailable()
    query.stop()
    second = (1, [5, 6, 7, 8, 9])
    assert seen == [(0, [0, 1, 2, 3, 4]), second, second, (2, [10, 11])]


def test_ids_are_read_only_where_a_batch_ends(tmp_path, monkeypatch):
    for n in range(10):
        write(tmp_path / "t", f"{n}.parquet", range(100 * n, 100 * n + 100))
    read = []
    ids = tracking._ids
    monkeypatch.setattr(tracking, "_ids", lambda store, group: read.append(group.low) or ids(store, group))
    source = reader(tmp_path / "t", rowsPerBatch=450)
    at, ends = source.initialOffset(), []
    while (end := source.latestOffset()) != at:
        source.partitions(at, end)
        ends.append(end["id"])
        at = end
    assert ends == [449, 899, 999] and read == [400, 400]
