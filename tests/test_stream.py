from __future__ import annotations

from pathlib import Path

import pytest

from changeloom.names import REASON, TRACKING_ID
from changeloom.operators.apply import apply_changes
from changeloom.operators.records import EMPTY_KEY, OTHER_KEY, UNKNOWN_TABLE
from changeloom.sources import scratch
from changeloom.sources.versions import VersionedTable
from changeloom.streaming.sink import ChangeSink, RecordSink
from changeloom.streaming.tail import land, land_new, start, tail

FEED = f"{TRACKING_ID} bigint, seq bigint, operation string, k int, v string, present array<string>"


def changes(spark, *rows):
    return spark.createDataFrame([(seq, seq, *rest) for seq, *rest in rows], FEED)


@pytest.fixture
def target(spark):
    return spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")


def collect(spark, path, out, checkpoint, schema, **options):
    stream = tail(spark, path, schema, **options).select("seq")
    start(stream.writeStream.format("parquet").option("path", out), checkpoint).awaitTermination()


def test_a_restart_reads_only_what_is_new(spark, tmp_path, rows):
    landing, out, checkpoint = (str(tmp_path / n) for n in ("landing", "out", "checkpoint"))
    first = changes(spark, *[(i, "create", i, "x", None) for i in range(10)])
    second = changes(spark, *[(i, "create", i, "x", None) for i in range(10, 15)])
    land(first, landing, files=5)
    collect(spark, landing, out, checkpoint, first.schema, max_files=2)
    collect(spark, landing, out, checkpoint, first.schema, max_files=2)
    assert rows(spark.read.parquet(out)) == [(i,) for i in range(10)]
    land(second, landing, files=2)
    collect(spark, landing, out, checkpoint, first.schema, max_files=2)
    assert rows(spark.read.parquet(out)) == [(i,) for i in range(15)]


def test_files_per_batch_do_not_change_the_result(spark, tmp_path, target, rows):
    feed = changes(spark, *[
        (i, "delete" if i % 5 == 0 else "update", i % 4, f"v{i}", None if i % 3 else []) for i in range(40)
    ])
    land(feed, str(tmp_path / "landing"), files=8)
    wanted = rows(apply_changes(target, feed, "k", ["v"], "present"))
    for files in (1, 3, 100):
        sink = ChangeSink(spark, str(tmp_path / f"changes{files}"), "k", ["v"], "present", merge_every=2)
        stream = tail(spark, str(tmp_path / "landing"), feed.schema, max_files=files)
        start(sink.writer(stream), str(tmp_path / f"checkpoint{files}")).awaitTermination()
        assert rows(sink.current(target)) == wanted


def test_landing_what_is_new(spark, tmp_path, rows):
    landing = str(tmp_path / "landing")
    feed = changes(spark, *[(i, "create", i, "x", None) for i in (1, 2, 3, 6, 7)])
    land_new(feed.where("seq <= 3"), landing)
    land_new(feed, landing)
    land_new(feed, landing)
    assert rows(spark.read.parquet(landing), "seq") == [(1,), (2,), (3,), (6,), (7,)]
    # Ids 4 and 5 are committed late.
    late = feed.unionByName(changes(spark, (4, "create", 4, "x", None), (5, "create", 5, "x", None)))
    land_new(late, landing)
    land_new(late, landing)
    assert rows(spark.read.parquet(landing), "seq") == [(i,) for i in range(1, 8)]
    # Files that were purged do not land again.
    for file in Path(landing).glob("*.parquet"):
        file.unlink()
    land_new(late.unionByName(changes(spark, (9, "create", 9, "x", None))), landing)
    assert rows(spark.read.parquet(landing), "seq") == [(9,)]


def test_first_start_from_a_position(spark, tmp_path, rows):
    landing, out, checkpoint = (str(tmp_path / n) for n in ("landing", "out", "checkpoint"))
    feed = changes(spark, *[(i, "create", i, "x", None) for i in range(6)])
    land(feed, landing, files=2)
    collect(spark, landing, out, checkpoint, feed.schema, after=3)
    assert rows(spark.read.parquet(out)) == [(4,), (5,)]


def test_polling_sees_files_that_land_later(spark, tmp_path, target, rows):
    feed = changes(spark, (1, "update", 1, "new", None))
    later = changes(spark, (2, "create", 9, "late", None))
    land(feed, str(tmp_path / "landing"), files=1)
    sink = ChangeSink(spark, str(tmp_path / "changes"), "k", ["v"])
    stream = tail(spark, str(tmp_path / "landing"), feed.schema)
    query = start(sink.writer(stream), str(tmp_path / "checkpoint"), interval="200 milliseconds")
    try:
        query.processAllAvailable()
        assert rows(sink.current(target)) == [(1, "new"), (2, "b")]
        land(later, str(tmp_path / "landing"), files=1)
        query.processAllAvailable()
        assert rows(sink.current(target)) == [(1, "new"), (2, "b"), (9, "late")]
    finally:
        query.stop()


def test_committed_files_are_purged(spark, tmp_path, rows):
    landing, out, checkpoint = (str(tmp_path / n) for n in ("landing", "out", "checkpoint"))
    feed = changes(spark, *[(i, "create", i, "x", None) for i in range(6)])
    land(feed, landing, files=3)
    before = len(list(Path(landing).glob("*.parquet")))
    collect(spark, landing, out, checkpoint, feed.schema, max_files=1, purge="delete")
    land(changes(spark, (6, "create", 6, "x", None)), landing, files=1)
    collect(spark, landing, out, checkpoint, feed.schema, max_files=1, purge="delete")
    left = len(list(Path(landing).glob("*.parquet")))
    # The files of the last batch stay until another one is planned.
    assert before == 3 and left < 3
    assert rows(spark.read.parquet(out)) == [(i,) for i in range(7)]


def test_sink_takes_late_and_repeated_changes(spark, tmp_path, target, rows):
    sink = ChangeSink(spark, str(tmp_path / "changes"), "k", ["v"], "present", merge_every=2)
    assert rows(sink.current(target)) == rows(target)
    newer = changes(
        spark, (10, "update", 1, "ten", None), (11, "delete", 2, None, None), (12, "create", None, "n", None)
    )
    older = changes(spark, (5, "delete", 1, None, None), (6, "update", 2, "six", ["v"]), (7, "update", 3, None, []))
    for batch in (newer, older, newer, older, newer):
        sink.write_batch(batch)
    assert len(sink.changes.live_entries()) == 2
    expected = [(None, "n"), (1, "ten"), (3, None)]
    assert rows(sink.current(target)) == expected
    # Another process goes on with the same folder.
    again = ChangeSink(spark, str(tmp_path / "changes"), "k", ["v"], "present")
    again.write_batch(changes(spark, (20, "create", 2, "back", None)))
    assert rows(again.current(target)) == [(None, "n"), (1, "ten"), (2, "back"), (3, None)]


def test_writes_are_merged_by_level(spark, tmp_path, target, rows):
    sink = ChangeSink(spark, str(tmp_path / "changes"), "k", ["v"], merge_every=3)
    shapes = []
    for i in range(14):
        # Another writer object, as after a restart.
        sink = ChangeSink(spark, str(tmp_path / "changes"), "k", ["v"], merge_every=3)
        sink.write_batch(changes(spark, (i, "update", i % 4, f"v{i}", None)))
        shapes.append([entry.level for entry in sink.changes.live_entries()])
    assert shapes[:5] == [[0], [0, 0], [1], [1, 0], [1, 0, 0]]
    assert shapes[7:9] == [[1, 1, 0, 0], [2]]
    assert shapes[-1] == [2, 1, 0, 0]
    expected = [(0, "v12"), (1, "v13"), (2, "v10"), (3, "v11")]
    assert rows(sink.current(target)) == expected
    sink.compact()
    assert len(sink.changes.live_entries()) == 1
    assert rows(sink.current(target)) == expected
    sink.write_batch(changes(spark, (3, "update", 5, "late", None), (2, "delete", 1, None, None)))
    assert rows(sink.current(target)) == [*expected, (5, "late")]


def test_fold_into_a_new_version(spark, tmp_path, target, rows):
    table = VersionedTable(spark, str(tmp_path / "table"))
    table.replace(target)
    sink = ChangeSink(spark, str(tmp_path / "changes"), "k", ["v"])
    sink.write_batch(changes(spark, (1, "delete", 1, None, None), (2, "create", 3, "c", None)))
    sink.fold_into(table)
    assert rows(table.read()) == [(2, "b"), (3, "c")]
    assert rows(sink.current(table.read())) == [(2, "b"), (3, "c")]
    sink.write_batch(changes(spark, (3, "update", 2, "bb", None)))
    assert rows(sink.current(table.read())) == [(2, "bb"), (3, "c")]


def test_record_sink_sets_bad_records_aside(spark, tmp_path, target, rows):
    schema = "seq bigint, operation string, metadata map<string,string>, key_json string, after_json string"
    records = spark.createDataFrame(
        [
            (1, "update", {}, '{"K":1}', '{"v":"new"}'),
            (2, "delete", {}, "{}", None),
            (3, "update", {}, '{"V":"new"}', '{"k":5}'),
            (4, "create", {"oracle.table": "other"}, None, '{"k":6}'),
            (5, "create", {}, None, '{"k":7,"v":"seven"}'),
        ],
        schema,
    )
    sink = RecordSink(spark, str(tmp_path / "sink"), target.schema, "users", "k")
    for _ in range(2):
        sink.write_batch(records, 3)
    assert rows(sink.current(target)) == [(1, "new"), (2, "b"), (7, "seven")]
    rejects = spark.read.parquet(sink.rejects)
    assert rows(rejects, "seq", REASON) == [(2, EMPTY_KEY), (3, OTHER_KEY), (4, UNKNOWN_TABLE)]


class _Conf(dict):
    pass


class _Session:
    def __init__(self, **conf):
        self.conf = _Conf(conf)


def test_scratch_folder_comes_from_the_session(spark):
    shared = spark.conf.get(scratch.CHECKPOINT_DIR)
    assert scratch.new_folder(spark, "x").startswith(shared)
    assert scratch.new_folder(spark, "x") != scratch.new_folder(spark, "x")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch.shared_root(_Session(**{"spark.master": "yarn"}))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch.shared_root(_Session(**{"spark.master": "local[2]"}))
    assert scratch.shared_root(_Session(**{scratch.SHARED_DIR: "/shared/"})) == "/shared"


def test_keyless_rows_of_one_snapshot_all_stay(spark, tmp_path, target, rows):
    sink = ChangeSink(spark, str(tmp_path / "changes"), "k", ["v"])
    snapshot = changes(spark, *[(-1, "snapshot", None, v, None) for v in ("a", "b", "b")])
    for _ in range(2):
        sink.write_batch(snapshot)
    assert rows(sink.current(target.limit(0))) == [(None, "a"), (None, "b"), (None, "b")]


def test_rejects_of_another_reader_stay(spark, tmp_path):
    schema = "seq bigint, operation string, metadata map<string,string>, key_json string, after_json string"
    sink = RecordSink(spark, str(tmp_path / "sink"), spark.createDataFrame([], "k int, v string").schema, "T", "k")
    bad = spark.createDataFrame([(1, "create", {}, None, None)], schema)
    bad.write.parquet(str(tmp_path / "landing"))
    for reader in ("one", "two"):
        stream = tail(spark, str(tmp_path / "landing"), bad.schema)
        start(sink.writer(stream), str(tmp_path / reader)).awaitTermination()
    assert spark.read.parquet(sink.rejects).count() == 2


def test_a_part_of_the_landed_files_has_one_for_every_core(spark, tmp_path):
    from workload.stream_queries import _batch_files

    land(changes(spark, *[(i, "create", i, "x", None) for i in range(200)]), str(tmp_path / "landing"))
    assert _batch_files(spark) == spark.sparkContext.defaultParallelism
    assert len(list((tmp_path / "landing").glob("*.parquet"))) >= 2 * _batch_files(spark)


def test_more_files_of_one_size_make_larger_batches_not_more(spark, tmp_path):
    from workload.stream_queries import _share_of_files

    feed = changes(spark, *[(i, "create", i, "x", None) for i in range(120)])
    for rows in (3, 24, 120):
        feed.limit(rows).coalesce(1).write.option("maxRecordsPerFile", 1).parquet(str(tmp_path / f"{rows}"))
    assert [_share_of_files(spark, str(tmp_path / f"{rows}"), feed.schema) for rows in (3, 24, 120)] == [2, 2, 10]
