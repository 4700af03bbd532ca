"""A landed tracking table as a stream whose positions are tracking ids.

Next to a stream over files, whose micro-batches are bounded by files and whose position is a list of them, this
source counts rows: a batch holds the next ``rowsPerBatch`` changes by tracking id, however they lie in files,
so batches are the pages of ``operators.paging``. Once a batch is committed, files with nothing but
committed changes can go (``purge``).

::

    spark.dataSource.register(TrackingSource)
    spark.readStream.format("tracking").schema(feed.schema).option("path", landing).option("rowsPerBatch", 1000).load()

The driver looks at the minima and maxima that parquet keeps per row group, and at ids of the groups that a batch ends in.
Each task reads the row groups of its part. Like a page reader, it follows the strict rule that ids at or below the
position are done: what is committed late with a lower id needs ``streaming.tail``.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from changeloom.names import DEFAULT_BATCH_SIZE, TRACKING_ID

# Changes that a task reads, about.
ROWS_PER_TASK = 50_000


class RowGroup(NamedTuple):
    """A part of a file, how many ids are in it, and their bounds."""

    file: str
    number: int
    rows: int
    low: int
    high: int


class Part(InputPartition):
    def __init__(self, groups: list[RowGroup], start: int, end: int):
        self.groups, self.start, self.end = groups, start, end


def _opened(path: str) -> tuple[fs.FileSystem, str]:
    if "://" in path or path.startswith("file:"):
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


def _ids(store: fs.FileSystem, group: RowGroup) -> np.ndarray:
    with store.open_input_file(group.file) as file:
        column = pq.ParquetFile(file).read_row_group(group.number, columns=[TRACKING_ID]).column(0)
    return np.asarray(pc.drop_null(column), np.int64)


class TrackingReader(DataSourceStreamReader):
    def __init__(self, schema: StructType, options: dict[str, str]):
        self.schema = schema
        self.path = options["path"].rstrip("/")
        self.rows = int(options.get("rowsPerBatch", DEFAULT_BATCH_SIZE))
        if self.rows < 1:
            raise ValueError("rowsPerBatch must be at least 1")
        self.after = int(options.get("after", -1))
        self.purge = options.get("purge", "false").lower() == "true"
        # Where the last planned batch ended. Spark names a restarted source no start before it asks for an end.
        self.position_file = options.get("positionFile") or f"{self.path}.position"
        self.known: dict[str, list[RowGroup]] = {}

    def _groups(self) -> list[RowGroup]:
        """All row groups with their bounds, by lowest id. Files never change, so each is opened once."""
        store, root = _opened(self.path)
        found = {}
        for entry in store.get_file_info(fs.FileSelector(root, recursive=True, allow_not_found=True)):
            name = entry.base_name
            if entry.type != fs.FileType.File or name[0] in "._" or not name.endswith(".parquet"):
                continue
            found[entry.path] = self.known.get(entry.path) or self._bounds(store, entry.path)
        self.known = found
        return sorted((g for groups in found.values() for g in groups), key=lambda g: (g.low, g.file, g.number))

    def _bounds(self, store: fs.FileSystem, path: str) -> list[RowGroup]:
        groups = []
        with store.open_input_file(path) as file:
            metadata = pq.ParquetFile(file).metadata
            place = metadata.schema.names.index(TRACKING_ID)
            for number in range(metadata.num_row_groups):
                group = metadata.row_group(number)
                bounds = group.column(place).statistics
                if bounds is not None and bounds.has_min_max and bounds.has_null_count:
                    groups.append(RowGroup(path, number, group.num_rows - bounds.null_count, bounds.min, bounds.max))
                elif group.num_rows:
                    ids = _ids(store, RowGroup(path, number, 0, 0, 0))
                    if len(ids):
                        groups.append(RowGroup(path, number, len(ids), int(ids.min()), int(ids.max())))
        return groups

    def _planned(self) -> int | None:
        store, path = _opened(self.position_file)
        if store.get_file_info(path).type != fs.FileType.File:
            return None
        with store.open_input_stream(path) as file:
            return json.loads(file.read())["last_processed_val"]

    def _plan(self, position: int) -> None:
        store, path = _opened(self.position_file)
        with store.open_output_stream(path) as file:
            file.write(json.dumps({"mode": "cdc", "last_processed_val": position}).encode())

    def initialOffset(self) -> dict:
        # Asked for by a query without a checkpoint alone: what an earlier one planned does not count.
        self._plan(self.after)
        return {"id": self.after}

    def latestOffset(self) -> dict:
        """The id of the last of the next ``rowsPerBatch`` changes."""
        position = self._planned()
        position = self.after if position is None else position
        groups = [g for g in self._groups() if g.high > position]
        last, left, begin = position, self.rows, 0
        while left and begin < len(groups):
            # Groups whose ids lie among each other's are looked at together.
            high, end = groups[begin].high, begin + 1
            while end < len(groups) and groups[end].low <= high:
                high, end = max(high, groups[end].high), end + 1
            together, rows = groups[begin:end], sum(g.rows for g in groups[begin:end])
            if together[0].low > position and rows <= left:
                # All of them are in the batch, whatever their ids.
                last, left = high, left - rows
            else:
                ids = self._first_ids(together, position, left)
                last, left = int(ids[-1]) if len(ids) else last, left - len(ids)
            begin = end
        return {"id": last}

    def _first_ids(self, groups: list[RowGroup], position: int, rows: int) -> np.ndarray:
        """The least ids after a position, in order."""
        store, _ = _opened(self.path)
        ids = np.zeros(0, np.int64)
        for group in groups:
            if len(ids) >= rows and group.low > ids[rows - 1]:
                break
            more = _ids(store, group)
            ids = np.sort(np.r_[ids, more[more > position]])[:rows]
        return ids

    def partitions(self, start: dict, end: dict) -> list[Part]:
        self._plan(end["id"])
        groups = [g for g in self._groups() if g.high > start["id"] and g.low <= end["id"]]
        parts: list[list[RowGroup]] = []
        rows = ROWS_PER_TASK
        for group in groups:
            if rows >= ROWS_PER_TASK:
                parts.append([])
                rows = 0
            parts[-1].append(group)
            rows += group.rows
        return [Part(part, start["id"], end["id"]) for part in parts]

    def read(self, partition: Part) -> Iterator[pa.RecordBatch]:
        schema = to_arrow_schema(self.schema)
        for group in partition.groups:
            store, _ = _opened(self.path)
            with store.open_input_file(group.file) as file:
                table = pq.ParquetFile(file).read_row_group(group.number, columns=self.schema.names)
            ids = table.column(TRACKING_ID)
            table = table.filter(pc.and_(pc.greater(ids, partition.start), pc.less_equal(ids, partition.end)))
            yield from table.select(schema.names).cast(schema).to_batches()

    def commit(self, end: dict) -> None:
        """All up to ``end`` was processed: files that hold nothing else may go."""
        if not self.purge:
            return
        store, _ = _opened(self.path)
        self._groups()
        for path, groups in list(self.known.items()):
            if groups and max(g.high for g in groups) <= end["id"]:
                store.delete_file(path)
                del self.known[path]


class TrackingSource(DataSource):
    """Options: ``path``, ``rowsPerBatch`` (1000), ``after`` (position of a first start), ``purge`` (false), ``positionFile``."""

    @classmethod
    def name(cls) -> str:
        return "tracking"

    def schema(self) -> StructType:
        raise ValueError("give the tracking table's schema to the reader")

    def streamReader(self, schema: StructType) -> TrackingReader:
        return TrackingReader(schema, self.options)
