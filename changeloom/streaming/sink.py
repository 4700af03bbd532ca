"""Applying a stream of changes to a keyed table.

A micro-batch is reduced to one row per key it touches and that is all it writes: the target, which
may be far larger, is not rewritten per batch. Readers see target and changes merged. The merge
takes late, repeated and reordered changes, so a restart may replay any batch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from changeloom.names import REASON
from changeloom.operators.otherkeys import apply_any_key
from changeloom.operators.records import (
    OTHER_KEY,
    UNKNOWN_TABLE,
    parse_records,
    rejected,
    table_of,
    typed_records,
)
from changeloom.operators.state import KEYLESS_SEQ, apply_state, merge_keyed, merge_states, to_state
from changeloom.sources.bucketed import BucketedTable
from changeloom.sources.versions import VersionedTable

# Level of the empty write that stands for changes folded into the target: nothing is merged with it.
FOLDED = 1 << 20


class ChangeSink:
    """Collects changes under ``root`` for a target with one key column.

    Changes with equal ``seq`` have no order among themselves. Where that can happen, as with two
    snapshots of one row, give ``seq`` a second column, such as the number of the snapshot. Where equal upserts
    without a key may come in several batches, name the columns that tell source rows apart (``row_id``).

    With ``buckets`` all that is written lies in so many buckets of the key. Batches are then merged, and read
    together with a target bucketed alike, without a shuffle. Rows without a key lie beside them, spread.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        key: str,
        columns: list[str],
        present: str | None = None,
        merge_every: int = 10,
        seq: str | list[str] = "seq",
        operation: str = "operation",
        row_id: list[str] | None = None,
        buckets: int | None = None,
    ):
        self.key = key
        self.row_id = row_id
        self.columns = columns
        self.present = present
        self.merge_every = merge_every
        self.seq = seq
        self.operation = operation
        self.changes = BucketedTable(spark, root, key, buckets) if buckets else VersionedTable(spark, root)
        self.keyless = VersionedTable(spark, f"{root.rstrip('/')}-keyless") if buckets else None

    def write_batch(self, batch: DataFrame, batch_id: int = 0) -> None:
        """Add a batch of changes. Adding it once more changes nothing."""
        state = to_state(batch, self.key, self.columns, self.present, self.seq, self.operation, self.row_id)
        if self.keyless is None:
            self.changes.append(state)
        else:
            is_keyed = F.col(KEYLESS_SEQ).isNull()
            self.keyless.append(state.where(~is_keyed))
            self.changes.append(state.where(is_keyed))
        self.merge_recent()

    def writer(self, stream: DataFrame) -> DataStreamWriter:
        return stream.writeStream.foreachBatch(self.write_batch)

    def state(self) -> DataFrame:
        """All changes so far, one row per key."""
        return self._merged(self.changes.read())

    def _merged(self, changes: DataFrame) -> DataFrame:
        if self.keyless is None:
            return merge_states([changes], self.key, self.columns)
        return merge_keyed(changes, self.key, self.columns)

    def merge_recent(self) -> None:
        """Merge the newest writes once there are ``merge_every`` of one level.

        The merged write is of the next level. So a row is written again once per level, and the
        number of levels grows with the logarithm of the number of batches.
        """
        while live := self.changes.own_entries():
            level = live[-1].level
            same = [entry for entry in live if entry.level == level]
            if len(same) < self.merge_every:
                return
            merged = self._merged(self.changes.read_entries(same))
            replace = self.changes.replace if self.keyless is None else self.changes.replace_dealt
            replace(merged, same[0].first, level + 1)

    def compact(self) -> None:
        """Merge all writes into one; late and replayed changes stay welcome."""
        self.changes.replace(self.state(), level=self.changes.own_entries()[0].level)

    def current(self, target: DataFrame, defaults: dict[str, Column] | None = None, unique_target: bool = False) -> DataFrame:
        """The target with all changes so far.

        With ``unique_target`` no two target rows share a key. A target of that kind that is bucketed like the
        changes is read where it lies.
        """
        if not self.changes.live_entries():
            return target
        keyless = self.keyless.read() if self.keyless is not None else None
        return apply_state(
            target, self.changes.read(), self.key, self.columns, defaults, unique_target=unique_target, keyless=keyless
        )

    def fold_into(self, table: VersionedTable) -> None:
        """Write the target with all changes as its new version, and start collecting afresh.

        Only for a position that cannot be replayed and before which nothing can arrive late: the
        order of the folded changes is no longer known afterwards.
        """
        table.replace(self.current(table.read()))
        self.changes.replace(self.changes.read().limit(0), level=FOLDED)
        if self.keyless is not None:
            self.keyless.replace(self.keyless.read().limit(0))


class RecordSink:
    """Collects JSON records for one table under ``root``, and sets bad ones aside.

    Changes are merged by one key column, and records that name another are set aside too. With ``any_key``
    they are taken: which row they mean depends on all records before them, so the typed records
    themselves are kept, and resolved when the table is read. ``fold_into`` bounds how many there are.
    """

    def __init__(
        self, spark: SparkSession, root: str, schema: T.StructType, table: str, key: str, merge_every: int = 10, any_key: bool = False
    ):
        self.log = VersionedTable(spark, f"{root.rstrip('/')}/records") if any_key else None
        self.schema = schema
        self.table = table
        self.key = key.upper()
        self.rejects = f"{root.rstrip('/')}/rejects"
        columns = [name.upper() for name in schema.names if name.upper() != self.key]
        self.sink = ChangeSink(
            spark, f"{root.rstrip('/')}/changes", self.key, columns, "_present", merge_every, "_seq", "_operation"
        )

    def write_batch(self, batch: DataFrame, batch_id: int = 0) -> None:
        parsed = parse_records(batch, self.table, self.key)
        other_key = F.when((F.col("_key_column") != self.key) & F.lit(self.log is None), F.lit(OTHER_KEY))
        typed = typed_records(parsed, self.schema, [self.table])
        # Kept for the two writes below; what an executor loses of it is parsed again.
        typed = typed.withColumn("_reason", F.coalesce("_reason", other_key)).persist()
        try:
            # A batch that is run again replaces what it set aside before; another reader's stays.
            reader = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "none"
            rejected(typed).write.mode("overwrite").parquet(f"{self.rejects}/reader={reader}/batch={batch_id}")
            good = typed.where(F.col("_reason").isNull())
            if self.log is None:
                self.sink.write_batch(good)
            else:
                self.log.append(good.select("_seq", "_operation", "_key_column", "_present", *[n.upper() for n in self.schema.names]))
        finally:
            typed.unpersist()

    def writer(self, stream: DataFrame) -> DataStreamWriter:
        return stream.writeStream.foreachBatch(self.write_batch)

    def current(self, target: DataFrame) -> DataFrame:
        """The target with all changes so far."""
        upper = target.toDF(*[c.upper() for c in target.columns])
        if self.log is None:
            return self.sink.current(upper).toDF(*target.columns)
        if not self.log.live_entries():
            return target
        # A record that was read again is the same in all columns.
        return apply_any_key(upper, self.log.read().dropDuplicates(), self.key).toDF(*target.columns)

    def fold_into(self, table: VersionedTable) -> None:
        """Write the target with all changes as its new version; see ``ChangeSink.fold_into``."""
        if self.log is None:
            self.sink.fold_into(table)
            return
        table.replace(self.current(table.read()))
        if self.log.live_entries():
            self.log.replace(self.log.read().limit(0))


class RoutedSink:
    """Collects JSON records for many tables under ``root``; each goes where its metadata says.

    ``tables`` has schema and key column by table name. Records for other tables are set aside.
    """

    def __init__(
        self, spark: SparkSession, root: str, tables: dict[str, tuple[T.StructType, str]], default_table: str, merge_every: int = 10, any_key: bool = False
    ):
        self.default_table = default_table
        self.rejects = f"{root.rstrip('/')}/unknown"
        self.sinks = {
            name.upper(): RecordSink(spark, f"{root.rstrip('/')}/{name.upper()}", schema, name, key, merge_every, any_key)
            for name, (schema, key) in tables.items()
        }

    def write_batch(self, batch: DataFrame, batch_id: int = 0) -> None:
        # Each table's sink reads the batch: it is kept, and what an executor loses of it is read again.
        named = batch.withColumn("_table_name", table_of(self.default_table)).persist()
        try:
            known = F.coalesce(F.col("_table_name").isin(*self.sinks), F.lit(False))
            unknown = named.where(~known).select("seq", "key_json", "after_json", F.lit(UNKNOWN_TABLE).alias(REASON))
            reader = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "none"
            unknown.write.mode("overwrite").parquet(f"{self.rejects}/reader={reader}/batch={batch_id}")
            for name, sink in self.sinks.items():
                sink.write_batch(named.where(F.col("_table_name") == name).drop("_table_name"), batch_id)
        finally:
            named.unpersist()

    def writer(self, stream: DataFrame) -> DataStreamWriter:
        return stream.writeStream.foreachBatch(self.write_batch)

    def current(self, targets: dict[str, DataFrame]) -> dict[str, DataFrame]:
        """The targets with all changes so far."""
        return {name: self.sinks[name.upper()].current(target) for name, target in targets.items()}
