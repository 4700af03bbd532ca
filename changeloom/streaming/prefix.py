"""A stream into a table that stops at the first record it cannot apply.

Records before it are applied and acknowledged, the record and all later ones are not. Once its cause is
mended, or the record is given up, a restart goes on with that micro-batch. The micro-batches must come in the
order of the records: see ``streaming.tail.tail_rows``.
"""

from __future__ import annotations

from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from changeloom.operators.records import parse_records, typed_records
from changeloom.plans.figures import observed
from changeloom.sources.scratch import new_folder
from changeloom.streaming.sink import ChangeSink

STOPS = "batch bigint, last_applied bigint, n_applied bigint, first_bad bigint"


class StoppedAtRecord(Exception):
    """A record could not be applied; those before it were."""

    def __init__(self, seq: Any, reason: str):
        super().__init__(f"record {seq}: {reason}")
        self.seq, self.reason = seq, reason


class PrefixSink:
    """Applies JSON records to one table until the first bad one. ``given_up`` are bad records to pass over."""

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType, table: str, key: str, given_up: tuple[int, ...] = ()):
        self.spark, self.root, self.schema, self.table, self.key = spark, root.rstrip("/"), schema, table, key.upper()
        self.given_up = given_up
        columns = [name.upper() for name in schema.names if name.upper() != self.key]
        self.sink = ChangeSink(spark, f"{self.root}/changes", self.key, columns, "_present", seq="_seq", operation="_operation")

    def write_batch(self, batch: DataFrame, batch_id: int = 0) -> None:
        typed = typed_records(parse_records(batch, self.table, self.key), self.schema, [self.table])
        other = F.when(F.col("_key_column") != self.key, F.lit("key column is not the target's"))
        typed = typed.withColumn("_reason", F.coalesce("_reason", other)).where(~F.col("_seq").isin(list(self.given_up)) | F.col("_seq").isNull())
        # Written once; the first bad record comes out of that same pass.
        watched, figures = observed(typed, "_seq", "_operation", "_reason")
        path = new_folder(self.spark, "prefix")
        watched.write.parquet(path)
        landed, first_bad = self.spark.read.schema(typed.schema).parquet(path), figures.get["first_bad"]
        before = landed if first_bad is None else landed.where(F.col("_seq") < first_bad)
        good, applied = observed(before.where(F.col("_reason").isNull()), "_seq", "_operation", "_reason")
        self.sink.write_batch(good)
        stop = [(batch_id, applied.get["last_seq"], applied.get["n_records"], first_bad)]
        # A batch that is run again replaces what it said before.
        self.spark.createDataFrame(stop, STOPS).coalesce(1).write.mode("overwrite").parquet(f"{self.root}/stops/number={batch_id}")
        if first_bad is not None:
            raise StoppedAtRecord(first_bad, landed.where(F.col("_seq") == first_bad).agg(F.min("_reason")).first()[0])

    def writer(self, stream: DataFrame) -> DataStreamWriter:
        return stream.writeStream.foreachBatch(self.write_batch)

    def acknowledged(self) -> DataFrame:
        """A row per micro-batch: how many records were applied, the last of them, and the bad one it stopped at."""
        try:
            return self.spark.read.schema(STOPS).parquet(f"{self.root}/stops").select(*[c.split()[0] for c in STOPS.split(", ")])
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], STOPS)

    def current(self, target: DataFrame) -> DataFrame:
        upper = target.toDF(*[c.upper() for c in target.columns])
        return self.sink.current(upper).toDF(*target.columns)
