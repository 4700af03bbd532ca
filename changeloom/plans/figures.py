"""Figures that come out of a run itself: last position, counts, first bad record, without a second scan."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from changeloom.names import REASON

FIGURES = "last_seq bigint, n_records bigint, n_deletes bigint, n_bad bigint, first_bad bigint"


def _figures(df: DataFrame, seq: str, operation: str, reason: str) -> list[Column]:
    bad = F.col(reason).isNotNull() if reason in df.columns else F.lit(False)
    return [
        F.max(seq).alias("last_seq"), F.count(F.lit(1)).alias("n_records"),
        F.count_if(F.coalesce(F.col(operation) == "delete", F.lit(False))).alias("n_deletes"),
        F.count_if(bad).alias("n_bad"), F.min(F.when(bad, F.col(seq))).alias("first_bad"),
    ]


def observed(records: DataFrame, seq: str = "seq", operation: str = "operation", reason: str = REASON) -> tuple[DataFrame, Observation]:
    """The records, and figures that are filled by the first action on them (see ``figures_row``).

    ``last_seq`` is the position to go on from. With a ``reason`` column, records that have one are bad, and what comes
    before ``first_bad`` is the prefix that a writer acknowledges.
    """
    observation = Observation()
    return records.observe(observation, *_figures(records, seq, operation, reason)), observation


def figures_row(records: DataFrame, observation: Observation) -> DataFrame:
    """The figures as one row; waits for the action that works them out."""
    return records.sparkSession.createDataFrame([tuple(observation.get[c.split()[0]] for c in FIGURES.split(", "))], FIGURES)


def observed_stream(records: DataFrame, name: str, seq: str = "seq", operation: str = "operation", reason: str = REASON) -> DataFrame:
    """A stream whose progress carries the figures of each micro-batch under ``name``."""
    return records.observe(name, *_figures(records, seq, operation, reason))


def stream_figures(query: StreamingQuery, name: str) -> list[dict[str, Any]]:
    """The figures of the micro-batches that the query's progress still tells of, oldest first."""
    found = [(p["batchId"], p["observedMetrics"].get(name)) for p in query.recentProgress if p["numInputRows"]]
    return [{"batch": batch, **row.asDict()} for batch, row in found if row is not None]
