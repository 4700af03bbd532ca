"""Changes kept in a form that can be merged in any order.

A micro-batch does not always hold later changes than the one before it, and after a restart some
are read again. A summary row (see ``apply``) keeps the ``seq`` of everything in it, so summaries
of any split of a feed, in any order and with repeats, merge to the summary of the whole feed.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeloom.operators.apply import (
    LAST_DELETE,
    LAST_UPSERT,
    apply_summary,
    insert_columns,
    live_value,
    order_of,
    set_name,
    split_unordered,
    summarise,
    value_name,
    without_key,
)

# Upserts without a key are told apart by their own seq and content, so a replayed one is not inserted
# twice. That also spreads them over the shuffle, where equal NULL keys would meet in one task.
KEYLESS_SEQ = "_keyless_seq"
KEYLESS_ROW = "_keyless_row"
# How many rows of a batch are equal in all that.
KEYLESS_COUNT = "_keyless_count"
KEYLESS = [KEYLESS_SEQ, KEYLESS_ROW]


def to_state(
    feed: DataFrame,
    key: str,
    columns: list[str],
    present: str | None = None,
    seq: str | list[str] = "seq",
    operation: str = "operation",
    row_id: list[str] | None = None,
) -> DataFrame:
    """The feed's changes, one row per key plus one per upsert without a key.

    Equal upserts without a key in one batch are as many inserts. ``row_id`` names the columns that tell rows of the
    source apart (see ``streaming.tail.with_row_id``): the same ones in another batch are a replay, others are
    inserts of their own. Without it equal rows of two batches count as replays of one, unless
    their ``seq`` differ. Rows without an order change nothing.
    """
    keyless = without_key(feed, key)
    content = F.xxhash64(operation, *columns, *([present] if present else []), *(row_id or []))
    marked = split_unordered(feed, seq).good.withColumns(
        {KEYLESS_SEQ: F.when(keyless, order_of(seq)), KEYLESS_ROW: F.when(keyless, content)}
    )
    count = F.count(KEYLESS_ROW).alias(KEYLESS_COUNT)
    return summarise(marked, [key, *KEYLESS], columns, present, seq, operation, (count,))


def _merge(rows: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    parts: list[Column] = []
    for c in columns:
        parts += [
            F.max_by(value_name(c), set_name(c)).alias(value_name(c)),
            F.max(set_name(c)).alias(set_name(c)),
        ]
    return rows.groupBy(*keys).agg(
        F.max(LAST_DELETE).alias(LAST_DELETE),
        F.max(LAST_UPSERT).alias(LAST_UPSERT),
        *parts,
        F.max(KEYLESS_COUNT).alias(KEYLESS_COUNT),
    )


def merge_states(states: list[DataFrame], key: str, columns: list[str]) -> DataFrame:
    """One state that holds the changes of all; order and repeats do not matter."""
    return _merge(reduce(DataFrame.unionByName, states), [key, *KEYLESS], columns)


def merge_keyed(changes: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Like ``merge_states`` for rows with a key: grouped by the key alone, which keeps buckets of it."""
    missing = {name: F.lit(None).cast(changes.schema[name].dataType) for name in KEYLESS}
    return _merge(changes, [key], columns).select(*[missing.get(c, F.col(c)).alias(c) for c in changes.columns])


def apply_state(
    target: DataFrame,
    state: DataFrame,
    key: str,
    columns: list[str],
    defaults: dict[str, Column] | None = None,
    broadcast_state: bool = False,
    unique_target: bool = False,
    keyless: DataFrame | None = None,
) -> DataFrame:
    """The target after all changes in a state, or in the rows of many states put together.

    Target rows count as before every change. Rows with a key are merged by the key alone, so that
    the join with the target needs no further shuffle of them. Rows without one are in the state too, or
    apart, in ``keyless``.
    """
    keyed = _merge(state if keyless is not None else state.where(F.col(KEYLESS_SEQ).isNull()), [key], columns)
    applied = apply_summary(target, keyed, key, columns, defaults, broadcast_state, unique_target)
    others = state if keyless is None else keyless
    upserts = others.where(F.col(KEYLESS_SEQ).isNotNull() & F.col(LAST_UPSERT).isNotNull())
    row = insert_columns(target, F.col, [key], live_value, columns, defaults)
    merged = _merge(upserts, [key, *KEYLESS], columns)
    each = merged.withColumn("_n", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col(KEYLESS_COUNT))))
    return applied.unionByName(each.select(*row))
