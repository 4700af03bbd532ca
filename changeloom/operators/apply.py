"""Applying a change feed to a keyed target table.

A feed row has an order (``seq``, of any type that can be ordered), an operation, the key, the target columns and, for partial
images, the list of columns that were sent. Records are meant to take effect one after the other
in ``seq`` order. That outcome is found with one aggregate per key instead of a row loop:

* the last delete and the last upsert of the key, as ``seq``;
* per column the last value sent, and the ``seq`` that sent it.

A column sent after the last delete shows its last value. One that was not keeps the target's
value, or is NULL if the row was deleted and inserted again. The aggregate is computed in part
before the shuffle, so a key that holds most of the feed costs one row per task.

Target rows are never grouped: they meet the summary in a left join, in which adaptive execution
can split a hot key, and which becomes a broadcast join when the summary proves small.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeloom.names import Split, require_columns, split_on

DELETE = "delete"
LAST_DELETE = "_last_delete"
LAST_UPSERT = "_last_upsert"


def value_name(column: str) -> str:
    return f"_value_{column}"


def set_name(column: str) -> str:
    return f"_set_{column}"


def _as_list(key: str | list[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def order_of(seq: str | list[str]) -> Column:
    """The order of a row; of several columns the first counts most."""
    return F.col(seq) if isinstance(seq, str) else F.struct(*seq)


def split_unordered(feed: DataFrame, seq: str | list[str] = "seq") -> Split:
    """The rows that have an order, and those in which a part of it is NULL."""
    missing = F.lit(False)
    for part in _as_list(seq):
        missing = missing | F.col(part).isNull()
    return split_on(feed, F.when(missing, F.lit("order is missing")))


def _deletes(operation: str) -> Column:
    return F.coalesce(F.col(operation) == DELETE, F.lit(False))


def _sent(column: str, present: str | None) -> Column:
    if present is None:
        return F.lit(True)
    # No list means a full image.
    return F.coalesce(F.array_contains(F.col(present), column), F.col(present).isNull())


def summarise(
    feed: DataFrame,
    key: str | list[str],
    columns: list[str],
    present: str | None = None,
    seq: str | list[str] = "seq",
    operation: str = "operation",
    extra: tuple[Column, ...] = (),
) -> DataFrame:
    """One row per key: last delete, last upsert, and each column's last value with its ``seq``.

    Every operation but ``delete`` is an upsert. Rows with a NULL key or without an order (see
    ``split_unordered``) must be left out before. ``extra`` are further aggregates.
    """
    keys = _as_list(key)
    require_columns(feed, [*keys, *columns, *_as_list(seq), operation], "feed column")
    order = order_of(seq)
    is_delete = _deletes(operation)
    deleted = F.max(F.when(is_delete, order)).alias(LAST_DELETE)
    upserted = F.max(F.when(~is_delete, order)).alias(LAST_UPSERT)

    if present is None:
        # Full images: all columns are set together, so one comparison serves them all.
        image = F.max_by(F.struct(*columns), F.when(~is_delete, order)).alias("_image")
        summary = feed.groupBy(*keys).agg(deleted, upserted, image, *extra)
        parts = [
            part
            for c in columns
            for part in (
                F.col("_image")[c].alias(value_name(c)),
                F.col(LAST_UPSERT).alias(set_name(c)),
            )
        ]
        names = summary.columns[len(keys) + 3 :]
        return summary.select(*keys, LAST_DELETE, LAST_UPSERT, *parts, *names)

    parts = []
    for c in columns:
        # A NULL order takes no part in max_by or max; a NULL value with an order does.
        when_set = F.when(~is_delete & _sent(c, present), order)
        parts += [F.max_by(c, when_set).alias(value_name(c)), F.max(when_set).alias(set_name(c))]
    return feed.groupBy(*keys).agg(deleted, upserted, *parts, *extra)


def _after_delete(order: str) -> Column:
    """No order is taken for a smallest one: a key that was never deleted has NULL there."""
    return F.col(LAST_DELETE).isNull() | (F.col(order) > F.col(LAST_DELETE))


def is_live() -> Column:
    """True for a summary row whose key exists after the feed because of an upsert in it."""
    return F.col(LAST_UPSERT).isNotNull() & _after_delete(LAST_UPSERT)


def live_value(column: str) -> Column:
    """The column's last value if it was sent after the last delete, else NULL."""
    return F.when(
        F.col(set_name(column)).isNotNull() & _after_delete(set_name(column)), F.col(value_name(column))
    )


def insert_columns(
    target: DataFrame,
    key_value: Callable[[str], Column],
    keys: list[str],
    value: Callable[[str], Column],
    columns: list[str],
    defaults: dict[str, Column] | None,
) -> list[Column]:
    """A new target row: key, sent columns, and the default or NULL for every other column."""
    row = []
    for field in target.schema:
        name = field.name
        if name in keys:
            content = key_value(name)
        elif name in columns:
            content = value(name)
        else:
            content = (defaults or {}).get(name, F.lit(None))
        row.append(content.cast(field.dataType).alias(name))
    return row


def apply_summary(
    target: DataFrame,
    summary: DataFrame,
    key: str | list[str],
    columns: list[str],
    defaults: dict[str, Column] | None = None,
    broadcast_summary: bool = False,
    unique_target: bool = False,
) -> DataFrame:
    """The target after the changes in ``summary``.

    Target rows that share a key are all updated or deleted; a key that is deleted and inserted
    again gets one row. Target columns the feed does not carry keep their value, and in new rows
    get their entry of ``defaults`` or NULL.

    Ask for ``broadcast_summary`` only after measuring the summary: then the target is not shuffled
    at all. Say ``unique_target`` when no two target rows share a key: target and summary then meet in
    one full outer join, which reads the target once, and a bucketed one where it lies. Otherwise a
    key may hold a large part of the target. Adaptive execution splits such a partition, but only if
    both sides come straight from a shuffle; the null-safe comparison asks for one of the summary,
    whose own is by the bare key.
    """
    keys = _as_list(key)
    require_columns(target, [*keys, *columns], "target column")
    renamed = summary.withColumnsRenamed({k: f"_key_{k}" for k in keys})
    joined_side = F.broadcast(renamed) if broadcast_summary else renamed

    def same_key(left: DataFrame) -> list[Column]:
        return [left[k] == F.col(f"_key_{k}") for k in keys]

    def target_key() -> list[Column]:
        if broadcast_summary:
            return same_key(target)
        return [target[k].eqNullSafe(F.col(f"_key_{k}")) for k in keys]

    # A set column implies an upsert. Asking for both makes this branch read the same summary columns
    # as the inserts below, so that both are fed by one shuffle of the feed.
    def updated(c: str) -> Column:
        if c in keys or c not in columns:
            return target[c]
        is_set = F.col(LAST_UPSERT).isNotNull() & F.col(set_name(c)).isNotNull()
        return F.when(is_set, F.col(value_name(c))).otherwise(target[c]).alias(c)

    if unique_target and not broadcast_summary:
        fresh_row = insert_columns(
            target, lambda k: F.col(f"_key_{k}"), keys, live_value, columns, defaults
        )
        held_row = F.struct(*[updated(c).alias(c) for c in target.columns])
        marked = target.withColumn("_held", F.lit(True))
        stays = F.col("_held").isNotNull() & F.col(LAST_DELETE).isNull()
        row = F.when(stays, held_row).when(F.coalesce(is_live(), F.lit(False)), F.struct(*fresh_row))
        joined = marked.join(renamed, [marked[k] == F.col(f"_key_{k}") for k in keys], "full")
        return joined.select(row.alias("_row")).where(F.col("_row").isNotNull()).select("_row.*")

    kept = (
        target.join(joined_side, target_key(), "left")
        .where(F.col(LAST_DELETE).isNull())
        .select(*[updated(c) for c in target.columns])
    )

    # Keys in the target, once each, so that a hot target key does not travel as many rows.
    held = target.select(*keys)
    if broadcast_summary:
        in_feed = F.broadcast(renamed.select(*[f"_key_{k}" for k in keys]))
        held = held.join(in_feed, same_key(held), "left_semi")
    held = held.distinct()
    # A key deleted in the feed has left the target, so it is inserted whether held or not.
    fresh = (
        renamed.where(is_live())
        .join(held, [*same_key(held), F.col(LAST_DELETE).isNull()], "left_anti")
        .select(
            *insert_columns(
                target, lambda k: F.col(f"_key_{k}"), keys, live_value, columns, defaults
            )
        )
    )
    return kept.unionByName(fresh)


def without_key(feed: DataFrame, key: str | list[str]) -> Column:
    """True for rows in which any part of the key is NULL: they match no target row."""
    missing = F.lit(False)
    for k in _as_list(key):
        missing = missing | feed[k].isNull()
    return missing


def keyless_inserts(
    target: DataFrame,
    feed: DataFrame,
    key: str | list[str],
    columns: list[str],
    present: str | None = None,
    operation: str = "operation",
    defaults: dict[str, Column] | None = None,
) -> DataFrame:
    """Upserts without a key: nothing equals NULL, so each is a plain insert."""
    rows = feed.where(without_key(feed, key) & ~_deletes(operation))

    def sent(name: str) -> Column:
        return F.when(_sent(name, present), F.col(name))

    return rows.select(*insert_columns(target, F.col, _as_list(key), sent, columns, defaults))


def apply_changes(
    target: DataFrame,
    feed: DataFrame,
    key: str | list[str],
    columns: list[str] | None = None,
    present: str | None = None,
    seq: str | list[str] = "seq",
    operation: str = "operation",
    defaults: dict[str, Column] | None = None,
    broadcast_summary: bool = False,
    unique_target: bool = False,
) -> DataFrame:
    """The target table after a batch of changes, as a new DataFrame.

    An upsert that sends no column but the key inserts the row if it is absent. A change of the
    key itself arrives as an upsert of the new key: the feed holds no image of the old one, so
    the old row stays. Rows without an order change nothing (see ``split_unordered``).
    """
    keys = _as_list(key)
    feed = split_unordered(feed, seq).good
    if columns is None:
        columns = [c for c in target.columns if c not in keys]
    keyed = feed.where(~without_key(feed, keys))
    summary = summarise(keyed, keys, columns, present, seq, operation)
    applied = apply_summary(
        target, summary, keys, columns, defaults, broadcast_summary, unique_target
    )
    return applied.unionByName(
        keyless_inserts(target, feed, keys, columns, present, operation, defaults)
    )


def delete_keys(target: DataFrame, deletes: DataFrame, key: str) -> DataFrame:
    """The target without the rows whose key is in ``deletes``; absent keys change nothing.

    A NULL key deletes nothing. See ``apply_summary`` for the null-safe comparison.
    """
    gone = deletes.where(F.col(key).isNotNull()).select(F.col(key).alias("_gone")).distinct()
    return target.join(gone, target[key].eqNullSafe(F.col("_gone")), "left_anti")
