"""Change capture: what happened between two versions of a table, as a tracking table.

The reference point is a row trigger: an inserted or updated row is logged with its new values, a
deleted one with its old values. Here the same log is derived from two versions.

Both versions are counted per distinct whole row. Rows that are in both, equally often, cancel out
in that one aggregate, also when the key is NULL or not unique, and since whole rows are hashed, a
key that many rows share is spread over all tasks. Only what is left is looked at per key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changeloom.names import CREATED_AT, OPERATION_TYPE, TRACKING_ID, require_columns
from changeloom.sources.scratch import new_folder
from changeloom.sources.versions import take_snapshot

_NET = "_net"
_COPIES = "_copies"
# Equal rows are written out in two steps, so that no task and no array has to hold them all.
_COPIES_PER_STEP = 1 << 16


def _net_rows(old: DataFrame, new: DataFrame) -> DataFrame:
    """Distinct rows that occur more often in one version, with new count minus old count."""
    names = old.columns
    both = old.withColumn(_NET, F.lit(-1).cast("bigint")).unionByName(
        new.withColumn(_NET, F.lit(1).cast("bigint"))
    )
    return both.groupBy(*names).agg(F.sum(_NET).alias(_NET)).where(F.col(_NET) != 0)


def _repeat(rows: DataFrame, copy_number: str) -> DataFrame:
    """Each row as often as ``_copies`` says, the copies numbered from 1."""
    once = rows.where(F.col(_COPIES) == 1).withColumn(copy_number, F.lit(1).cast("bigint"))
    last_step = F.expr(f"({_COPIES} - 1) div {_COPIES_PER_STEP}")
    steps = rows.where(F.col(_COPIES) > 1).withColumn(
        "_step", F.explode(F.sequence(F.lit(0).cast("bigint"), last_step))
    )
    before = F.col("_step") * F.lit(_COPIES_PER_STEP)
    in_step = F.least(F.lit(_COPIES_PER_STEP), F.col(_COPIES) - before)
    # The steps of a row are dealt out before they are written out.
    many = (
        steps.repartition("_step", *rows.columns)
        .withColumn(copy_number, F.explode(F.sequence(F.lit(1).cast("bigint"), in_step)))
        .withColumn(copy_number, F.col(copy_number) + before)
        .drop("_step")
    )
    return once.unionByName(many).drop(_COPIES)


def capture_diff(
    old: DataFrame,
    new: DataFrame,
    keys: list[str],
    columns: list[str] | None = None,
    copy_number: str | None = None,
) -> DataFrame:
    """The changes that lead from ``old`` to ``new``: the logged columns and the operation type.

    A key with one row before and another after is an ``update``. Any other difference is a
    ``delete`` per row that went and an ``insert`` per row that came. A change in any column is
    logged, whichever ``columns`` are asked for. A column named ``copy_number``, if wanted, tells
    equal changes apart.

    The rows that differ are written to the shared folder: they are needed three times, and what
    they are worked out from is both versions in full.
    """
    require_columns(old, keys, "key column")
    names = old.columns
    if sorted(new.columns) != sorted(names):
        raise ValueError("the two versions have different columns")
    logged = columns or names
    require_columns(old, logged, "column")
    absent = [k for k in keys if k not in logged]
    if absent:
        raise ValueError(f"columns must include {', '.join(absent)}")

    changed = take_snapshot(_net_rows(old, new), new_folder(old.sparkSession, "changed"))
    came, went = F.greatest(F.col(_NET), F.lit(0)), F.greatest(-F.col(_NET), F.lit(0))
    per_key = changed.groupBy(*[F.col(k).alias(f"_key_{k}") for k in keys]).agg(
        F.sum(went).alias("_went"), F.sum(came).alias("_came")
    )
    # The changed rows are the left side, where adaptive execution can split a hot key.
    same_key = [changed[k].eqNullSafe(F.col(f"_key_{k}")) for k in keys]
    paired = (F.col("_went") == 1) & (F.col("_came") == 1)
    is_new = F.col(_NET) > 0
    labelled = (
        changed.join(per_key, same_key, "left")
        .where(is_new | ~paired)
        .select(
            *[F.col(c) for c in logged],
            F.when(~is_new, "delete").when(paired, "update").otherwise("insert").alias(OPERATION_TYPE),
            F.abs(_NET).alias(_COPIES),
        )
    )
    repeated = _repeat(labelled, copy_number or "_copy")
    return repeated if copy_number else repeated.drop("_copy")


def number_changes(
    changes: DataFrame,
    order: list[str | Column],
    start: int = 0,
    created_at: Column | None = None,
) -> DataFrame:
    """A tracking table: the changes with an id that rises by one in the given order.

    Rows that are equal in it are ordered by their other columns. If many rows may be equal in all
    columns, let one tell them apart (see ``copy_number`` of ``capture_diff``), or they meet in one
    partition. The sorted rows are written to the shared folder together
    with their place inside their partition, since only a written partitioning stays the same when
    it is read twice. The ids then need one small table, with a row per partition, and no window
    over all rows.
    """
    named = [o for o in order if isinstance(o, str)]
    others = [
        f.name
        for f in changes.schema
        if f.name not in named and not isinstance(f.dataType, (T.MapType, T.VariantType))
    ]
    sort_keys = [F.col(o) if isinstance(o, str) else o for o in [*order, *others]]
    dated = changes.withColumn(CREATED_AT, F.current_timestamp() if created_at is None else created_at)
    ranked = rank_rows(dated, sort_keys, TRACKING_ID)
    return ranked.withColumn(TRACKING_ID, F.lit(start).cast("bigint") + F.col(TRACKING_ID))


def rank_rows(rows: DataFrame, sort_keys: list[Column], name: str) -> DataFrame:
    """The rows with their rank, from 1, in the order of the sort keys, without a window over all of them."""
    path = new_folder(rows.sparkSession, "numbered")
    identity = F.monotonically_increasing_id()
    (
        rows.repartitionByRange(*sort_keys)
        .sortWithinPartitions(*sort_keys)
        .withColumn("_part", F.shiftrightunsigned(identity, 33).cast("int"))
        .withColumn("_place", identity.bitwiseAND(F.lit((1 << 33) - 1)))
        .write.parquet(path)
    )
    written = rows.sparkSession.read.parquet(path)
    sizes = written.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    # One row per partition of the write: bounded by the partition count, not by the data.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    return (
        written.join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_offset") + F.col("_place") + 1)
        .drop("_part", "_place", "_offset")
    )
