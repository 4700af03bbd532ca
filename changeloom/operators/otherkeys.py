"""Records keyed by another column than the target's, resolved to the target's key.

A record may name any column as its key: it then updates or deletes the rows that hold its value there at its
place in the order. Instead of applying such records in turns with the others, they are given the key of those
rows, so that all records form one group-by.

* **Spans.** While a row holds a value is known from the target and the records that carry the target's key: a
  span begins with the row or the record that sets the value, and ends with the next record that sets the column
  again or deletes the row.
* **As-of join.** A record meets the spans of its column and value that hold at its ``seq``. Each one gives a record
  with that row's key. Without one, an upsert is an insert and a delete is nothing.
* **Conflicts.** Spans do not know what records without the target's key do themselves. A record is in conflict
  when an earlier one of that kind may have changed what it meets, or when the row it meets has no key of
  its own. All records before the first conflict are applied in one step, and the search starts anew behind it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changeloom.operators.apply import apply_changes
from changeloom.sources.scratch import new_folder
from changeloom.sources.versions import take_snapshot

# Before every seq.
START = -(1 << 63)


def key_text(column: str, data_type: T.DataType) -> Column:
    """The value in a form in which values of all columns can be compared."""
    value = F.col(column)
    if isinstance(data_type, T.BinaryType):
        return F.hex(value)
    if isinstance(data_type, (T.FloatType, T.DoubleType)):
        # One zero.
        value = value + F.lit(0.0).cast(data_type)
    return value.cast("string")


def _sends(column: str) -> Column:
    return F.coalesce(F.array_contains("_present", column), F.lit(False)) & ~_deletes()


def _deletes() -> Column:
    return F.coalesce(F.col("_operation") == "delete", F.lit(False))


def _held(target: DataFrame, key: str, others: list[str], texts: dict[str, Column], asked: DataFrame) -> DataFrame:
    """``(k, k_text, column, v, seq, base)`` of the target's rows that hold a value that is asked for."""
    values = [F.struct(F.lit(c).alias("column"), texts[c].alias("v")) for c in [*others, key]]
    held = target.select(F.col(key).alias("k"), texts[key].alias("k_text"), F.inline(F.array(*values)))
    held = held.join(asked.select("column", "v").distinct(), ["column", "v"], "left_semi")
    return held.select("k", "k_text", "column", "v", F.lit(START).alias("seq"), F.lit(True).alias("base"))


def _spans(target: DataFrame, records: DataFrame, key: str, others: list[str], texts: dict[str, Column], asked: DataFrame) -> DataFrame:
    """``(k, k_text, column, v, begin, end)``: the row of key ``k`` holds ``v`` after ``begin`` and up to ``end``.

    The key itself is such a column: its spans say when a row is there. Rows without a key have spans without an
    end.
    """
    own = records.where((F.col("_key_column") == key) | _sends(key)).where(F.col(key).isNotNull() | ~_deletes())
    sets = [
        F.when(_deletes() | (_sends(c) if c != key else F.col(key).isNotNull()), F.struct(F.lit(c).alias("column"), F.when(~_deletes(), texts[c]).alias("v")))
        for c in [*others, key]
    ]
    events = own.select(
        F.col(key).alias("k"), texts[key].alias("k_text"), F.inline(F.array_compact(F.array(*sets))), F.col("_seq").alias("seq"), F.lit(False).alias("base")
    )
    every = events.unionByName(_held(target, key, others, texts, asked))
    row = Window.partitionBy("k_text", "column")
    after = F.when(F.col("base"), F.min(F.when(~F.col("base"), F.col("seq"))).over(row)).otherwise(F.lead("seq").over(row.orderBy("seq", F.col("base").desc())))
    keyed = every.where("k_text IS NOT NULL").withColumn("end", after)
    keyless = every.where("k_text IS NULL").withColumn("end", F.lit(None).cast("long"))
    return keyed.unionByName(keyless).where("v IS NOT NULL").withColumnRenamed("seq", "begin")


def _asked(records: DataFrame, key: str, others: list[str], texts: dict[str, Column]) -> DataFrame:
    """``(s, by, value, deletes, sends, sent, column, v, own)``: what each record with another key column looks for.

    Besides its own ``value`` of the column ``by`` that is the key it sends, if any: whether such a row is there.
    """
    other = records.where(F.col("_key_column") != key)
    value = _own_text(others, texts)
    probes = F.array(
        F.struct(F.col("_key_column").alias("column"), value.alias("v"), F.lit(True).alias("own")),
        F.struct(F.lit(key).alias("column"), F.when(_sends(key), texts[key]).alias("v"), F.lit(False).alias("own")),
    )
    return other.select(
        F.col("_seq").alias("s"), F.col("_key_column").alias("by"), value.alias("value"), _deletes().alias("deletes"),
        _sends(key).alias("sends"), F.when(_sends(key), texts[key]).alias("sent"), F.inline(probes),
    ).where("own OR v IS NOT NULL")


def _own_text(others: list[str], texts: dict[str, Column]) -> Column:
    return F.coalesce(*[F.when(F.col("_key_column") == c, texts[c]) for c in others])


# What tells records apart: those alike in all of this meet the same rows.
RECORD = ["s", "by", "value", "deletes", "sends", "sent"]


def _repeated(target: DataFrame, key: str, texts: dict[str, Column], met: DataFrame) -> DataFrame:
    """``(k_text, several)`` of the keys met that more than one target row has."""
    wanted = met.select("k_text").distinct()
    held = target.select(texts[key].alias("k_text")).join(wanted, "k_text", "left_semi")
    return held.groupBy("k_text").count().where("count > 1").select("k_text", F.lit(True).alias("several"))


def _first_conflict(target: DataFrame, met: DataFrame, key: str, texts: dict[str, Column], changed: dict[str, int], unique_target: bool) -> int | None:
    """The least ``seq`` of a record that cannot be resolved for certain."""
    if not unique_target:
        met = met.join(_repeated(target, key, texts, met), "k_text", "left")
    else:
        met = met.withColumn("several", F.lit(None).cast("boolean"))
    # Records without the target's key that take away a row that a later one would meet.
    gone = met.where("own AND deletes AND hit").groupBy("k_text").agg(F.min("s").alias("gone"))
    met = met.join(gone, "k_text", "left")
    per_record = met.groupBy(*RECORD).agg(
        F.coalesce(F.bool_or(F.col("own") & F.col("hit")), F.lit(False)).alias("meets"),
        F.coalesce(F.bool_or(~F.col("own") & F.col("hit")), F.lit(False)).alias("is_there"),
        F.coalesce(F.bool_or(F.col("own") & F.col("hit") & (F.col("k_text").isNull() | F.col("several"))), F.lit(False)).alias("no_key"),
        F.coalesce(F.bool_or(F.col("own") & F.col("hit") & (F.col("k_text") != F.col("sent"))), F.lit(False)).alias("moves"),
        F.coalesce(F.bool_or(F.col("hit") & (F.col("gone") < F.col("s"))), F.lit(False)).alias("was_taken"),
    )
    # An insert without the target's key makes a row that nothing but its own value finds.
    fresh = per_record.where("NOT meets AND NOT deletes AND NOT sends AND value IS NOT NULL").groupBy("by", "value").agg(F.min("s").alias("made"))
    per_record = per_record.join(fresh, ["by", "value"], "left")
    now = F.col("no_key") | F.col("moves") | F.col("was_taken")
    now |= F.col("sends") & (F.col("sent").isNull() | (~F.col("meets") & F.col("is_there")))
    now |= F.coalesce(F.col("made") < F.col("s"), F.lit(False))
    for column, since in changed.items():
        now |= (F.col("by") == column) & (F.col("s") > since)
    return per_record.where(now).agg(F.min("s")).first()[0]


def _resolve(target: DataFrame, records: DataFrame, key: str, others: list[str], changed: dict[str, int], unique_target: bool) -> tuple[DataFrame, int | None]:
    """The records with the target's key, and the first ``seq`` from which on that is not certain."""
    texts = {field.name: key_text(field.name, field.dataType) for field in target.schema}
    asked = _asked(records, key, others, texts)
    spans = _spans(target, records, key, others, texts, asked)
    holds = (F.col("begin") < F.col("s")) & (F.col("end").isNull() | (F.col("s") <= F.col("end")))
    met = asked.join(spans.select("k", "k_text", "column", "v", "begin", "end"), ["column", "v"], "left")
    # A record that meets no span keeps one row, with no hit.
    met = met.withColumn("hit", F.coalesce(holds, F.lit(False)))
    met = met.where(F.col("hit") | F.col("own")).select(*RECORD, "own", "k", "k_text", "hit")
    met = met.withColumns({"k": F.when(F.col("hit"), F.col("k")), "k_text": F.when(F.col("hit"), F.col("k_text"))}).distinct()
    met = take_snapshot(met, new_folder(target.sparkSession, "met"))
    cut = _first_conflict(target, met, key, texts, changed, unique_target)

    found = met.where("own AND hit").select(
        F.col("s").alias("_seq"), F.col("by").alias("_key_column"), F.col("value").alias("_value"), F.col("k").alias("_k"), F.lit(True).alias("_hit")
    ).distinct()
    renewed = records.where(F.col("_key_column") != key).withColumn("_value", _own_text(others, texts))
    renewed = renewed.join(found, ["_seq", "_key_column", "_value"], "left")
    kept = renewed.where(F.coalesce("_hit", F.lit(False)) | ~_deletes())
    renewed_key = F.when(F.col("_hit"), F.col("_k")).when(_sends(key), F.col(key)).cast(target.schema[key].dataType)
    kept = kept.withColumn(key, renewed_key).select(*records.columns)
    return records.where(F.col("_key_column") == key).unionByName(kept), cut


def apply_any_key(target: DataFrame, good: DataFrame, key: str, unique_target: bool = False) -> DataFrame:
    """The target after typed records (see ``typed_records``), whatever columns they are keyed by.

    Columns are named in upper case. Records that share a ``seq`` have no order among themselves. With
    ``unique_target`` no two target rows share a key, which then need not be looked into.
    """
    spark, step = target.sparkSession, dict(present="_present", seq="_seq", operation="_operation")
    rest = good
    while True:
        figures = rest.groupBy("_key_column").agg(
            F.min("_seq").alias("first"),
            # Where records that do not carry the target's key set columns that others are keyed by.
            *[F.min(F.when(_sends(c) & ~_sends(key) & (F.col("_key_column") != c), F.col("_seq"))).alias(f"_sets_{c}") for c in target.columns],
        ).collect()
        if not figures:
            return target
        others = sorted(r["_key_column"] for r in figures if r["_key_column"] != key)
        if not others:
            return apply_changes(target, rest, key, **step)
        changed = {}
        for c in others:
            since = [r[f"_sets_{c}"] for r in figures if r["_key_column"] != key and r[f"_sets_{c}"] is not None]
            if since:
                changed[c] = min(since)
        resolved, cut = _resolve(target, rest, key, others, changed, unique_target)
        if cut is None:
            return apply_changes(target, resolved, key, **step)
        first, run_key = min((r["first"], r["_key_column"]) for r in figures)
        if cut > first:
            target = apply_changes(target, resolved.where(F.col("_seq") < cut), key, **step)
            rest = rest.where(F.col("_seq") >= cut)
        else:
            # The first record is the conflict: it goes by its own column, with those that follow and share it.
            ahead = min(((r["first"], r["_key_column"]) for r in figures if r["_key_column"] != run_key), default=None)
            mine = F.col("_key_column") == run_key
            if ahead is not None:
                mine &= (F.col("_seq") < ahead[0]) | ((F.col("_seq") == ahead[0]) & F.lit(run_key < ahead[1]))
            target = apply_changes(target, rest.where(mine), run_key, **step)
            rest = rest.where(~mine)
        target = take_snapshot(target, new_folder(spark, "run"))
