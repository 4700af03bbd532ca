"""Records with JSON keys and payloads: parsing, routing, and setting bad ones aside.

A record has ``seq``, ``operation``, ``metadata`` (map of text), ``key_json`` and ``after_json``.
Parsing adds what the apply step needs; ``check_records`` then gives each record the first reason
for which it cannot be applied, in the order in which a record is worked on.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changeloom.functions.binding import evaluate_once
from changeloom.functions.convert import number1_to_bool
from changeloom.functions.datetimes import parse_datetime
from changeloom.functions.jsontext import (
    escape_json,
    has_repeated_names,
    is_absent,
    object_names,
    object_values,
    parse_object,
)
from changeloom.names import METADATA_TABLE, REASON, Split

DELETE = "delete"

# Fields of a record next to the columns of a table. Names of columns begin with a letter.
RECORD_FIELDS = {
    "seq": "_seq",
    "operation": "_operation",
    "table_name": "_table",
    "key_column": "_key_column",
    "present": "_present",
    "key_json": "_key_json",
    "after_json": "_after_json",
    REASON: "_reason",
}
REJECT_COLUMNS = ["seq", "key_json", "after_json", REASON]

# Why a record is set aside.
NO_ORDER = "order is missing"
BAD_PAYLOAD = "payload is not a JSON object"
EMPTY_PAYLOAD = "payload is empty"
BAD_KEY = "key is not a JSON object"
COMPOSITE_KEY = "composite keys are not supported"
EMPTY_KEY = "key value is missing"
REPEATED_NAME = "two column names are equal in upper case"
UNKNOWN_COLUMN = "unknown column"
NO_COLUMN = "no column to write"
BAD_VALUE = "value does not fit the column"
UNKNOWN_TABLE = "unknown table"
OTHER_KEY = "key column is not the target's"


def is_delete() -> Column:
    return F.coalesce(F.col("operation") == DELETE, F.lit(False))


def table_of(default_table: str) -> Column:
    """The table a record goes to: the one in its metadata, else the configured one."""
    return F.upper(F.coalesce(F.col("metadata")[METADATA_TABLE], F.lit(default_table)))


def key_column_of(names: Column, default_key: str) -> Column:
    """The name of the record key's only part, else the configured column."""
    return F.coalesce(F.get(names, F.lit(0)), F.lit(default_key.upper()))


def parse_records(records: DataFrame, default_table: str, default_key: str) -> DataFrame:
    """Adds ``table_name``, ``key_names``, ``key_values``, ``present``, ``payload``,
    ``key_column`` and ``merge_key``.

    Values are ``variant``: they keep their JSON type until the target type is known. A payload
    without the key column takes the value from the record key, and lists it as present.
    """
    parsed = evaluate_once(
        records,
        {
            "_key": parse_object(F.col("key_json")),
            "_after": F.when(~is_delete(), parse_object(F.col("after_json"))),
        },
    )
    parsed = parsed.withColumns(
        {"key_names": object_names(F.col("_key")), "present": object_names(F.col("_after"))}
    ).withColumns(
        {
            "table_name": table_of(default_table),
            "key_column": key_column_of(F.col("key_names"), default_key),
            "key_values": object_values(F.col("_key"), F.col("key_names")),
            "payload": object_values(F.col("_after"), F.col("present")),
        }
    )
    key_column = F.col("key_column")
    in_payload = F.coalesce(F.array_contains(F.col("present"), key_column), F.lit(False))
    in_key = F.coalesce(F.array_contains(F.col("key_names"), key_column), F.lit(False))
    injected = F.when(in_key & ~in_payload, F.array_append(F.col("present"), key_column)).otherwise(
        F.col("present")
    )
    merge_key = F.when(in_payload, F.element_at(F.col("payload"), key_column)).otherwise(
        F.element_at(F.col("key_values"), key_column)
    )
    return parsed.withColumns({"merge_key": merge_key, "present": injected}).drop("_key", "_after")


def typed_value(value: Column, data_type: T.DataType) -> Column:
    """A ``variant`` as the target type; NULL when it is NULL or does not fit."""
    def is_type(name: str) -> Column:
        return F.schema_of_variant(value) == name

    is_text = is_type("STRING")
    text = F.try_variant_get(value, "$", "string")
    if isinstance(data_type, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return F.when(is_text, parse_datetime(text)).cast(data_type)
    if isinstance(data_type, T.BinaryType):
        return F.when(is_text, F.encode(text, "UTF-8"))
    if isinstance(data_type, T.BooleanType):
        number = F.try_variant_get(value, "$", "double")
        return F.when(is_type("BOOLEAN"), F.try_variant_get(value, "$", "boolean")).otherwise(
            number1_to_bool(number)
        )
    if isinstance(data_type, T.NumericType):
        return exact_number(value, data_type)
    if isinstance(data_type, T.StringType):
        nested = F.schema_of_variant(value).rlike("^(OBJECT|ARRAY)")
        return F.when(nested, escape_json(F.to_json(value))).otherwise(text)
    return F.try_variant_get(value, "$", data_type.simpleString())


def exact_number(value: Column, data_type: T.NumericType) -> Column:
    """A ``variant`` as a number of the target type; NULL when it would have to be cut or rounded."""
    number = F.try_variant_get(value, "$", data_type.simpleString())
    if isinstance(data_type, (T.FloatType, T.DoubleType)):
        return number
    # Numbers in JSON are kept with all their digits, or as double when they have too many.
    exact = F.try_variant_get(value, "$", "decimal(38,9)")
    same = F.when(exact.isNotNull(), number.try_cast("decimal(38,9)") == exact).otherwise(
        number.cast("double") == F.try_variant_get(value, "$", "double")
    )
    # What decimal(38,9) itself would round shows in the text.
    fraction = F.length(F.regexp_extract(F.try_variant_get(value, "$", "string"), r"\.([0-9]*?)0*$", 1))
    digits = data_type.scale if isinstance(data_type, T.DecimalType) else 0
    return F.when(F.coalesce(same, F.lit(True)) & (fraction <= digits), number)


def _is_filled(value: Column) -> Column:
    return value.isNotNull() & ~F.coalesce(F.is_variant_null(value), F.lit(False))


TYPED = "_typed"
# The first column, in the order of the schema, whose value does not fit.
UNFIT = "_unfit"


def _converter(data_type: T.DataType) -> Callable[[Column], Column]:
    return lambda value: typed_value(value, data_type)


def with_typed_values(parsed: DataFrame, schema: T.StructType) -> DataFrame:
    """Adds one struct of typed values, each worked out once, and the name of the first column whose value does not fit.

    The record's key column takes the merge key, which the payload or the record key gave. Columns of one type are
    converted together, as an array: the expression, and the time to plan and compile it, grows with the
    types of a table, not with its columns.
    """
    places: dict[T.DataType, list[int]] = {}
    for i, field in enumerate(schema):
        places.setdefault(field.dataType, []).append(i)

    def raw(name: Column) -> Column:
        return F.when(F.col("key_column") == name, F.col("merge_key")).otherwise(F.element_at(F.col("payload"), name))

    names = [field.name.upper() for field in schema]
    wanted = {f"_raw_{g}": F.array(*[F.lit(names[i]) for i in own]) for g, own in enumerate(places.values())}
    rows = evaluate_once(parsed, {column: F.transform(array, raw) for column, array in wanted.items()})
    rows = evaluate_once(rows, {
        f"_typed_{g}": F.transform(f"_raw_{g}", _converter(kind)) for g, kind in enumerate(places)
    })
    values, unfit = {}, []
    for g, own in enumerate(places.values()):
        for place, i in enumerate(own):
            values[i] = F.get(f"_typed_{g}", F.lit(place)).alias(names[i])
        misses = F.zip_with(f"_raw_{g}", f"_typed_{g}", lambda value, typed: _is_filled(value) & typed.isNull())
        unfit.append(F.zip_with(misses, F.array(*[F.lit(i) for i in own]), lambda miss, i: F.when(miss, i)))
    first = F.get(F.array(*[F.lit(name) for name in names]), F.array_min(F.concat(*unfit)))
    row = F.struct(*[values[i] for i in range(len(names))])
    internal = [f"{kind}_{g}" for kind in ("_raw", "_typed") for g in range(len(places))]
    return evaluate_once(rows, {TYPED: row, UNFIT: first}).drop(*internal)


def reason_of(schema: T.StructType | None = None, tables: list[str] | None = None) -> Column:
    """Why a parsed record cannot be applied to a table of this schema; NULL when it can.

    With a schema the record must have its typed values (see ``with_typed_values``).
    """
    names, keys = F.col("present"), F.col("key_names")
    deletes = is_delete()
    no_payload, no_key = is_absent(F.col("after_json")), is_absent(F.col("key_json"))
    checks = [
        (F.col("seq").isNull(), NO_ORDER),
        (~deletes & no_payload, EMPTY_PAYLOAD),
        (~deletes & names.isNull(), BAD_PAYLOAD),
        (deletes & ~no_key & keys.isNull(), BAD_KEY),
        (has_repeated_names(keys) | has_repeated_names(names), REPEATED_NAME),
        (F.size(keys) > 1, COMPOSITE_KEY),
        (deletes & (no_key | (F.size(keys) == 0)), EMPTY_KEY),
        (~deletes & (F.size(names) == 0), NO_COLUMN),
    ]
    if tables is not None:
        checks.insert(0, (~F.col("table_name").isin(*[t.upper() for t in tables]), UNKNOWN_TABLE))
    if schema is not None:
        known = F.array(*[F.lit(name.upper()) for name in schema.names])
        checks.append((~deletes & (F.size(F.array_except(names, known)) > 0), UNKNOWN_COLUMN))
        checks.append((~F.array_contains(known, F.col("key_column")), UNKNOWN_COLUMN))
    reasons = [F.when(failed, F.lit(text)) for failed, text in checks]
    if schema is not None:
        reasons.append(F.when(F.col(UNFIT).isNotNull(), F.concat(F.lit(f"{BAD_VALUE} "), F.col(UNFIT))))
    return F.coalesce(*reasons)


def mark_records(
    parsed: DataFrame, schema: T.StructType | None = None, tables: list[str] | None = None
) -> DataFrame:
    """Parsed records with their ``reject_reason``, and their typed values if a schema is given."""
    if schema is not None:
        parsed = with_typed_values(parsed, schema)
    return evaluate_once(parsed, {REASON: reason_of(schema, tables)})


def check_records(
    parsed: DataFrame, schema: T.StructType | None = None, tables: list[str] | None = None
) -> Split:
    """Records that can be applied, and those set aside with a reason."""
    marked = mark_records(parsed, schema, tables)
    return Split(
        good=marked.where(F.col(REASON).isNull()).drop(REASON, TYPED, UNFIT),
        rejects=marked.where(F.col(REASON).isNotNull()).drop(TYPED, UNFIT),
    )


def applied_prefix(marked: DataFrame, seq: str = "seq", reason: str = REASON) -> DataFrame:
    """The records before the first bad one, for writers that stop at the first failure.

    Bad records have a ``reason``. The first bad ``seq`` is a single value, worked out before
    the scan, so it can be pushed into it. ``marked`` is read twice: land it if it is costly. A record
    without an order is bad, but is before or after no other.
    """
    first_bad = marked.where(F.col(reason).isNotNull()).agg(F.min(seq)).scalar()
    before = first_bad.isNull() | (F.col(seq) < first_bad)
    return marked.where(F.col(reason).isNull() & before).drop(reason)


def prefix_count(marked: DataFrame, seq: str = "seq", reason: str = REASON) -> DataFrame:
    """One row, ``n_applied``: how many records a writer acknowledges that stops at the first failure."""
    return applied_prefix(marked, seq, reason).agg(F.count("*").alias("n_applied"))


def typed_columns(schema: T.StructType) -> list[Column]:
    """The typed values as the columns of one target, named in upper case."""
    return [F.col(TYPED)[field.name.upper()].alias(field.name.upper()) for field in schema]


def typed_records(parsed: DataFrame, schema: T.StructType, tables: list[str] | None = None) -> DataFrame:
    """Parsed records as typed changes, each with its reject reason.

    What belongs to the record gets names that no column can have (see ``RECORD_FIELDS``).
    """
    fields = [F.col(name).alias(alias) for name, alias in RECORD_FIELDS.items()]
    return mark_records(parsed, schema, tables).select(*fields, *typed_columns(schema))


def rejected(typed: DataFrame) -> DataFrame:
    """The typed records that were set aside."""
    bad = typed.where(F.col(RECORD_FIELDS[REASON]).isNotNull())
    return bad.select(*[F.col(RECORD_FIELDS[c]).alias(c) for c in REJECT_COLUMNS])
