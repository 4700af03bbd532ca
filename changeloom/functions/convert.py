"""Value conversion between database column types and Spark types."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changeloom.functions.binding import evaluate_once
from changeloom.functions.datetimes import format_datetime, parse_datetime, truncate_to_second
from changeloom.functions.jsontext import nested_to_json
from changeloom.names import (
    MAX_OBJECT_NAME_BYTES,
    OBJECT_NAME_PATTERN,
    ColumnType,
    Split,
    split_on,
)

_TEXT_INTEGER = r"^[+-]?[0-9]+$"


def number_to_int(value: Column, data_type: T.DataType) -> Column:
    """A whole number as ``bigint``; NULL when it has a fraction, is no number or does not fit."""
    if isinstance(data_type, T.IntegralType):
        return value.cast("bigint")
    if isinstance(data_type, T.StringType):
        return F.when(value.rlike(_TEXT_INTEGER), value.try_cast("bigint"))
    # try_cast cuts fractions, so a fraction shows as a difference to the value itself.
    whole = value.try_cast("bigint")
    return F.when(whole == value, whole)


def number_is_bad(value: Column, data_type: T.DataType) -> Column:
    """True when a value is there but is not a whole number."""
    return value.isNotNull() & number_to_int(value, data_type).isNull()


def number1_to_bool(value: Column) -> Column:
    """A one-digit flag: true for 1 only, false for every other number, NULL kept."""
    return value == 1


def bool_to_number1(value: Column, data_type: T.DataType) -> Column:
    """1 or 0 for booleans; values of any other type pass unchanged."""
    return value.cast("int") if isinstance(data_type, T.BooleanType) else value


def to_blob(value: Column, data_type: T.DataType) -> Column:
    """Bytes stay, text becomes its UTF-8 bytes; no other type can be stored as bytes."""
    if isinstance(data_type, T.BinaryType):
        return value
    if isinstance(data_type, T.StringType):
        return F.encode(value, "UTF-8")
    raise TypeError(f"cannot store {data_type.simpleString()} as bytes")


def to_datetime(value: Column, data_type: T.DataType) -> Column:
    """A time to the second, from a time or from text in an accepted layout; else NULL."""
    if isinstance(data_type, T.StringType):
        return parse_datetime(value)
    if isinstance(data_type, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return truncate_to_second(value)
    raise TypeError(f"cannot store {data_type.simpleString()} as a date")


def valid_object_name(name: Column) -> Column:
    """True when ``name`` may name a table or column."""
    return name.rlike(OBJECT_NAME_PATTERN) & (F.octet_length(name) <= MAX_OBJECT_NAME_BYTES)


def upper_names(df: DataFrame) -> DataFrame:
    """Column names in upper case; names that become equal are an error."""
    upper = [name.upper() for name in df.columns]
    twice = sorted({name for name in upper if upper.count(name) > 1})
    if twice:
        raise ValueError(f"column names equal in upper case: {', '.join(twice)}")
    return df.toDF(*upper)


def _first_reason(checks: list[Column]) -> Column:
    return reduce(lambda found, check: F.coalesce(found, check), checks, F.lit(None).cast("string"))


def read_rows(df: DataFrame, types: dict[str, ColumnType]) -> Split:
    """Rows as read from the database: numbers to integers, one-digit flags to booleans.

    A row with a number that is not whole is set aside; columns without a type pass unchanged.
    """
    checks, columns = [], []
    for field in df.schema:
        value = F.col(f"`{field.name}`")
        column_type = types.get(field.name.upper())
        if column_type is not None and column_type.is_number:
            bad = number_is_bad(value, field.dataType)
            checks.append(F.when(bad, F.lit(f"{field.name}: not a whole number")))
            number = number_to_int(value, field.dataType)
            columns.append((number1_to_bool(number) if column_type.is_flag else number).alias(field.name))
        else:
            columns.append(value)
    good, rejects = split_on(df, _first_reason(checks))
    return Split(good.select(*columns), rejects)


def write_rows(df: DataFrame, types: dict[str, ColumnType]) -> Split:
    """Rows as written to the database: flags to 1/0, dates cut to the second, text and nested
    values as the column type asks. A row with date text in no known layout is set aside."""
    checks, columns, parsed = [], [], {}
    for field in df.schema:
        value = F.col(f"`{field.name}`")
        column_type = types.get(field.name.upper())
        if column_type is not None and column_type.is_flag:
            converted = bool_to_number1(value, field.dataType)
        elif column_type is not None and column_type.is_time:
            converted = to_datetime(value, field.dataType)
            if isinstance(field.dataType, T.StringType):
                parsed[f"_parsed_{field.name}"] = converted
                converted = F.col(f"`_parsed_{field.name}`")
                bad = value.isNotNull() & converted.isNull()
                checks.append(F.when(bad, F.lit(f"{field.name}: unknown date layout")))
        elif column_type is not None and column_type.is_blob:
            converted = to_blob(value, field.dataType)
        else:
            converted = nested_to_json(value, field.dataType)
        columns.append(converted.alias(field.name))
    good, rejects = split_on(evaluate_once(df, parsed) if parsed else df, _first_reason(checks))
    return Split(good.select(*columns), rejects.drop(*parsed))


__all__ = [
    "bool_to_number1",
    "format_datetime",
    "number1_to_bool",
    "number_is_bad",
    "number_to_int",
    "parse_datetime",
    "read_rows",
    "to_blob",
    "to_datetime",
    "upper_names",
    "valid_object_name",
    "write_rows",
]
