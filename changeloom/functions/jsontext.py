"""JSON objects as columns: parsing keys and payloads, and writing maps and lists as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changeloom.functions.binding import bound


def is_absent(text: Column) -> Column:
    """True when there is no document at all: NULL or zero bytes."""
    return F.coalesce(F.octet_length(text) == 0, F.lit(True))


OBJECT = "map<string,variant>"
_STRICT = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}


def parse_object(text: Column) -> Column:
    """A JSON object as name to typed value; NULL when absent or not an object.

    JSON ``null`` counts as an object without members. The text is parsed as the first of two list
    elements: a parser that is given the bare text stops at the end of the object and does not see
    what follows it. The second element holds the text's own hash, which no text that closes the list
    itself can know. The hash is a value and not a name: a JSON parser remembers every name it meets,
    and with a new one in each text it spends most of its time on that.
    """
    mark = F.xxhash64(text)
    listed = F.concat(F.lit("["), text, F.lit(',{"":'), mark.cast("string"), F.lit("}]"))
    empty = F.from_json(F.lit("{}"), OBJECT)

    def first(elements: Column) -> Column:
        told = F.try_variant_get(F.element_at(F.get(elements, F.lit(1)), F.lit("")), "$", "bigint")
        whole = (F.size(elements) == 2) & F.coalesce(told == mark, F.lit(False))
        return F.when(whole, F.coalesce(F.get(elements, F.lit(0)), empty))

    return bound(F.from_json(listed, f"array<{OBJECT}>", _STRICT), first)


def object_names(parsed: Column) -> Column:
    """The names of a parsed object in upper case."""
    return F.transform(F.map_keys(parsed), lambda name: F.upper(name))


def has_repeated_names(names: Column) -> Column:
    """True when two names are equal once upper-cased."""
    return F.coalesce(F.size(F.array_distinct(names)) != F.size(names), F.lit(False))


def object_values(parsed: Column, names: Column) -> Column:
    """The values of a parsed object by upper-cased name; NULL when names are repeated."""
    return F.when(~has_repeated_names(names), F.map_from_arrays(names, F.map_values(parsed)))


# Characters written as escapes inside JSON text so that it is safe in HTML.
JSON_ESCAPES = {
    "<": "\\u003c",
    ">": "\\u003e",
    "&": "\\u0026",
    "\u2028": "\\u2028",
    "\u2029": "\\u2029",
}


def escape_json(text: Column) -> Column:
    """These characters can stand only inside strings, so a plain replacement is exact."""
    for character, escape in JSON_ESCAPES.items():
        text = F.replace(text, F.lit(character), F.lit(escape))
    return text


def list_to_json(value: Column) -> Column:
    return escape_json(F.to_json(value, {"ignoreNullFields": "false"}))


def sorted_names(value: Column, data_type: T.DataType) -> Column:
    """The value with map keys and struct fields in order, at every level."""
    if isinstance(data_type, T.MapType):
        keys = F.array_sort(F.map_keys(value))
        entry = lambda k: F.struct(k.alias("key"), sorted_names(value[k], data_type.valueType).alias("value"))
        return F.map_from_entries(F.transform(keys, entry))
    if isinstance(data_type, T.StructType):
        fields = sorted(data_type, key=lambda field: field.name)
        ordered = F.struct(*[sorted_names(value[f.name], f.dataType).alias(f.name) for f in fields])
        return F.when(value.isNotNull(), ordered)
    if isinstance(data_type, T.ArrayType):
        return F.transform(value, lambda element: sorted_names(element, data_type.elementType))
    return value


def nested_to_json(value: Column, data_type: T.DataType) -> Column:
    """Maps, structs and lists become JSON text, names in order; every other type passes unchanged."""
    if isinstance(data_type, (T.MapType, T.StructType, T.ArrayType)):
        return list_to_json(sorted_names(value, data_type))
    if isinstance(data_type, T.VariantType):
        return escape_json(F.to_json(value))
    return value
