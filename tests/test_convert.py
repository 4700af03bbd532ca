from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from changeloom.functions import convert, jsontext
from changeloom.names import REASON, ColumnType

DATE = ColumnType("DATE")
NUMBER = ColumnType("NUMBER")
FLAG = ColumnType("NUMBER", 1, 0)

# Date layouts that must be read, and what they mean.
ACCEPTED = {
    "1989-10-04T13:14:15Z": "1989-10-04 13:14:15",
    "1989-10-04T13:14:15.987654321Z": "1989-10-04 13:14:15",
    "1989-10-04T13:14:15,5+02:00": "1989-10-04 13:14:15",
    "1989-10-04T23:59:59-11:30": "1989-10-04 23:59:59",
    "10/04 01:14:15PM '89 -0700": "1989-10-04 13:14:15",
    "10/04 12:14:15AM '89 -0700": "1989-10-04 00:14:15",
    "10/04 12:14:15PM '21 -0700": "2021-10-04 12:14:15",
    "Wed Oct  4 13:14:15 1989": "1989-10-04 13:14:15",
    "Wed Oct 14 13:14:15 1989": "1989-10-14 13:14:15",
    "Wed Oct  4 13:14:15 MST 1989": "1989-10-04 13:14:15",
    "Wed Oct 04 13:14:15 -0700 1989": "1989-10-04 13:14:15",
    "04 Oct 89 13:14 UTC": "1989-10-04 13:14:00",
    "04 Oct 68 13:14 CEST": "2068-10-04 13:14:00",
    "04 Oct 69 13:14 -0700": "1969-10-04 13:14:00",
    "Wednesday, 04-Oct-89 13:14:15 GMT+3": "1989-10-04 13:14:15",
    "Wed, 04 Oct 1989 13:14:15 UTC": "1989-10-04 13:14:15",
    "wed, 04 oct 1989 13:14:15 UTC": "1989-10-04 13:14:15",
    "Wed, 04 Oct 1989 13:14:15 +0530": "1989-10-04 13:14:15",
    "Thu, 29 Feb 2024 00:00:00 GMT": "2024-02-29 00:00:00",
}
REFUSED = [
    "",
    "junk",
    "1989-10-04 13:14:15",
    "1989-10-04",
    "3:04PM",
    "Oct  4 13:14:15",
    "Oct  4 13:14:15.123456789",
    "Wed, 30 Feb 2024 00:00:00 GMT",
    "1989-10-04T24:00:00Z",
    "1989-10-04T13:60:00Z",
    "1989-10-04T13:14:60Z",
    "1989-13-04T13:14:15Z",
    "10/04 13:14:15PM '89 -0700",
    "Wed, 04 Oct 1989 13:14:15 utc",
    "Mit, 04 Okt 1989 13:14:15 UTC",
    "1989-10-04T13:14:15Z\n",
    " 1989-10-04T13:14:15Z",
]


def test_dates_keep_the_written_wall_clock(spark, rows):
    df = spark.createDataFrame([(t,) for t in ACCEPTED], "t string")
    good, rejects = convert.write_rows(df.withColumn("text", F.col("t")), {"T": DATE})
    result = good.select("text", convert.format_datetime(F.col("t")).alias("t"))
    assert dict(rows(result)) == ACCEPTED
    assert rejects.count() == 0


def test_other_date_text_is_refused(spark, rows):
    df = spark.createDataFrame([(t,) for t in REFUSED] + [(None,)], "t string")
    good, rejects = convert.write_rows(df, {"T": DATE})
    assert rows(good) == [(None,)]
    assert rows(rejects, "t") == sorted((t,) for t in REFUSED)
    assert {r[REASON] for r in rejects.collect()} == {"t: unknown date layout"}


def test_session_time_zone_does_not_move_dates(spark, rows):
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        # 02:30 on this day does not exist in that zone.
        df = spark.createDataFrame([("2024-03-31T02:30:00Z",)], "t string")
        good = convert.write_rows(df, {"T": DATE}).good
        assert rows(good.select(convert.format_datetime(F.col("t")))) == [("2024-03-31 02:30:00",)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_time_values_are_cut_to_the_second(spark, rows):
    moment = dt.datetime(1989, 10, 4, 13, 14, 15, 999999)
    df = spark.createDataFrame([(moment, moment, moment.date())], "a timestamp, b timestamp_ntz, c date")
    good = convert.write_rows(df, {"A": DATE, "B": ColumnType("TIMESTAMP(6)"), "C": DATE}).good
    cut = moment.replace(microsecond=0)
    assert rows(good) == [(cut, cut, dt.datetime(1989, 10, 4))]
    texts = df.select(*[convert.format_datetime(F.col(c)) for c in "abc"])
    assert rows(texts) == [("1989-10-04 13:14:15", "1989-10-04 13:14:15", "1989-10-04 00:00:00")]


@pytest.mark.parametrize(
    ("type_name", "values"),
    [
        ("string", {"12": 12, "-3": -3, "+4": 4, "1.5": None, "1.0": None, " 1": None, "x": None,
                    "9223372036854775807": (1 << 63) - 1, "9223372036854775808": None}),
        ("double", {12.0: 12, -3.0: -3, 12.5: None, 1e300: None}),
        ("decimal(30,4)", {Decimal("12.0000"): 12, Decimal("12.5000"): None,
                           Decimal("99999999999999999999.0000"): None}),
        ("int", {7: 7}),
    ],
)
def test_numbers_must_be_whole(spark, type_name, values):
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], f"n {type_name}")
    good, rejects = convert.read_rows(df.withColumn("raw", F.col("n")), {"N": NUMBER})
    assert {r.raw: r.n for r in good.collect()} == {
        **{k: v for k, v in values.items() if v is not None},
        None: None,
    }
    assert {r.n for r in rejects.collect()} == {k for k, v in values.items() if v is None}


def test_flags_are_true_for_one_only(spark):
    df = spark.createDataFrame([(1,), (0,), (2,), (-1,), (None,)], "f int")
    good = convert.read_rows(df.withColumn("raw", F.col("f")), {"F": FLAG}).good
    assert {r.raw: r.f for r in good.collect()} == {1: True, 0: False, 2: False, -1: False, None: None}


def test_written_values(spark, rows):
    df = spark.sql(
        """SELECT map('string_val', 'test', 'int_val', '123') AS m,
                  named_struct('string_val', 'test', 'int_val', 123, 'bool_val', true) AS s,
                  array(123, 4) AS a, true AS yes, false AS no, cast(null as boolean) AS none,
                  'text' AS t, 'Grüße' AS b, parse_json('[123,true,"a<b"]') AS v, 5 AS flag_number"""
    )
    types = {"YES": FLAG, "NO": FLAG, "NONE": FLAG, "B": ColumnType("BLOB"), "FLAG_NUMBER": FLAG}
    good = convert.write_rows(df, types).good
    assert rows(good) == [
        (
            '{"int_val":"123","string_val":"test"}',
            '{"bool_val":true,"int_val":123,"string_val":"test"}',
            "[123,4]",
            1,
            0,
            None,
            "text",
            bytearray("Grüße".encode()),
            '[123,true,"a\\u003cb"]',
            5,
        )
    ]


def test_wrong_types_fail_while_planning(spark):
    df = spark.sql("SELECT 1 AS n")
    with pytest.raises(TypeError):
        convert.write_rows(df, {"N": DATE})
    with pytest.raises(TypeError):
        convert.write_rows(df, {"N": ColumnType("BLOB")})


def test_object_names(spark):
    names = {
        "users": True, "Users$1": True, "U_#9": True, "A" * 127: True, "A" * 128: False,
        "1users": False, "_users": False, "my table": False, "": False, "käse": False, "users\n": False,
    }
    df = spark.createDataFrame([(n,) for n in names], "n string")
    checked = df.select("n", convert.valid_object_name(F.col("n")).alias("ok"))
    assert {r.n: r.ok for r in checked.collect()} == names


def test_upper_names_refuses_names_that_become_equal(spark):
    assert convert.upper_names(spark.sql("SELECT 1 AS id, 2 AS userName")).columns == ["ID", "USERNAME"]
    with pytest.raises(ValueError, match="ID"):
        convert.upper_names(spark.sql("SELECT 1 AS id, 2 AS `Id`"))


def test_payload_kinds(spark):
    texts = {
        '{"id":1,"Name":null}': ["ID", "NAME"], "{}": [], "null": [], " null ": [], "": None,
        "[1]": None, "12": None, '"x"': None, '{"a":1': None, "junk": None,
        '{"a":1} x': None, '{"a":1},{"b":1}': None, '{"a":1}]': None, '{"a":1}] {}': None,
        "{'a':1}": None, '{"a":NaN}': None, '[{"a":1}]': None, ' {"a":1} ': ["A"],
    }
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    parsed = df.select("t", jsontext.object_names(jsontext.parse_object(F.col("t"))).alias("names"))
    assert {r.t: r.names for r in parsed.collect()} == texts


def test_a_hash_of_the_text_is_no_name_for_the_parser(spark):
    """A JSON parser keeps every name it meets: one of its own for each text made parsing slower with every row."""
    df = spark.createDataFrame([('{"a":1}',)], "t string").select(jsontext.parse_object(F.col("t")))
    assert ',{"":' in df._jdf.queryExecution().optimizedPlan().toString()
    texts = ['{"":5}', '{},{"":5}', '{}', '{"a":1}]', '{"a":1},{"":1}],[{}', "", None, "null"]
    found = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select(
        "i", jsontext.object_names(jsontext.parse_object(F.col("t"))).alias("names")
    )
    assert {r.i: r.names for r in found.collect()} == {0: [""], 1: None, 2: [], 3: None, 4: None, 5: None, 6: None, 7: []}
