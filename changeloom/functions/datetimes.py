"""Reading and writing date text.

A date string is accepted when it has one of a fixed list of layouts. The written wall clock is
kept: zones and offsets are checked for form and then left aside, and fractions of a second are
cut. Every layout is one regular expression, so no parser exception is raised per row and per
layout, and the whole expression stays on the JVM.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

from changeloom.functions.binding import bound

# English month and weekday names in the accepted layouts (any letter case).
MONTHS = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]
WEEKDAYS = ["Sun", "Mon", "Tue", "Wed", "Thu", "Fri", "Sat"]
LONG_WEEKDAYS = ["Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday"]

# Two-digit years from here on belong to the twentieth century.
CENTURY_PIVOT = 69

_MONTH = "((?i:" + "|".join(MONTHS) + "))"
_WEEKDAY = "(?i:" + "|".join(WEEKDAYS) + ")"
_LONG_WEEKDAY = "(?i:" + "|".join(LONG_WEEKDAYS) + ")"
_CLOCK = r"(\d{1,2}):(\d{2}):(\d{2})(?:[.,]\d+)?"
_OFFSET = r"[+-](?:[01]\d|2[0-4])(?:[0-5]\d|60)"
_OFFSET_COLON = r"(?:Z|[+-](?:[01]\d|2[0-4]):(?:[0-5]\d|60))"
# GMT with an optional hour offset, a bare hour offset, or an abbreviation of three to five letters.
_HOURS = r"[+-](?:[01]\d|2[0-3]|\d)"
_ZONE = rf"(?:GMT{_HOURS}|{_HOURS}|ChST|MeST|[A-Z]{{4}}T|[A-Z]{{3}}T|WITA|[A-Z]{{3}})"


class Layout(NamedTuple):
    """A date layout: its pattern and the capture group of each part (0 = not in the layout)."""

    name: str
    pattern: str
    year: int
    month: int
    day: int
    hour: int
    minute: int
    second: int = 0
    half_day: int = 0


LAYOUTS = [
    Layout("rfc3339", rf"(\d{{4}})-(\d{{2}})-(\d{{2}})T{_CLOCK}{_OFFSET_COLON}", 1, 2, 3, 4, 5, 6),
    Layout(
        "numeric",
        rf"(\d{{2}})/(\d{{2}}) +(\d{{2}}):(\d{{2}}):(\d{{2}})(?:[.,]\d+)?(AM|PM) +'(\d{{2}}) +{_OFFSET}",
        7, 1, 2, 3, 4, 5, 6,
    ),
    Layout("ansic", rf"{_WEEKDAY} +{_MONTH} +(\d{{1,2}}) +{_CLOCK} +(\d{{4}})", 6, 1, 2, 3, 4, 5),
    Layout("unix", rf"{_WEEKDAY} +{_MONTH} +(\d{{1,2}}) +{_CLOCK} +{_ZONE} +(\d{{4}})", 6, 1, 2, 3, 4, 5),
    Layout("ruby", rf"{_WEEKDAY} +{_MONTH} +(\d{{2}}) +{_CLOCK} +{_OFFSET} +(\d{{4}})", 6, 1, 2, 3, 4, 5),
    Layout("rfc822", rf"(\d{{2}}) +{_MONTH} +(\d{{2}}) +(\d{{1,2}}):(\d{{2}}) +(?:{_ZONE}|{_OFFSET})", 3, 2, 1, 4, 5),
    Layout("rfc850", rf"{_LONG_WEEKDAY}, +(\d{{2}})-{_MONTH}-(\d{{2}}) +{_CLOCK} +{_ZONE}", 3, 2, 1, 4, 5, 6),
    Layout(
        "rfc1123",
        rf"{_WEEKDAY}, +(\d{{2}}) +{_MONTH} +(\d{{4}}) +{_CLOCK} +(?:{_ZONE}|{_OFFSET})",
        3, 2, 1, 4, 5, 6,
    ),
]


def _whole(layout: Layout) -> str:
    return rf"^{layout.pattern}\z"


def _parts(text: Column) -> Column:
    """Year, month, day, hour, minute, second and half day as written, in one order; else NULL."""
    found = F.lit(None).cast("string")
    for layout in reversed(LAYOUTS):
        groups = layout[2:]
        in_order = "|".join(f"${group}" if group else "" for group in groups)
        found = F.when(
            text.rlike(_whole(layout)), F.regexp_replace(text, _whole(layout), in_order)
        ).otherwise(found)
    return F.split(found, r"\|")


def _wall_clock(parts: Column) -> Column:
    def number(index: int) -> Column:
        return parts[index].cast("int")

    # Only digits are cast: a cast that fails costs far more than the rest of the parsing.
    century = F.when(F.length(parts[0]) == 4, 0).when(number(0) >= CENTURY_PIVOT, 1900).otherwise(2000)
    place = F.instr(F.lit("".join(MONTHS).upper()), F.upper(parts[1]))
    month = F.when(F.length(parts[1]) == 2, number(1)).otherwise(F.floor((place + 2) / 3).cast("int"))
    half_day = parts[6]
    hour = F.when(half_day == "", number(3)).when(
        number(3) <= 12, number(3) % 12 + F.when(half_day == "PM", 12).otherwise(0)
    )
    second = F.when(parts[5] == "", 0).otherwise(number(5))
    # Second 60 would roll over into the next minute, so it is checked here.
    return F.when(
        second < 60,
        F.try_make_timestamp_ntz(number(0) + century, month, number(2), hour, number(4), second),
    )


def parse_datetime(text: Column) -> Column:
    """The wall clock written in ``text``, to the second; NULL when no layout fits.

    Text without a year (clock or stamp layouts) names no storable date and gives NULL too.
    """
    return bound(text, lambda t: bound(_parts(t), _wall_clock))


def format_datetime(value: Column) -> Column:
    """Date and time text ``yyyy-MM-dd HH:mm:ss``; fractions of a second are cut.

    The text of a zone-less timestamp is used, so no session time zone can move the wall clock.
    """
    return F.substring_index(value.cast("timestamp_ntz").cast("string"), ".", 1)


def truncate_to_second(value: Column) -> Column:
    wall_clock = value.cast("timestamp_ntz")
    fraction = F.date_part(F.lit("SECOND"), wall_clock) % 1
    return wall_clock - F.make_dt_interval(secs=fraction)
