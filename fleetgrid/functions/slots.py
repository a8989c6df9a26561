"""Dates, clock fields and durations read from `yyyy-MM-dd HH:mm:ss` text.

Well-formed text is read once, as a zone-free timestamp (`with_clocks`). Anything
else takes the slower text path, field by field: a date, an hour and a minute can
each be readable on their own, and a duration accepts unpadded, rolled-over and
negative fields of any length (month 13, hour -1, year 20150).
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_CLOCK = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}(?!\d)"
_LOOSE_CLOCK = (
    r"^[ \t]*(-?\d+)-[ \t]*(-?\d+)-[ \t]*(-?\d+)"
    r" [ \t]*(-?\d+):[ \t]*(-?\d+):[ \t]*(-?\d+)(?!\d)[\s\S]*$"
)


def clock(name: str) -> Column:
    """The column that `with_clocks` adds for text column `name`."""
    return F.col(f"{name}_clock")


def with_clocks(df: DataFrame, *names: str) -> DataFrame:
    """Add each datetime text as a timestamp without zone, null unless well-formed."""
    return df.withColumns({f"{n}_clock": _well_formed(F.col(n)) for n in names})


def _well_formed(text: Column) -> Column:
    return F.when(text.rlike(_CLOCK), F.left(text, F.lit(19)).try_cast("timestamp_ntz"))


def calendar_date(text: Column) -> Column:
    """Date at the start of the text, null if there is none."""
    return text.try_cast("date")


def hour_start(text: Column, clock: Column) -> Column:
    """Hour as written: the number between the first space and the first colon."""
    return F.coalesce(F.hour(clock), _time_field(text, 1))


def minute_start(text: Column, clock: Column) -> Column:
    """First minute of the ten-minute slot."""
    minute = F.coalesce(F.minute(clock), _time_field(text, 2))
    return minute - minute % 10


def _time_field(text: Column, position: int) -> Column:
    time = F.split_part(text, F.lit(" "), F.lit(2))
    return F.split_part(time, F.lit(":"), F.lit(position)).try_cast("int")


def interval_label(start: Column, width: int) -> Column:
    """`7` with width 1 is `7-8`: unpadded text."""
    return F.concat(start, F.lit("-"), start.cast("bigint") + width)


def with_minutes(df: DataFrame, name: str, start: str, end: str) -> DataFrame:
    """Add the whole minutes from text `start` to text `end`, truncated toward zero.

    Expects the columns of `with_clocks`. Times are on the wall clock; the session
    time zone plays no part.
    """
    ends = [_seconds(F.col(at), clock(at)) for at in (end, start)]
    seconds = F.try_subtract(*ends)
    return df.withColumn(name, F.call_function("div", seconds, F.lit(60)))


def _seconds(text: Column, clock: Column) -> Column:
    return F.coalesce(F.unix_timestamp(clock), _loose_seconds(text))


def _loose_seconds(text: Column) -> Column:
    """Seconds since 1970 from fields as written, null for other text or beyond 64 bits.

    The rare path is a higher-order function on purpose. Spark evaluates those
    outside the fused loop, which keeps the loop small enough for the JVM to
    compile, and binds the split fields, which are used often, once.
    """
    fields = F.split(F.regexp_replace(text, _LOOSE_CLOCK, "$1 $2 $3 $4 $5 $6"), " ")
    matched = F.when(text.rlike(_LOOSE_CLOCK), F.array(fields.try_cast("array<bigint>")))
    return F.transform(F.transform(matched, _months_from_march), _rolled_over)[0]


def _floor_div(number: Column, by: int) -> Column:
    return F.call_function("div", F.try_subtract(number, F.pmod(number, F.lit(by))), F.lit(by))


def _total(first: Column, *others: Column) -> Column:
    """The sum, null beyond 64 bits."""
    for other in others:
        first = F.try_add(first, other)
    return first


def _months_from_march(fields: Column) -> Column:
    """The fields with the year and the month counted from March, the month in 0 to 11."""
    month = F.try_subtract(fields[1], F.lit(3))
    year = F.try_add(fields[0], _floor_div(month, 12))
    return F.array(year, F.pmod(month, F.lit(12)), *[fields[i] for i in range(2, 6)])


def _rolled_over(fields: Column) -> Column:
    """Years of the Gregorian calendar, carried back and forth. Leap days end a year that
    starts in March, so they need no case of their own."""
    year, month = fields[0], fields[1]
    leap_days = _total(_floor_div(year, 4), -_floor_div(year, 100), _floor_div(year, 400))
    before_month = F.call_function("div", month * 153 + 2, F.lit(5))
    days = _total(F.try_multiply(year, F.lit(365)), leap_days, before_month, fields[2])
    days = F.try_subtract(days, F.lit(719469))  # to 1970-01-01
    hours = F.try_multiply(fields[3], F.lit(3600))
    minutes = F.try_multiply(fields[4], F.lit(60))
    return _total(F.try_multiply(days, F.lit(86400)), hours, minutes, fields[5])
