"""Time functions: 14-digit timestamps, ISO text and the comparison by the first differing field."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_ts14(c: Column) -> Column:
    """12 digits get seconds 00, 16 are cut to 14; null if it isn't a time then."""
    digits = F.when(F.length(c) == 12, F.concat(c, F.lit("00"))).when(F.length(c) == 16, F.substring(c, 1, 14)).otherwise(c)
    return F.when(digits.rlike("^[0-9]{14}$"), F.try_to_timestamp(digits, F.lit("yyyyMMddHHmmss"))).cast("timestamp_ntz")


def format_ts14(ts: Column) -> Column:
    return F.date_format(ts, "yyyyMMddHHmmss")


def iso_to_ts14(c: Column) -> Column:
    """2020-01-01T00:00:00Z -> 20200101000000, fields copied; null if it isn't such a time."""
    digits = F.regexp_replace(F.regexp_extract(c, r"^(\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d)(\.\d+)?Z$", 1), "[-T:]", "")
    return F.when(parse_ts14(digits).isNotNull(), digits)


def iso_text(ts: Column) -> Column:
    """ISO text; seconds are left out if they are 0."""
    return F.when(F.second(ts) == 0, F.date_format(ts, "yyyy-MM-dd'T'HH:mm")).otherwise(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"))


def span_seconds(first: Column, last: Column) -> Column:
    unix = lambda t: F.unix_seconds(t.cast("timestamp"))
    return unix(last) - unix(first)


def magnitude(a: Column, b: Column) -> Column:
    """How far a is from b in the first field of year, month, day that differs; else the sign of the time of day."""
    part = lambda f: f(a) - f(b)
    seconds = lambda t: F.hour(t) * 3600 + F.minute(t) * 60 + F.second(t)
    clock = F.signum((seconds(a) - seconds(b)).cast("double")).cast("int")
    return F.when(part(F.year) != 0, part(F.year)).when(part(F.month) != 0, part(F.month)).when(part(F.day) != 0, part(F.day)).otherwise(clock)
