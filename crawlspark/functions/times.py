"""Dates of fetched pages. Results do not depend on the session time zone."""

from pyspark.sql import Column
from pyspark.sql import functions as F

_WEEKDAY = r"^(?i)\s*(?:mon|tue|wed|thu|fri|sat|sun)[a-z]*, *(.+)$"


def http_date_millis(text: Column) -> Column:
    """`Tue, 30 Aug 2016 18:00:00 GMT` as epoch milliseconds; null where it does not parse."""
    # Spark does not parse weekday names, so the weekday is checked and cut off first.
    rest = F.regexp_extract(F.coalesce(text, F.lit("")), _WEEKDAY, 1)
    named_zone = F.try_to_timestamp(rest, F.lit("d MMM yyyy HH:mm:ss z"))
    numeric_zone = F.try_to_timestamp(rest, F.lit("d MMM yyyy HH:mm:ss Z"))
    return F.unix_millis(F.coalesce(named_zone, numeric_zone))


def http_date_text(text: Column) -> Column:
    """`http_date_millis` as text, the form dumped documents carry."""
    return http_date_millis(text).cast("string")


def clock(millis: Column) -> Column:
    """Time of day as `18:00:00`."""
    second_of_day = F.floor(F.pmod(millis, F.lit(86_400_000)) / 1000).cast("int")

    def two_digits(value: Column) -> Column:
        return F.lpad(value.cast("int").cast("string"), 2, "0")

    return F.concat_ws(
        ":",
        two_digits(F.floor(second_of_day / 3600)),
        two_digits(F.pmod(F.floor(second_of_day / 60), F.lit(60))),
        two_digits(F.pmod(second_of_day, F.lit(60))),
    )


def _day(millis: Column) -> Column:
    return F.date_from_unix_date(F.floor(millis / 86_400_000).cast("int")).cast("string")


def index_time(millis: Column) -> Column:
    """Epoch milliseconds as `2016-08-30T18:00:00Z`."""
    return F.concat(_day(millis), F.lit("T"), clock(millis), F.lit("Z"))


def plain_time(millis: Column) -> Column:
    """Epoch milliseconds as `2016-08-30 18:00:00`."""
    return F.concat(_day(millis), F.lit(" "), clock(millis))
