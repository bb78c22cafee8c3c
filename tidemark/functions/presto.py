"""Date and cast helpers under the names report authors know from Presto SQL."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from .clean import _col


def from_iso8601_timestamp(c) -> Column:
    return F.try_to_timestamp(_col(c))


def from_iso8601_date(c) -> Column:
    return _col(c).try_cast("date")


def from_unixtime(c) -> Column:
    return F.timestamp_seconds(_col(c))


def to_iso8601(c) -> Column:
    """UTC text, whatever the session's time zone."""
    return F.date_format(F.to_utc_timestamp(_col(c), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def to_unixtime(c) -> Column:
    return F.unix_timestamp(_col(c).cast("timestamp"))


def complete_months(start, end) -> Column:
    """Complete months between two dates, negative when they are swapped.

    A month is complete at the same day number or at the end of a shorter month, so
    30 January to 28 February is one month (`months_between` would say less than one).
    """
    start, end = _col(start), _col(end)
    low, high = F.least(start, end), F.greatest(start, end)
    index = lambda d: F.year(d) * 12 + F.month(d)
    short = (F.dayofmonth(high) < F.dayofmonth(low)) & (high != F.last_day(high))
    months = index(high) - index(low) - F.when(short, 1).otherwise(0)
    return F.when(start.isNull() | end.isNull(), None).when(end < start, -months).otherwise(months)


def date_of(year, month, day) -> Column:
    """A date from numbers, null when there is no such day."""
    text = F.concat_ws("-", _col(year).cast("string"), _col(month).cast("string"), _col(day).cast("string"))
    return F.when(_col(year).isNotNull() & _col(month).isNotNull(), text.try_cast("date"))


def iso_year(c) -> Column:
    return F.extract(F.lit("YEAROFWEEK"), _col(c))


def iso_week(c) -> Column:
    return F.extract(F.lit("WEEK"), _col(c))


def iso_period(c) -> Column:
    """ISO year and zero-padded ISO week as one sortable text."""
    return F.concat(iso_year(c).cast("string"), F.lpad(iso_week(c).cast("string"), 2, "0"))


SQL_FUNCTIONS = {
    "from_iso8601_timestamp": ("x STRING", "TIMESTAMP", "try_to_timestamp(x)"),
    "from_iso8601_date": ("x STRING", "DATE", "try_cast(x AS DATE)"),
    "to_iso8601": ("x TIMESTAMP", "STRING", "date_format(to_utc_timestamp(x, current_timezone()), \"yyyy-MM-dd'T'HH:mm:ss'Z'\")"),
    "to_unixtime": ("x TIMESTAMP", "BIGINT", "unix_timestamp(x)"),
    "from_epoch": ("x BIGINT", "TIMESTAMP", "timestamp_seconds(x)"),
}


def register_sql_functions(spark: SparkSession) -> list[str]:
    """Make the helpers callable from SQL text; they inline into the plan as built-ins."""
    for name, (argument, result, body) in SQL_FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({argument}) RETURNS {result} RETURN {body}")
    return sorted(SQL_FUNCTIONS)
