"""Dates in four text formats, and the attributes of the date dimension."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillroll.functions.text import strip

# A day may be written with a space instead of a leading zero when a separator comes before it.
# There is no year 0, but Spark has one.
_YEAR_FIRST = r"^(?!0000)[0-9]{4}-[0-9]{1,2}-(?:[0-9]{1,2}| [1-9])$"
_DAY_FIRST = r"^([0-9]{1,2})/([0-9]{1,2})/([0-9]{4})$"
_MONTH_FIRST = r"^([0-9]{1,2})-([0-9]{1,2}| [1-9])-([0-9]{4})$"
_MONTH_NAME = r"^[0-9]{1,2}-[A-Za-z]{3}-(?!0000)[0-9]{4}$"


def year_first(text: Column) -> Column:
    """D1, first half: trimmed d/M/yyyy and M-d-yyyy texts rewritten to yyyy-M-d, others unchanged.

    No text matches both patterns; the separator tells which one it may.
    """
    day_first = F.regexp_replace(text, _DAY_FIRST, "$3-$2-$1")
    return F.when(text.contains("/"), day_first).otherwise(F.regexp_replace(text, _MONTH_FIRST, "$3-$1-$2"))


def parse_year_first(text: Column) -> Column:
    """D1, second half: yyyy-M-d and d-MMM-yyyy, null for anything else.

    A cast reports a bad date as null, where a formatter throws and catches an exception; so only
    texts of the right shape get to the formatter.
    """
    numeric = F.when(text.rlike(_YEAR_FIRST), F.replace(text, F.lit(" "), F.lit(""))).try_cast("date")
    named = F.try_to_date(F.when(text.rlike(_MONTH_NAME), text), "d-MMM-yyyy")
    return F.coalesce(numeric, named)


def parse_order_date(c: Column) -> Column:
    """Yyyy-M-d, d/M/yyyy, M-d-yyyy or d-MMM-yyyy, trimmed; anything else is null."""
    return parse_year_first(year_first(strip(c)))


def date_key(d: Column) -> Column:
    """YYYYMMDD."""
    return (F.year(d) * 10000 + F.month(d) * 100 + F.day(d)).cast("int")


def date_attributes(d: Column) -> list[Column]:
    """The columns of the date dimension."""
    return [
        date_key(d).alias("date_key"),
        d.alias("full_date"),
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.day(d).alias("day"),
        F.date_format(d, "EEEE").alias("weekday_name"),
    ]


def iso_date(d: Column) -> Column:
    """For text sinks."""
    return F.date_format(d, "yyyy-MM-dd")
