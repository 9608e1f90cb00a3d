"""Calendar functions of the date dimension."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_key(c: Column) -> Column:
    """TO_CHAR(d, 'YYYYMMDD')::integer, as arithmetic (no string round trip)."""
    d = F.to_date(c)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("bigint")


def day_of_week(c: Column) -> Column:
    """EXTRACT(DOW): Sunday = 0 .. Saturday = 6."""
    return (F.dayofweek(F.to_date(c)) - 1).cast("int")


def iso_week(c: Column) -> Column:
    """EXTRACT(WEEK): ISO-8601 week number (1 Jan can be week 52/53)."""
    return F.weekofyear(F.to_date(c)).cast("int")


def calendar_columns(day: Column) -> list[Column]:
    """All columns of one dim_date row for the day ``day``."""
    d = F.to_date(day)
    return [
        date_key(d).alias("date_key"),
        d.alias("date"),
        day_of_week(d).alias("day_of_week"),
        iso_week(d).alias("week"),
        F.month(d).cast("int").alias("month"),
        F.quarter(d).cast("int").alias("quarter"),
        F.year(d).cast("int").alias("year"),
    ]
