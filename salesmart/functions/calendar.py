"""Calendar attributes of a date."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_key(col: Column | str) -> Column:
    """yyyymmdd as an int."""
    d = F.col(col) if isinstance(col, str) else col
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def calendar_columns(col: Column | str) -> list[Column]:
    """The date-dimension columns for date ``col`` (Sunday = 1 in day_of_week)."""
    d = F.col(col) if isinstance(col, str) else col
    dow = F.dayofweek(d)
    return [
        date_key(d).alias("date_key"),
        d.alias("date"),
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.dayofmonth(d).alias("day"),
        dow.alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.weekofyear(d).alias("week_of_year"),
        dow.isin(1, 7).alias("is_weekend"),
    ]
