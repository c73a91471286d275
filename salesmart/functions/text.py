"""Render typed values as invariant text for staging, and text defaults."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

DATE_TEXT = "yyyy-MM-dd"
# seven fraction digits as in the staging tables; Spark holds microseconds, so the
# seventh digit is always 0
TIMESTAMP_TEXT = "yyyy-MM-dd HH:mm:ss.SSSSSSS"


def as_text(col: Column, dtype: T.DataType) -> Column:
    """Invariant text of a typed value (null stays null)."""
    if isinstance(dtype, T.DateType):
        return F.date_format(col, DATE_TEXT)
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return F.date_format(col, TIMESTAMP_TEXT)
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        # never render a double (1.23E7); callers declare money as decimal
        raise TypeError("floating point values are not staged as text; use a decimal type")
    return col.cast("string")


def empty_if_null(col: Column | str) -> Column:
    """String members default to the empty string."""
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(c, F.lit(""))
