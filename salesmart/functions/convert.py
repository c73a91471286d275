"""T8, T9 (P5, P6): safe conversion of staged text and the unit sale price."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import DATE_FORMATS, MONEY_SQL


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def to_int(col: Column | str) -> Column:
    """Text -> int; anything that does not convert gives NULL."""
    return _c(col).try_cast("int")


def to_long(col: Column | str) -> Column:
    return _c(col).try_cast("bigint")


def to_money(col: Column | str) -> Column:
    """Text -> decimal(18,2).  Thousands separators are removed first."""
    return F.replace(_c(col), F.lit(","), F.lit("")).try_cast(MONEY_SQL)


def to_date_safe(col: Column | str, formats: list[str] | None = None) -> Column:
    """Text -> date, trying each format; impossible dates (2024-02-30) give NULL."""
    c = F.trim(_c(col))
    return F.coalesce(*[F.try_to_date(c, f) for f in (formats or DATE_FORMATS)])


def to_timestamp_safe(col: Column | str) -> Column:
    """Staged ``yyyy-MM-dd HH:mm:ss.fffffff`` text -> timestamp (microseconds)."""
    c = F.trim(_c(col))
    # the seventh fraction digit is below Spark's resolution: drop it before parsing
    c = F.regexp_replace(c, r"^(.*\.\d{6})\d$", "$1")
    return F.try_to_timestamp(c).cast("timestamp_ntz")


def unit_price(total: Column | str, quantity: Column | str) -> Column:
    """Unit sale price = total / quantity, half-up to 2 places; zero quantity -> NULL."""
    q = _c(quantity).cast("decimal(10,0)")
    return F.try_divide(_c(total), q).cast(MONEY_SQL)
