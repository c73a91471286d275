"""Text cleaning and normalisation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def clean_text(col: Column | str) -> Column:
    """Collapse runs of blanks to one space, trim, and map '' to NULL."""
    collapsed = F.trim(F.regexp_replace(_c(col), r"\s+", " "))
    return F.nullif(collapsed, F.lit(""))


def clean_email(col: Column | str) -> Column:
    """Emails: no blanks at all, lower case, '' -> NULL."""
    return F.nullif(F.lower(F.regexp_replace(_c(col), r"\s+", "")), F.lit(""))


def clean_key_text(col: Column | str) -> Column:
    """Codes such as an order status: cleaned and upper-cased."""
    return F.upper(clean_text(col))
