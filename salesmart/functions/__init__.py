"""Column expressions (JVM built-ins only; no Python UDFs)."""

from .text import as_text, empty_if_null  # noqa: F401
from .convert import to_int, to_long, to_money, to_date_safe, to_timestamp_safe, unit_price  # noqa: F401
from .clean import clean_text, clean_email, clean_key_text  # noqa: F401
from .calendar import date_key, calendar_columns  # noqa: F401
