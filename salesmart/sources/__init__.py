"""Typed extracts (S1-S9) and the stand-in inputs derived from the test tables."""

from .csv import read_csv, read_products_csv, read_customers_csv, read_orders_csv, read_order_details_csv  # noqa: F401
from .relational import read_relational, read_db_orders, read_db_order_details  # noqa: F401
from .api import read_api_pages  # noqa: F401
