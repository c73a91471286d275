"""Declared schemas, source keys and the fixed values of the warehouse model."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)
MONEY_SQL = "decimal(18,2)"

# --- fixed values -------------------------------------------------------------
# Member key of the "unknown" row in every dimension (the date dimension included).
UNKNOWN_KEY = -1
UNKNOWN_TEXT = "UNKNOWN"

# Data sources (dimension D1): key, name, type.  Key -1 is the unknown member.
SOURCE_CSV = 1
SOURCE_DB = 2
SOURCE_API = 3
SOURCES = [
    (SOURCE_CSV, "CSV", "file"),
    (SOURCE_DB, "DATABASE", "relational"),
    (SOURCE_API, "API", "rest"),
]

# Load states written to the load-control table.
STATE_STARTED = "STARTED"
STATE_COMPLETED = "COMPLETED"
STATE_COMPLETED_WITH_ERRORS = "COMPLETED_WITH_ERRORS"
STATE_FAILED = "FAILED"

# Date text formats accepted in CSV files and staging, tried in this order: ISO dates and
# the invariant month/day/year form, each with or without a time of day.
DATE_FORMATS = ["yyyy-MM-dd", "M/d/yyyy", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss", "M/d/yyyy HH:mm:ss"]
# -----------------------------------------------------------------------------


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# Typed source records (canonical column names), bound by name at extract.
PRODUCT = _struct(("ProductID", T.IntegerType()), ("ProductName", T.StringType()),
                  ("Category", T.StringType()), ("Price", MONEY), ("Stock", T.IntegerType()))
CUSTOMER = _struct(("CustomerID", T.IntegerType()), ("FirstName", T.StringType()),
                   ("LastName", T.StringType()), ("Email", T.StringType()),
                   ("Phone", T.StringType()), ("City", T.StringType()),
                   ("Country", T.StringType()))
ORDER = _struct(("OrderID", T.IntegerType()), ("CustomerID", T.IntegerType()),
                ("OrderDate", T.DateType()), ("Status", T.StringType()))
ORDER_DETAIL = _struct(("OrderID", T.IntegerType()), ("ProductID", T.IntegerType()),
                       ("Quantity", T.IntegerType()), ("TotalPrice", MONEY))
HIST_ORDER = _struct(("OrderID", T.IntegerType()), ("CustomerID", T.IntegerType()),
                     ("OrderDate", T.DateType()), ("Status", T.StringType()),
                     ("CreatedAt", T.TimestampNTZType()))
HIST_ORDER_DETAIL = _struct(("OrderDetailID", T.LongType()), ("OrderID", T.IntegerType()),
                            ("ProductID", T.IntegerType()), ("Quantity", T.IntegerType()),
                            ("UnitPrice", MONEY), ("TotalPrice", MONEY),
                            ("CreatedAt", T.TimestampNTZType()))

# --- fixed values: column names of the modelled sources and staging tables ------------
# These must equal the modelled system's names (relational source columns, JSON field
# names, staging columns); they are listed in their natural order.

# Relational source column names (source language) -> canonical names.
DB_ORDER_COLUMNS = {
    "PedidoId": "OrderID", "ClienteId": "CustomerID", "FechaPedido": "OrderDate",
    "Estado": "Status", "FechaCreacion": "CreatedAt",
}
DB_ORDER_DETAIL_COLUMNS = {
    "DetallePedidoId": "OrderDetailID", "PedidoId": "OrderID", "ProductoId": "ProductID",
    "Cantidad": "Quantity", "PrecioUnitario": "UnitPrice", "PrecioTotal": "TotalPrice",
    "FechaCreacion": "CreatedAt",
}

# JSON product feed: the envelope and its element (bound by JSON field name).  Numbers
# are read as text and cast strictly afterwards, so both 5 and "5" are accepted (as the
# web defaults of the modelled client do) while junk still fails the load.
API_ITEM = _struct(("id", T.StringType()), ("title", T.StringType()),
                   ("category", T.StringType()), ("price", T.StringType()),
                   ("stock", T.StringType()))
API_ITEM_TYPES = {"id": T.IntegerType(), "price": MONEY, "stock": T.IntegerType()}
API_ENVELOPE = T.StructType([
    T.StructField("products", T.ArrayType(API_ITEM), True),
    T.StructField("total", T.IntegerType(), True),
    T.StructField("skip", T.IntegerType(), True),
    T.StructField("limit", T.IntegerType(), True),
])
API_FIELDS = {"id": "ProductID", "title": "ProductName", "category": "Category",
              "price": "Price", "stock": "Stock"}

# Staging tables: every column is text, column names as in the staging schema.
STAGING_COLUMNS = {
    "products": ["ProductID", "ProductName", "Category", "Price", "Stock"],
    "customers": ["CustomerID", "FirstName", "LastName", "Email", "Phone", "City", "Country"],
    "orders": ["OrderID", "CustomerID", "OrderDate", "Status"],
    "order_details": ["OrderID", "ProductID", "Quantity", "TotalPrice"],
    "db_orders": ["PedidoId", "ClienteId", "FechaPedido", "Estado", "FechaCreacion"],
    "db_order_details": ["DetallePedidoId", "PedidoId", "ProductoId", "Cantidad",
                         "PrecioUnitario", "PrecioTotal", "FechaCreacion"],
    "api_products": ["ProductID", "ProductName", "Category", "Price", "Stock"],
}
# --- end of fixed values --------------------------------------------------------------

# Warehouse column lists (our choice: the modelled table definitions are unpublished).
DIM_SOURCE_COLUMNS = ["source_key", "source_name", "source_type"]
DIM_STATUS_COLUMNS = ["status_key", "status"]
DIM_DATE_COLUMNS = ["date_key", "date", "year", "quarter", "month", "month_name", "day",
                    "day_of_week", "day_name", "week_of_year", "is_weekend"]
DIM_CUSTOMER_ATTRS = ["first_name", "last_name", "email", "phone", "city", "country"]
DIM_CUSTOMER_COLUMNS = ["customer_key", "source_key", "customer_id", *DIM_CUSTOMER_ATTRS]
DIM_PRODUCT_ATTRS = ["product_name", "category", "price", "stock"]
DIM_PRODUCT_COLUMNS = ["product_key", "source_key", "product_id", *DIM_PRODUCT_ATTRS]
FACT_COLUMNS = ["date_key", "customer_key", "product_key", "status_key", "source_key",
                "order_number", "quantity", "unit_price", "total_amount"]
LOAD_CONTROL = T.StructType([
    T.StructField("run_id", T.StringType(), False),
    T.StructField("source", T.StringType(), True),
    T.StructField("process", T.StringType(), False),
    T.StructField("started_at", T.TimestampType(), True),
    T.StructField("ended_at", T.TimestampType(), True),
    T.StructField("state", T.StringType(), False),
    T.StructField("rows_read", T.LongType(), True),
    T.StructField("rows_inserted", T.LongType(), True),
    T.StructField("rows_updated", T.LongType(), True),
    T.StructField("rows_rejected", T.LongType(), True),
    T.StructField("error_message", T.StringType(), True),
    # reported for the fact load: lines dropped as duplicates, keys resolved to unknown
    T.StructField("rows_duplicated", T.LongType(), True),
    T.StructField("unknown_keys", T.LongType(), True),
    # K10, for the fact load: rows of the replaced version, and rows left by the clean
    T.StructField("rows_before_clean", T.LongType(), True),
    T.StructField("rows_after_clean", T.LongType(), True),
])
