"""Convert staged text safely, clean it, and split accepted from rejected.

Every ``convert_*`` function returns the typed columns plus ``reject_reason`` (NULL
for an accepted row); ``accepted``/``rejected`` split on it.  Reasons name the first
rule a row breaks.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.clean import clean_email, clean_key_text, clean_text
from ..functions.convert import to_date_safe, to_int, to_long, to_money, to_timestamp_safe

REASON = "reject_reason"


def _reason(*rules: tuple[Column, str]) -> Column:
    expr = None
    for bad, text in rules:
        expr = F.when(bad, F.lit(text)) if expr is None else expr.when(bad, F.lit(text))
    return expr.otherwise(F.lit(None).cast("string"))


def order_detail_values() -> dict[str, Column]:
    """Typed values of a staged order line (from its text columns)."""
    return {"OrderID": to_int("OrderID"), "ProductID": to_int("ProductID"),
            "Quantity": to_int("Quantity"), "TotalPrice": to_money("TotalPrice")}


def order_detail_reason() -> Column:
    """F1 for order lines: the first rule the staged text breaks (NULL if none)."""
    v = order_detail_values()
    return _reason((v["OrderID"].isNull(), "OrderID not an integer"),
                   (v["ProductID"].isNull(), "ProductID not an integer"),
                   (v["Quantity"].isNull(), "Quantity not an integer"),
                   (v["TotalPrice"].isNull(), "TotalPrice not a decimal"),
                   (v["Quantity"] <= 0, "Quantity not positive"),
                   (v["TotalPrice"] < 0, "TotalPrice negative"))


def convert_order_details(staged: DataFrame, *keep: Column) -> DataFrame:
    """Staged order lines -> OrderID, ProductID, Quantity, TotalPrice (+ reason)."""
    return staged.select(*keep, *[c.alias(n) for n, c in order_detail_values().items()],
                         order_detail_reason().alias(REASON))


def convert_orders(staged: DataFrame, *keep: Column) -> DataFrame:
    """Staged orders -> OrderID, CustomerID, OrderDate, Status (cleaned, upper case)."""
    oid, cid = to_int("OrderID"), to_int("CustomerID")
    odate, status = to_date_safe("OrderDate"), clean_key_text("Status")
    return staged.select(
        *keep,
        oid.alias("OrderID"), cid.alias("CustomerID"), odate.alias("OrderDate"),
        status.alias("Status"),
        _reason((oid.isNull(), "OrderID not an integer"),
                (cid.isNull(), "CustomerID not an integer"),
                (odate.isNull(), "OrderDate not a date")).alias(REASON))


def convert_db_orders(staged: DataFrame, *keep: Column) -> DataFrame:
    """Staged relational orders (source names) -> canonical typed columns."""
    oid, cid = to_int("PedidoId"), to_int("ClienteId")
    odate, status = to_date_safe("FechaPedido"), clean_key_text("Estado")
    created = to_timestamp_safe("FechaCreacion")
    return staged.select(
        *keep,
        oid.alias("OrderID"), cid.alias("CustomerID"), odate.alias("OrderDate"),
        status.alias("Status"), created.alias("CreatedAt"),
        _reason((oid.isNull(), "OrderID not an integer"),
                (cid.isNull(), "CustomerID not an integer"),
                (odate.isNull(), "OrderDate not a date")).alias(REASON))


def convert_db_order_details(staged: DataFrame) -> DataFrame:
    did, oid, pid = to_long("DetallePedidoId"), to_int("PedidoId"), to_int("ProductoId")
    qty, unit, total = to_int("Cantidad"), to_money("PrecioUnitario"), to_money("PrecioTotal")
    return staged.select(
        did.alias("OrderDetailID"), oid.alias("OrderID"), pid.alias("ProductID"),
        qty.alias("Quantity"), unit.alias("UnitPrice"), total.alias("TotalPrice"),
        to_timestamp_safe("FechaCreacion").alias("CreatedAt"),
        _reason((oid.isNull(), "OrderID not an integer"),
                (pid.isNull(), "ProductID not an integer"),
                (qty.isNull(), "Quantity not an integer"),
                (total.isNull(), "TotalPrice not a decimal")).alias(REASON))


def convert_customers(staged: DataFrame, *keep: Column) -> DataFrame:
    """Staged customers -> customer_id + cleaned attributes."""
    cid = to_int("CustomerID")
    return staged.select(
        *keep,
        cid.alias("customer_id"),
        clean_text("FirstName").alias("first_name"),
        clean_text("LastName").alias("last_name"),
        clean_email("Email").alias("email"),
        clean_text("Phone").alias("phone"),
        clean_text("City").alias("city"),
        clean_text("Country").alias("country"),
        _reason((cid.isNull(), "CustomerID not an integer")).alias(REASON))


def convert_products(staged: DataFrame, *keep: Column) -> DataFrame:
    """Staged products (CSV or API) -> product_id + cleaned attributes."""
    pid, price, stock = to_int("ProductID"), to_money("Price"), to_int("Stock")
    price_text, stock_text = F.trim(F.col("Price")), F.trim(F.col("Stock"))
    return staged.select(
        *keep,
        pid.alias("product_id"),
        clean_text("ProductName").alias("product_name"),
        clean_text("Category").alias("category"),
        price.alias("price"),
        stock.alias("stock"),
        _reason((pid.isNull(), "ProductID not an integer"),
                (price.isNull() & (F.coalesce(price_text, F.lit("")) != ""), "Price not a decimal"),
                (price < 0, "Price negative"),
                (stock.isNull() & (F.coalesce(stock_text, F.lit("")) != ""), "Stock not an integer")).alias(REASON))


def raw_rejects(staged: DataFrame, convert: Callable[..., DataFrame]) -> DataFrame:
    """the staged text of every row that ``convert`` rejects, with the reason."""
    raw = F.struct(*staged.columns).alias("raw")
    return rejected(convert(staged, raw)).select("raw.*", REASON)


def accepted(converted: DataFrame) -> DataFrame:
    return converted.filter(F.col(REASON).isNull()).drop(REASON)


def rejected(converted: DataFrame) -> DataFrame:
    return converted.filter(F.col(REASON).isNotNull())
