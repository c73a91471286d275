"""Stand-in source data derived from the test tables (see FIXTURES.md §1).

The modelled system reads CSV files, two relational tables and a JSON feed that are
not published.  These functions derive equivalent typed inputs from the TPC-H-like
tables with plain projections and joins, so every query's work grows with the tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import MONEY_SQL


# Schemas of the test tables read here (TESTDATA.md).  Declaring them avoids a
# footer-reading job per read; Parquet still binds columns by name.
TABLE_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
            "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    schema = TABLE_SCHEMAS.get(name)
    return (spark.read.schema(schema) if schema else spark.read).parquet(path)


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV products <- part."""
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("int").alias("ProductID"),
        F.col("p_name").alias("ProductName"),
        F.col("p_type").alias("Category"),
        F.col("p_retailprice").cast(MONEY_SQL).alias("Price"),
        F.col("p_size").cast("int").alias("Stock"))


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV customers <- customer ⋈ nation ⋈ region (nation/region: 25 and 5 rows)."""
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    geo = n.join(r, n.n_regionkey == r.r_regionkey).select("n_nationkey", "n_name", "r_name")
    return (c.join(geo, c.c_nationkey == geo.n_nationkey, "left")
            .select(F.col("c_custkey").cast("int").alias("CustomerID"),
                    F.substring_index("c_name", "#", 1).alias("FirstName"),
                    F.substring_index("c_name", "#", -1).alias("LastName"),
                    F.concat(F.lower(F.replace("c_name", F.lit("#"), F.lit("."))),
                             F.lit("@example.com")).alias("Email"),
                    F.lpad(F.col("c_custkey").cast("string"), 9, "0").alias("Phone"),
                    F.coalesce("n_name", F.lit("")).alias("City"),
                    F.coalesce("r_name", F.lit("")).alias("Country")))


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV orders <- orders."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("int").alias("OrderID"),
        F.col("o_custkey").cast("int").alias("CustomerID"),
        F.to_date("o_orderdate").alias("OrderDate"),
        F.col("o_orderstatus").alias("Status"))


def order_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV order details <- lineitem (duplicates on (order, part) kept, as in the file)."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("int").alias("OrderID"),
        F.col("l_partkey").cast("int").alias("ProductID"),
        F.col("l_quantity").cast("int").alias("Quantity"),
        F.col("l_extendedprice").cast(MONEY_SQL).alias("TotalPrice"))


def _created_at(orderdate: str, orderkey: str):
    return F.expr(f"timestampadd(SECOND, {orderkey} % 86400, {orderdate})").cast("timestamp_ntz")


def db_orders_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Relational orders table (source-language names) <- orders."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("int").alias("PedidoId"),
        F.col("o_custkey").cast("int").alias("ClienteId"),
        F.to_date("o_orderdate").alias("FechaPedido"),
        F.col("o_orderstatus").alias("Estado"),
        _created_at("o_orderdate", "o_orderkey").alias("FechaCreacion"))


def db_order_details_table(spark: SparkSession, sf_dir: str, perturbed: bool = False,
                           dated: bool = True) -> DataFrame:
    """Relational order-line table <- lineitem after de-duplication on (order, part).

    ``perturbed`` is the changed copy used to exercise source reconciliation: lines
    whose id is a multiple of 101 are missing and a multiple of 103 has one more unit.
    ``dated`` takes the creation time from the line's order (a join); without it, it is NULL.
    """
    from ..operators.dedup import dedup_order_lines
    from ..operators.skew import hot_keys
    from ..functions.convert import unit_price

    lines = order_details(spark, sf_dir)
    if dated:
        # no hot orders: de-duplicated and joined in one shuffle of the lines
        lines = dedup_order_lines(lines, by_order=not hot_keys(lines, "OrderID", lines.count()))
        o = table(spark, sf_dir, "orders").select(
            F.col("o_orderkey").cast("int").alias("OrderID"),
            _created_at("o_orderdate", "o_orderkey").alias("FechaCreacion"))
        lines = lines.join(o, "OrderID", "left")
    else:
        lines = dedup_order_lines(lines).withColumn("FechaCreacion", F.lit(None).cast("timestamp_ntz"))
    detail_id = (F.col("OrderID").cast("bigint") * 1000000 + F.col("ProductID"))
    out = lines.select(
        detail_id.alias("DetallePedidoId"),
        F.col("OrderID").alias("PedidoId"),
        F.col("ProductID").alias("ProductoId"),
        F.col("Quantity").alias("Cantidad"),
        unit_price("TotalPrice", "Quantity").alias("PrecioUnitario"),
        F.col("TotalPrice").alias("PrecioTotal"),
        "FechaCreacion")
    if perturbed:
        out = (out.filter(F.col("DetallePedidoId") % 101 != 0)
               .withColumn("Cantidad", F.when(F.col("DetallePedidoId") % 103 == 0,
                                              F.col("Cantidad") + 1).otherwise(F.col("Cantidad"))))
    return out


def api_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items of the JSON product feed <- part.

    The feed carries every part with an upper-cased title; its ids collide with CSV ids
    on purpose.
    """
    return (table(spark, sf_dir, "part")
            .select(F.col("p_partkey").cast("int").alias("id"),
                    F.upper("p_name").alias("title"),
                    F.col("p_type").alias("category"),
                    F.col("p_retailprice").cast(MONEY_SQL).alias("price"),
                    F.col("p_size").cast("int").alias("stock")))


def api_pages(spark: SparkSession, sf_dir: str, page_size: int = 100) -> DataFrame:
    """Feed pages as JSON text, one envelope per line, ``page_size`` items per page.

    Pages group ids by ``id div page_size``, so a page never holds more than
    ``page_size`` items whatever the table size (bounded ``collect_list``).
    """
    total = table(spark, sf_dir, "part").count()                # Parquet metadata
    items = api_items(spark, sf_dir).withColumn("page", F.floor(F.col("id") / page_size))
    env = (items.groupBy("page")
           .agg(F.sort_array(F.collect_list(F.struct("id", "title", "category", "price", "stock")))
                .alias("products"))
           .select("page", F.to_json(F.struct(
               "products",
               F.lit(total).alias("total"),
               (F.col("page") * page_size).cast("int").alias("skip"),
               F.lit(page_size).alias("limit"))).alias("value")))
    return env
