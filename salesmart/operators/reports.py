"""Sales indicators: one rollup per fact axis over the fact and its dimensions.

Sums aggregate partially before the shuffle; distinct order counts use Spark's
two-level distinct aggregation, so a hot group (one month with a third of the sales)
is pre-aggregated on every map task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .lookups import SMALL_DIM_ROWS, WIDE_DIM_ROWS, bounded_broadcast


def _measures():
    return [F.countDistinct("order_number").cast("bigint").alias("n_orders"),
            F.sum("quantity").cast("bigint").alias("quantity"),
            F.sum("total_amount").alias("amount")]


def _by(fact: DataFrame, dim: DataFrame, key: str, attrs: list[str], max_rows: int) -> DataFrame:
    # the dimension is broadcast when its size is within the bound (no shuffle of the
    # fact for the join); the rollup then aggregates partially before its shuffles
    d = bounded_broadcast(dim.select(key, *attrs), max_rows)
    return (fact.select(key, "order_number", "quantity", "total_amount")
            .join(d, key, "left").groupBy(*attrs).agg(*_measures()))


def sales_by_month(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    return _by(fact, dim_date, "date_key", ["year", "month"], SMALL_DIM_ROWS)


def sales_by_category(fact: DataFrame, dim_product: DataFrame) -> DataFrame:
    return _by(fact, dim_product, "product_key", ["category"], WIDE_DIM_ROWS)


def sales_by_country(fact: DataFrame, dim_customer: DataFrame) -> DataFrame:
    return _by(fact, dim_customer, "customer_key", ["country"], WIDE_DIM_ROWS)


def sales_by_status(fact: DataFrame, dim_status: DataFrame) -> DataFrame:
    return _by(fact, dim_status, "status_key", ["status"], SMALL_DIM_ROWS)


def top_customers(fact: DataFrame, dim_customer: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` customers with the highest amount (ties: lower customer id first)."""
    per = fact.groupBy("customer_key").agg(*_measures())
    d = dim_customer.select("customer_key", "customer_id", "first_name", "last_name", "country")
    return (per.join(d, "customer_key", "left")
            .orderBy(F.col("amount").desc(), F.col("customer_id").asc())
            .limit(k)
            .select("customer_id", "first_name", "last_name", "country",
                    "n_orders", "quantity", "amount"))
