"""Land the stand-in sources as files (CSV, JSON pages, Parquet) in the shared folder.

Each landing is written once per input folder and reused (a committed ``_SUCCESS``
marker shows it is complete); the folder lives under ``spark.checkpoint.dir``.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from .. import fs
from ..session import path_key, scratch_path
from . import standins


def _once(spark: SparkSession, path: str, write) -> str:
    if not fs.committed(spark, path):
        write(path)
    return path


def landing_dir(spark: SparkSession, sf_dir: str) -> str:
    """Named by the state (names, sizes, times) of the input files, so that changed input
    is landed anew."""
    state = fs.fingerprint(spark, *[f"{sf_dir.rstrip('/')}/{t}.parquet" for t in standins.TABLE_SCHEMAS])
    return scratch_path(spark, "landing", f"{path_key(sf_dir)}-{state}")


def land_csv(spark: SparkSession, df: DataFrame, path: str) -> str:
    return _once(spark, path, lambda p: df.write.mode("overwrite").option("header", True).csv(p))


def land_parquet(spark: SparkSession, df: DataFrame, path: str) -> str:
    return _once(spark, path, lambda p: df.write.mode("overwrite").parquet(p))


def land_text(spark: SparkSession, df: DataFrame, path: str) -> str:
    return _once(spark, path, lambda p: df.select("value").write.mode("overwrite").text(p))


CSV_SOURCES = {
    "products": standins.products,
    "customers": standins.customers,
    "orders": standins.orders,
    "order_details": standins.order_details,
}
SOURCES = [*CSV_SOURCES, "db_orders", "db_order_details", "api_products"]


def land_all(spark: SparkSession, sf_dir: str) -> dict[str, str]:
    """Land every source for ``sf_dir``, all at once, so that the last tasks of one overlap
    with the others; returns name -> path."""
    root = landing_dir(spark, sf_dir)
    with ThreadPoolExecutor(max_workers=len(SOURCES)) as pool:
        return dict(zip(SOURCES, pool.map(lambda name: _land(spark, sf_dir, root, name), SOURCES)))


def land_one(spark: SparkSession, sf_dir: str, name: str) -> str:
    return _land(spark, sf_dir, landing_dir(spark, sf_dir), name)


def _land(spark: SparkSession, sf_dir: str, root: str, name: str) -> str:
    if name in CSV_SOURCES:
        return land_csv(spark, CSV_SOURCES[name](spark, sf_dir), f"{root}/csv/{name}")
    if name == "db_orders":
        return land_parquet(spark, standins.db_orders_table(spark, sf_dir), f"{root}/db/orders")
    if name == "db_order_details":
        return land_parquet(spark, standins.db_order_details_table(spark, sf_dir),
                            f"{root}/db/order_details")
    if name == "api_products":
        return land_text(spark, standins.api_pages(spark, sf_dir), f"{root}/api/pages")
    raise KeyError(name)
