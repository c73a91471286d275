"""Duplicate handling.

Keep-first de-duplication is ``row_number() = 1`` over the duplicate key.  Catalyst
turns it into a partial ``WindowGroupLimit`` *before* the shuffle, so a hot key sends
at most one row per map task across the network.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_first(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def dedup_order_lines(details: DataFrame, by_order: bool = False) -> DataFrame:
    """One line per (OrderID, ProductID); the highest total, then quantity, survives.

    ``by_order`` brings the lines together by order alone: they are sorted once, not on both
    sides of the shuffle, and a join on OrderID that follows needs no shuffle or sort of its
    own.  Only for lines without hot orders (``skew.hot_keys``), whose lines would all go to
    one task."""
    if by_order:
        details = details.repartition("OrderID")
    return keep_first(details, ["OrderID", "ProductID"],
                      [F.col("TotalPrice").desc_nulls_last(), F.col("Quantity").desc_nulls_last()])


def dedup_members(df: DataFrame, keys: list[str], attrs: list[str]) -> DataFrame:
    """One row per natural key; ordering by every attribute fixes the survivor."""
    return keep_first(df, keys, [F.col(a).asc_nulls_first() for a in attrs])


def duplicate_groups(df: DataFrame, keys: list[str]) -> DataFrame:
    """A3/A4: the key groups that occur more than once, with their size ``n``."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
            .filter(F.col("n") > 1))


def duplicate_summary(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row: number of duplicate groups and rows beyond the first in each."""
    g = duplicate_groups(df, keys)
    return g.agg(F.count(F.lit(1)).alias("dup_groups"),
                 F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("bigint").alias("dup_rows"))
