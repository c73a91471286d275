"""Counts, checks and load-control rows.

Everything here is an aggregate: only one row per table, state or metric is produced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas as S


def count_as(df: DataFrame, name: str, label: str = "name") -> DataFrame:
    return df.agg(F.count(F.lit(1)).cast("bigint").alias("n")).select(
        F.lit(name).alias(label), "n")


def counts_by_name(frames: dict[str, DataFrame], label: str = "name") -> DataFrame:
    """A2/A5: ``label, n`` for each named frame (union of global counts)."""
    out = None
    for name, df in frames.items():
        c = count_as(df, name, label)
        out = c if out is None else out.unionByName(c)
    return out


def with_total(counts: DataFrame, label: str = "name") -> DataFrame:
    """A2: the per-source counts plus an overall ``total`` row (one ``rollup`` pass)."""
    return (counts.rollup(label).agg(F.sum("n").cast("bigint").alias("n"))
            .select(F.coalesce(F.col(label), F.lit("total")).alias(label), "n"))


def product_by_source(dim_product: DataFrame, dim_source: DataFrame) -> DataFrame:
    """Members per source (the unknown member included under its own source)."""
    return (dim_product.groupBy("source_key").agg(F.count(F.lit(1)).alias("n"))
            .join(F.broadcast(dim_source), "source_key", "left")
            .select("source_name", F.col("n").cast("bigint").alias("n")))


def unknown_key_counts(fact: DataFrame) -> DataFrame:
    """Fact rows pointing at the unknown member, per dimension key."""
    keys = ["date_key", "customer_key", "product_key", "status_key", "source_key"]
    row = fact.agg(*[F.count_if(F.col(k) == S.UNKNOWN_KEY).cast("bigint").alias(k) for k in keys])
    return row.select(F.explode(F.array(*[F.struct(F.lit(k).alias("key_name"), F.col(k).alias("n"))
                                          for k in keys])).alias("s")).select("s.*")


def clean_report(current_fact: DataFrame, table: str = "dw.fact_sales") -> DataFrame:
    """Table, rows before, rows after, time of the clean.

    The next version is published in one step, so "after the clean" the table being
    replaced holds no rows of the new load yet: rows_after is 0.
    """
    return current_fact.agg(F.count(F.lit(1)).cast("bigint").alias("rows_before")).select(
        F.lit(table).alias("table_name"), "rows_before",
        F.lit(0).cast("bigint").alias("rows_after"),
        F.current_timestamp().alias("cleaned_at"))


def load_state_counts(load_control: DataFrame) -> DataFrame:
    """Loads per state, and how many never finished (no end time)."""
    return load_control.groupBy("state").agg(
        F.count(F.lit(1)).cast("bigint").alias("n"),
        F.count_if(F.col("ended_at").isNull()).cast("bigint").alias("unfinished"))
