"""A3-A7, J7, J8, J11 over a loaded warehouse: the checks the modelled validation scripts run.

``validate_warehouse`` returns one DataFrame ``check, value, expected, ok``: duplicate
groups per dimension (0), unfinished loads (0), fact rows with an unknown member (0),
members per source, rows per dimension, and the staged CSV orders and lines against the
staged relational ones (no difference expected).  Every value is an aggregate computed on
the executors; the checks are unioned into one result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..operators.audit import unknown_key_counts
from ..operators.compare import DIFFERS, MATCH, ONLY_CSV, ONLY_DB
from ..operators.dedup import dedup_order_lines, duplicate_summary
from ..operators.digests import reconcile_details, reconcile_orders
from ..operators.facts import unique_orders
from ..operators.validate import (accepted, convert_db_order_details, convert_db_orders,
                                  convert_order_details)
from .store import TableStore

NATURAL_KEYS = {
    "dim_source": ["source_key"], "dim_status": ["status"], "dim_date": ["date_key"],
    "dim_customer": ["source_key", "customer_id"], "dim_product": ["source_key", "product_id"],
}


def _row(df: DataFrame, check: str, value, expected) -> DataFrame:
    exp = F.lit(expected).cast("bigint") if expected is not None else F.lit(None).cast("bigint")
    return df.select(F.lit(check).alias("check"), F.col(value).cast("bigint").alias("value"),
                     exp.alias("expected"))


def reconcile_staged(store: TableStore) -> list[DataFrame]:
    """One row per state for each pair of staged tables that both exist."""
    stg = {t: store.read(f"stg/{t}") for t in ("orders", "db_orders", "order_details", "db_order_details")}
    found = []
    if stg["orders"] is not None and stg["db_orders"] is not None:
        found.append(("orders", reconcile_orders(unique_orders(stg["orders"]),
                                                 accepted(convert_db_orders(stg["db_orders"])))))
    if stg["order_details"] is not None and stg["db_order_details"] is not None:
        found.append(("order lines", reconcile_details(
            dedup_order_lines(accepted(convert_order_details(stg["order_details"]))),
            accepted(convert_db_order_details(stg["db_order_details"])))))
    out = []
    for name, counts in found:
        # one row with a column per state, so that a state without rows reads 0
        wide = counts.agg(*[F.coalesce(F.sum(F.when(F.col("state") == s, F.col("n"))), F.lit(0)).alias(s)
                            for s in (MATCH, DIFFERS, ONLY_CSV, ONLY_DB)])
        rows = F.array(*[F.struct(F.lit(f"{name}, CSV and database: {s}").alias("check"),
                                  F.col(s).cast("bigint").alias("value"),
                                  F.lit(None if s == MATCH else 0).cast("bigint").alias("expected"))
                         for s in (MATCH, DIFFERS, ONLY_CSV, ONLY_DB)])
        out.append(wide.select(F.inline(rows)))
    return out


def validate_warehouse(store: TableStore) -> DataFrame:
    checks = []
    for dim, keys in NATURAL_KEYS.items():
        d = store.read(f"dw/{dim}")
        if d is None:
            continue
        checks.append(_row(duplicate_summary(d, keys), f"{dim}: duplicate groups", "dup_groups", 0))
        checks.append(_row(d.agg(F.count(F.lit(1)).alias("n")), f"{dim}: rows", "n", None))
    lc = store.load_control()
    checks.append(_row(lc.agg(F.count_if(F.col("ended_at").isNull()).alias("n")),
                       "loads not finished", "n", 0))
    fact = store.read("dw/fact_sales")
    if fact is not None:
        unk = unknown_key_counts(fact).agg(F.sum("n").alias("n"))
        checks.append(_row(unk, "fact: rows with an unknown member", "n", 0))
    prod, src = store.read("dw/dim_product"), store.read("dw/dim_source")
    if prod is not None and src is not None:
        per = (prod.filter(F.col("product_key") != S.UNKNOWN_KEY).groupBy("source_key")
               .agg(F.count(F.lit(1)).alias("n")).join(F.broadcast(src), "source_key")
               .select(F.concat(F.lit("dim_product: members from "), F.col("source_name")).alias("check"),
                       F.col("n").cast("bigint").alias("value"), F.lit(None).cast("bigint").alias("expected")))
        checks.append(per)
    checks += reconcile_staged(store)
    out = checks[0]
    for c in checks[1:]:
        out = out.unionByName(c)
    return out.withColumn("ok", F.col("expected").isNull() | (F.col("value") == F.col("expected")))
