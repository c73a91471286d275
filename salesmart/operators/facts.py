"""The sales fact, one row per product within an order.

Plan, bottom to top: staged lines -> safe conversion and validity (F1) -> keep the
first of each (OrderID, ProductID) group (W1/F2; partial ``WindowGroupLimit`` before
the shuffle) -> left join with the orders (J1; a line without an order is rejected)
-> key lookups (J2-J6; small dimensions broadcast behind a size check, unmatched
members -> unknown key) -> unit price (P5).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions.convert import unit_price
from .dedup import dedup_order_lines, keep_first
from .lookups import SMALL_DIM_ROWS, WIDE_DIM_ROWS, lookup
from .skew import hot_keys, spread_join
from .validate import REASON, accepted, convert_order_details, convert_orders

ORPHAN = "OrderID not found in orders"


@dataclass
class FactInputs:
    details: DataFrame          # staged order lines (text)
    orders: DataFrame           # staged orders (text)
    dim_date: DataFrame
    dim_customer: DataFrame
    dim_product: DataFrame
    dim_status: DataFrame
    dim_source: DataFrame
    # per-dimension broadcast decisions taken beforehand (None: check when joining)
    broadcast: dict | None = None
    # hot keys per join (order, customer, product), found beforehand (skew.hot_keys)
    hot: dict | None = None


def typed_lines(staged_details: DataFrame) -> DataFrame:
    """Converted lines with ``reject_reason`` (F1)."""
    return convert_order_details(staged_details)


def unique_orders(staged_orders: DataFrame) -> DataFrame:
    """Accepted orders, one per OrderID (protects the fact grain).

    The de-duplication shuffles on OrderID, the key of the join that follows, so the
    join reuses that partitioning.
    """
    good = accepted(convert_orders(staged_orders))
    return keep_first(good, ["OrderID"], [F.col("OrderDate").asc_nulls_last(),
                                          F.col("CustomerID").asc_nulls_last(),
                                          F.col("Status").asc_nulls_last()])


def join_details_orders(lines: DataFrame, orders: DataFrame, hot: list | None = None) -> DataFrame:
    """Lines left-joined with their orders; orphans get ``reject_reason``.

    Lines of ``hot`` orders (a few orders holding a large share of all lines) are spread
    over the shuffle and take their order from a broadcast of just those orders.
    """
    o = orders.select(F.col("OrderID").alias("_o_id"), "CustomerID", "OrderDate", "Status")

    lines = lines.drop(REASON)
    joined = spread_join(lines, o, {"OrderID": "_o_id"}, "OrderID", hot)
    return joined.select(*lines.columns, "CustomerID", "OrderDate", "Status",
                         F.when(F.col("_o_id").isNull(), F.lit(ORPHAN)).alias(REASON))


def skew_plan(inp: FactInputs, details_rows: int, orders_rows: int, threads: int = 3) -> dict:
    """Hot keys of the shuffled joins, found concurrently from seeded samples of the
    staged rows: orders by line count, customers by order count, products by line
    count.  Lookups that broadcast their dimension need none."""
    from concurrent.futures import ThreadPoolExecutor
    from ..functions.convert import to_int
    b = inp.broadcast or {}
    tasks = {"order": (inp.details, to_int("OrderID"), details_rows)}
    if not b.get("customer"):
        tasks["customer"] = (inp.orders, to_int("CustomerID"), orders_rows)
    if not b.get("product"):
        tasks["product"] = (inp.details, to_int("ProductID"), details_rows)
    with ThreadPoolExecutor(max_workers=threads) as ex:
        futs = {k: ex.submit(hot_keys, df, c, n) for k, (df, c, n) in tasks.items()}
        return {k: f.result() for k, f in futs.items()}


def resolve_keys(lines: DataFrame, inp: FactInputs, source_key: int = S.SOURCE_CSV,
                 only: str | None = None) -> DataFrame:
    """J2-J6 on joined lines (OrderID, ProductID, CustomerID, OrderDate, Status, ...);
    ``only`` resolves just that key."""
    want = {only} if only else {"date_key", "customer_key", "product_key", "status_key"}
    b = inp.broadcast or {}
    # The source key is a constant of the load.  It is resolved against the fixed
    # source list the source dimension is built from (a join on a constant would be a
    # nested-loop join).
    known = {k for k, _, _ in S.SOURCES}
    x = lines.withColumn("_src", F.lit(source_key))
    x = x.withColumn("source_key", F.lit(source_key if source_key in known else S.UNKNOWN_KEY))
    hot = inp.hot or {}
    if "date_key" in want:                                                                 # J2
        x = lookup(x, inp.dim_date, {"OrderDate": "date"}, "date_key", SMALL_DIM_ROWS, b.get("date"))
    if "customer_key" in want:                                                             # J3
        x = lookup(x, inp.dim_customer, {"_src": "source_key", "CustomerID": "customer_id"},
                   "customer_key", WIDE_DIM_ROWS, b.get("customer"), hot.get("customer"), "CustomerID")
    if "product_key" in want:                                                              # J4
        x = lookup(x, inp.dim_product, {"_src": "source_key", "ProductID": "product_id"},
                   "product_key", WIDE_DIM_ROWS, b.get("product"), hot.get("product"), "ProductID")
    if "status_key" in want:                                                               # J5
        x = lookup(x, inp.dim_status, {"Status": "status"}, "status_key", SMALL_DIM_ROWS, b.get("status"))
    return x.drop("_src")


def broadcast_plan(inp: FactInputs, threads: int = 4) -> dict:
    """Check every dimension's size bound at once (concurrent, each reads at most
    bound + 1 rows) and return the broadcast decision per dimension."""
    from concurrent.futures import ThreadPoolExecutor
    from .lookups import fits
    checks = {"date": (inp.dim_date, SMALL_DIM_ROWS), "status": (inp.dim_status, SMALL_DIM_ROWS),
              "customer": (inp.dim_customer, WIDE_DIM_ROWS), "product": (inp.dim_product, WIDE_DIM_ROWS)}
    with ThreadPoolExecutor(max_workers=threads) as ex:
        futs = {k: ex.submit(fits, df, n) for k, (df, n) in checks.items()}
        return {k: f.result() for k, f in futs.items()}


def fact_rows(keyed: DataFrame) -> DataFrame:
    """P5 + projection to the fact columns."""
    return keyed.select(
        F.col("date_key").cast("int").alias("date_key"),
        F.col("customer_key").cast("bigint").alias("customer_key"),
        F.col("product_key").cast("bigint").alias("product_key"),
        F.col("status_key").cast("bigint").alias("status_key"),
        F.col("source_key").cast("int").alias("source_key"),
        F.col("OrderID").alias("order_number"),
        F.col("Quantity").alias("quantity"),
        unit_price("TotalPrice", "Quantity").alias("unit_price"),
        F.col("TotalPrice").alias("total_amount"))


@dataclass
class FactLoad:
    lines: DataFrame       # converted lines, all of them (reject_reason set on bad ones)
    unique: DataFrame      # accepted lines after W1
    joined: DataFrame      # unique lines joined with orders (orphans flagged)
    fact: DataFrame        # the fact rows (FACT_COLUMNS)
    rejects: DataFrame     # rejected lines with their reason


def orphan_lines(staged_details: DataFrame, staged_orders: DataFrame) -> DataFrame:
    """Staged text of the accepted, de-duplicated lines whose order is missing, with the
    reason."""
    raw = F.struct(*staged_details.columns).alias("raw")
    lines = dedup_order_lines(accepted(convert_order_details(staged_details, raw)))
    orders = unique_orders(staged_orders).select("OrderID")
    return lines.join(orders, "OrderID", "left_anti").select("raw.*", F.lit(ORPHAN).alias(REASON))


def build_fact(inp: FactInputs) -> FactLoad:
    lines = typed_lines(inp.details)
    unique = dedup_order_lines(accepted(lines))
    joined = join_details_orders(unique, unique_orders(inp.orders), (inp.hot or {}).get("order"))
    good = joined.filter(F.col(REASON).isNull())
    fact = fact_rows(resolve_keys(good, inp))
    rejects = (lines.filter(F.col(REASON).isNotNull())
               .unionByName(joined.filter(F.col(REASON).isNotNull())
                            .select(lines.columns)))
    return FactLoad(lines=lines, unique=unique, joined=joined, fact=fact, rejects=rejects)


def load_metrics(inp: FactInputs) -> DataFrame:
    """``metric, n`` for rows read, inserted, rejected, dropped as duplicates and
    resolved to an unknown member.

    Accepted lines flow to the end with flags (surviving duplicate, has an order, unknown
    member) and one global aggregate counts them - an independent check of the counts the
    load observes while it writes.  Lines that F1 rejects are only counted: with ids that
    do not convert they would share one null key in the window and the join.
    """
    from pyspark.sql import Window
    lines = typed_lines(inp.details)
    ok = F.col(REASON).isNull()
    w = Window.partitionBy("OrderID", "ProductID").orderBy(
        F.col("TotalPrice").desc_nulls_last(), F.col("Quantity").desc_nulls_last())
    flagged = lines.filter(ok).withColumn("_first", F.row_number().over(w) == 1)
    joined = join_details_orders(flagged, unique_orders(inp.orders), (inp.hot or {}).get("order"))
    keyed = resolve_keys(joined, inp)
    unknown = F.lit(False)
    for k in ("date_key", "customer_key", "product_key", "status_key", "source_key"):
        unknown = unknown | (F.col(k) == S.UNKNOWN_KEY)
    has_order = F.col(REASON).isNull()                      # orphans carry a reason
    inserted = F.col("_first") & has_order
    m = keyed.agg(
        F.count(F.lit(1)).alias("rows_read"),
        F.count_if(inserted).alias("rows_inserted"),
        F.count_if(F.col("_first") & ~has_order).alias("rows_rejected"),
        F.count_if(~F.col("_first")).alias("rows_dropped_duplicates"),
        F.count_if(inserted & unknown).alias("unknown_keys"))
    bad = lines.agg(F.count_if(~ok).alias("n"))
    names = ["rows_read", "rows_inserted", "rows_rejected", "rows_dropped_duplicates", "unknown_keys"]
    m = m.unionByName(bad.select(*[(F.col("n") if n in ("rows_read", "rows_rejected") else F.lit(0)).alias(n) for n in names]))
    m = m.agg(*[F.sum(n).alias(n) for n in names])
    return m.select(F.explode(F.array(*[F.struct(F.lit(n).alias("metric"),
                                                 F.col(n).cast("bigint").alias("n"))
                                        for n in names])).alias("m")).select("m.*")
