"""The checked queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator.

Inputs are the stand-in sources derived from the test tables (``sources.standins``);
readers of files land those stand-ins once under ``spark.checkpoint.dir`` and read them
back.  Every query runs over the whole tables.  ``plans.oracle`` holds the equivalent
DuckDB SQL for each name.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions.convert import unit_price as unit_price_expr
from ..operators import audit as A
from ..operators import digests as G
from ..operators import dims as D
from ..operators import reports as R
from ..operators import staging as K
from ..operators.dedup import dedup_members, dedup_order_lines, duplicate_groups, duplicate_summary
from ..operators.facts import (FactInputs, broadcast_plan, build_fact, join_details_orders,
                               load_metrics, resolve_keys, skew_plan, unique_orders)
from ..operators.keys import assign_keys
from ..operators.lookups import WIDE_DIM_ROWS, fits
from ..operators.skew import hot_keys
from ..functions.convert import to_date_safe, to_int
from ..operators.validate import (REASON, accepted, convert_customers, convert_db_orders,
                                  convert_order_details, convert_orders, convert_products,
                                  raw_rejects)
from ..session import path_key, scratch_path
from ..sources import landing, standins as SI
from ..sources.api import read_api_pages
from ..sources.csv import (read_customers_csv, read_order_details_csv, read_orders_csv,
                           read_products_csv)
from ..sources.relational import read_db_order_details, read_db_orders
from .store import TableStore

Q = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Q] = {}


def query(fn: Q) -> Q:
    REGISTRY[fn.__name__] = fn
    return fn


# --- shared building blocks (lazy plans) --------------------------------------------
def staged(spark: SparkSession, sf: str, table: str) -> DataFrame:
    """The staging rows of ``table`` as they would be written for this input."""
    typed = {
        "products": SI.products, "customers": SI.customers, "orders": SI.orders,
        "order_details": SI.order_details,
        "db_orders": lambda s, d: read_db_orders_from(s, SI.db_orders_table(s, d)),
        "db_order_details": lambda s, d: read_db_details_from(s, SI.db_order_details_table(s, d)),
        "api_products": lambda s, d: SI.api_items(s, d).select(
            *[F.col(k).alias(v) for k, v in S.API_FIELDS.items()]),
    }[table](spark, sf)
    return K.to_staging(typed, table)


def read_db_orders_from(spark: SparkSession, df: DataFrame) -> DataFrame:
    """P1 + P2 on an in-plan relational table (the projection/rename of S5)."""
    return df.select([F.col(src).alias(dst) for src, dst in S.DB_ORDER_COLUMNS.items()])


def read_db_details_from(spark: SparkSession, df: DataFrame) -> DataFrame:
    return df.select([F.col(src).alias(dst) for src, dst in S.DB_ORDER_DETAIL_COLUMNS.items()])


class FirstLoad:
    """First-load dimensions for one input (no current version), built on demand.

    A query touches only the dimensions it needs.  Each is computed once and written
    to a fresh folder below ``spark.checkpoint.dir`` (as the load publishes it), so its
    size check and every join read that table instead of recomputing the plan.
    """

    def __init__(self, spark: SparkSession, sf: str):
        self.spark, self.sf = spark, sf
        self._built: dict[str, DataFrame] = {}
        self._store: TableStore | None = None

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            if self._store is None:
                self._store = TableStore(self.spark, scratch_path(self.spark, "queries", "first_load",
                                                                 fresh=True))
            self._store.publish(f"dw/dim_{name}", getattr(self, f"_{name}")())
            self._built[name] = self._store.read(f"dw/dim_{name}")
        return self._built[name]

    def prefetch(self, *names: str) -> "FirstLoad":
        """Build the named dimensions at once (concurrent Spark jobs)."""
        from .pipeline import _parallel
        if self._store is None:
            self._store = TableStore(self.spark, scratch_path(self.spark, "queries", "first_load",
                                                             fresh=True))
        todo = [n for n in names if n not in self._built]
        if {"status", "date"} & set(todo):
            self._profile().count()                 # fill the shared profile once
        _parallel({n: (lambda n=n: self[n]) for n in todo})
        if "_profile" in self._built and {"status", "date"} <= set(self._built):
            self._built.pop("_profile").unpersist()
        return self

    def items(self):
        names = ("source", "status", "date", "customer", "product")  # noqa: E501
        self.prefetch(*names)
        return [(n, self[n]) for n in names]

    def _profile(self) -> DataFrame:
        """One pass over both order sources shared by the status and date dimensions
        (one row per status, cached while the dimensions are built)."""
        if "_profile" not in self._built:
            spark, sf = self.spark, self.sf
            orders_t = accepted(convert_orders(staged(spark, sf, "orders")))
            db_orders_t = accepted(convert_db_orders(staged(spark, sf, "db_orders"))).select(
                "OrderID", "CustomerID", "OrderDate", "Status")
            self._built["_profile"] = D.order_profile(orders_t, db_orders_t).cache()
        return self._built["_profile"]

    def _source(self):
        return D.dim_source(self.spark)

    def _status(self):
        return D.load_dim_status(D.status_candidates(self._profile()), None).table

    def _date(self):
        return D.load_dim_date(D.date_candidates(self._profile()), None).table

    def _customer(self):
        return D.load_dim_customer(D.customer_members(staged(self.spark, self.sf, "customers")), None).table

    def _product(self):
        return D.load_dim_product(D.product_members(staged(self.spark, self.sf, "products"),
                                                    staged(self.spark, self.sf, "api_products")),
                                  None).table


def first_dims(spark: SparkSession, sf: str) -> FirstLoad:
    return FirstLoad(spark, sf)


def fact_inputs(spark: SparkSession, sf: str, d: FirstLoad | None = None) -> FactInputs:
    d = (d or first_dims(spark, sf)).prefetch("date", "customer", "product", "status", "source")
    inp = FactInputs(details=staged(spark, sf, "order_details"), orders=staged(spark, sf, "orders"),
                     dim_date=d["date"], dim_customer=d["customer"], dim_product=d["product"],
                     dim_status=d["status"], dim_source=d["source"])
    inp.broadcast = broadcast_plan(inp)        # the four size checks run concurrently
    inp.hot = skew_plan(inp, inp.details.count(), inp.orders.count())   # metadata counts
    return inp


def first_fact(spark: SparkSession, sf: str, d: FirstLoad | None = None) -> DataFrame:
    return build_fact(fact_inputs(spark, sf, d)).fact


def unique_lines(spark: SparkSession, sf: str) -> DataFrame:
    return dedup_order_lines(accepted(convert_order_details(staged(spark, sf, "order_details"))))


def joined_lines(spark: SparkSession, sf: str) -> DataFrame:
    return join_details_orders(unique_lines(spark, sf), unique_orders(staged(spark, sf, "orders")))


def keyed_lines(spark: SparkSession, sf: str, key: str) -> DataFrame:
    """Joined lines with one key resolved; only that key's dimension is built."""
    name = key.removesuffix("_key")
    d, dim = None, None
    if name != "source":
        d = first_dims(spark, sf).prefetch(name)
        dim = d[name]
    inp = FactInputs(details=staged(spark, sf, "order_details"), orders=staged(spark, sf, "orders"),
                     **{f"dim_{n}": dim for n in ("date", "customer", "product", "status", "source")})
    if name in ("customer", "product"):
        inp.broadcast = {name: fits(dim, WIDE_DIM_ROWS)}
        side = (inp.orders, "CustomerID") if name == "customer" else (inp.details, "ProductID")
        inp.hot = {} if inp.broadcast[name] else {name: hot_keys(side[0], to_int(side[1]), side[0].count())}
    return resolve_keys(joined_lines(spark, sf).filter(F.col(REASON).isNull()), inp, only=key)


def _landed(spark: SparkSession, sf: str, name: str) -> str:
    return landing.land_one(spark, sf, name)


# --- S1-S9: sources -------------------------------------------------------------------
@query
def csv_products(spark, sf):
    return read_products_csv(spark, _landed(spark, sf, "products"))


@query
def csv_customers(spark, sf):
    return read_customers_csv(spark, _landed(spark, sf, "customers"))


@query
def csv_orders(spark, sf):
    return read_orders_csv(spark, _landed(spark, sf, "orders"))


@query
def csv_order_details(spark, sf):
    return read_order_details_csv(spark, _landed(spark, sf, "order_details"))


@query
def jdbc_orders(spark, sf):
    """S5 over the Parquet copy of the relational table (no database is started)."""
    return read_db_orders(spark, path=_landed(spark, sf, "db_orders"))


@query
def jdbc_order_details(spark, sf):
    return read_db_order_details(spark, path=_landed(spark, sf, "db_order_details"))


@query
def api_products(spark, sf):
    return read_api_pages(spark, _landed(spark, sf, "api_products"))


@query
def sorted_db_orders(spark, sf):
    return jdbc_orders(spark, sf).orderBy("OrderID")


@query
def sorted_db_details(spark, sf):
    return jdbc_order_details(spark, sf).orderBy("OrderDetailID")


# --- K1-K7, T1-T4: staging as text ------------------------------------------------------
for _t in S.STAGING_COLUMNS:
    def _mk(t):
        def fn(spark, sf):
            return staged(spark, sf, t)
        fn.__name__ = f"stage_{t}"
        return fn
    query(_mk(_t))


@query
def text_ints(spark, sf):
    return staged(spark, sf, "orders").select("OrderID", "CustomerID")


@query
def text_decimals(spark, sf):
    return staged(spark, sf, "products").select("ProductID", "Price")


@query
def text_dates(spark, sf):
    return staged(spark, sf, "orders").select("OrderID", "OrderDate")


@query
def text_timestamps(spark, sf):
    return staged(spark, sf, "db_orders").select("PedidoId", "FechaCreacion")


@query
def stage_skip_empty(spark, sf):
    """K9: publish staged lines, then offer an empty extract: the old rows stay."""
    store = TableStore(spark, scratch_path(spark, "queries", "skip_empty", fresh=True))
    rows = staged(spark, sf, "order_details")
    K.write_staging(store, "order_details", rows)
    before = store.current_version("stg/order_details")
    published = K.write_staging(store, "order_details", rows.filter(F.lit(False)))
    after = store.current_version("stg/order_details")
    assert not published and before == after
    n = store.read("stg/order_details").agg(F.count(F.lit(1)).cast("bigint").alias("n"))
    return n.select(F.lit("stg.order_details").alias("table_name"),
                    F.col("n").alias("rows_before"), F.col("n").alias("rows_after"))


# --- P6, P7, F1: conversion, cleaning, validation -------------------------------------------
def corrupted_orders(spark, sf) -> DataFrame:
    """Staged orders with bad text by rule: ids that do not convert, an impossible date,
    an empty customer id."""
    st = staged(spark, sf, "orders")
    oid = F.col("OrderID").cast("int")
    return st.select(
        F.when(oid % 50 == 0, F.concat(F.lit("x"), F.col("OrderID"))).otherwise(F.col("OrderID")).alias("OrderID"),
        F.when(oid % 90 == 0, F.lit("")).otherwise(F.col("CustomerID")).alias("CustomerID"),
        F.when(oid % 70 == 0, F.lit("2024-02-30")).otherwise(F.col("OrderDate")).alias("OrderDate"),
        "Status")


@query
def safe_convert(spark, sf):
    """Raw text beside its safely converted value and the accepted flag."""
    raw = corrupted_orders(spark, sf)
    out = raw.select(
        F.col("OrderID").alias("order_id_text"), F.col("CustomerID").alias("customer_id_text"),
        F.col("OrderDate").alias("order_date_text"),
        to_int("OrderID").alias("order_id"), to_int("CustomerID").alias("customer_id"),
        to_date_safe("OrderDate").alias("order_date"))
    return out.withColumn("accepted", F.col("order_id").isNotNull() & F.col("customer_id").isNotNull()
                          & F.col("order_date").isNotNull())


def corrupted_details(spark, sf) -> DataFrame:
    """Staged lines with bad text by rule: a quantity that is not a number, a zero
    quantity, a negative total."""
    st = staged(spark, sf, "order_details")
    oid, pid = F.col("OrderID").cast("int"), F.col("ProductID").cast("int")
    qty = (F.when(oid % 50 == 0, F.concat(F.lit("x"), F.col("Quantity")))
           .when(oid % 70 == 0, F.lit("0")).otherwise(F.col("Quantity")))
    total = F.when(pid % 97 == 0, F.concat(F.lit("-"), F.col("TotalPrice"))).otherwise(F.col("TotalPrice"))
    return st.select("OrderID", "ProductID", qty.alias("Quantity"), total.alias("TotalPrice"))


@query
def validate_order_details(spark, sf):
    return accepted(convert_order_details(corrupted_details(spark, sf)))


@query
def rejected_order_details(spark, sf):
    """F1 rejects: the raw text of each rejected line and the first rule it breaks."""
    return raw_rejects(corrupted_details(spark, sf), convert_order_details).withColumnsRenamed(
        {"OrderID": "order_id_text", "ProductID": "product_id_text", "Quantity": "quantity_text",
         "TotalPrice": "total_text"})


def padded_customers(spark, sf) -> DataFrame:
    """Staged customers made untidy by rule: padding, upper-case email, runs of blanks,
    blank-only phone."""
    st = staged(spark, sf, "customers")
    cid = F.col("CustomerID").cast("int")
    return st.select(
        "CustomerID",
        F.when(cid % 3 == 0, F.concat(F.lit("  "), F.col("FirstName"), F.lit(" "))).otherwise(F.col("FirstName")).alias("FirstName"),
        F.when(cid % 4 == 0, F.concat(F.col("LastName"), F.lit("   "))).otherwise(F.col("LastName")).alias("LastName"),
        F.when(cid % 5 == 0, F.concat(F.lit(" "), F.upper("Email"), F.lit(" "))).otherwise(F.col("Email")).alias("Email"),
        F.when(cid % 7 == 0, F.lit("   ")).otherwise(F.col("Phone")).alias("Phone"),
        F.when(cid % 6 == 0, F.regexp_replace("City", "_", "   _")).otherwise(F.col("City")).alias("City"),
        F.when(cid % 8 == 0, F.regexp_replace("Country", " ", "    ")).otherwise(F.col("Country")).alias("Country"))


@query
def normalize_customers(spark, sf):
    return accepted(convert_customers(padded_customers(spark, sf)))


@query
def unit_price(spark, sf):
    lines = SI.order_details(spark, sf)
    return lines.withColumn("unit_price", unit_price_expr("TotalPrice", "Quantity"))


@query
def fact_dedup(spark, sf):
    return unique_lines(spark, sf)


@query
def dedup_products(spark, sf):
    """W2 over CSV products plus a second copy (price + 1) of every 25th product."""
    st = staged(spark, sf, "products")
    extra = (st.filter(F.col("ProductID").cast("int") % 25 == 0)
             .withColumn("Price", (F.col("Price").cast(S.MONEY_SQL) + 1).cast("string")))
    members = accepted(convert_products(st.unionByName(extra)))
    return dedup_members(members, ["product_id"], S.DIM_PRODUCT_ATTRS)


@query
def dup_order_lines(spark, sf):
    return duplicate_groups(SI.order_details(spark, sf), ["OrderID", "ProductID"])


@query
def dup_groups_customers(spark, sf):
    return duplicate_summary(first_dims(spark, sf)["customer"], ["source_key", "customer_id"])


@query
def dup_groups_products(spark, sf):
    return duplicate_summary(first_dims(spark, sf)["product"], ["source_key", "product_id"])


@query
def product_source_tag(spark, sf):
    """Every product row of both sources tagged with its source key."""
    csv = SI.products(spark, sf).select("ProductID", F.lit(S.SOURCE_CSV).alias("source_key"))
    api = SI.api_items(spark, sf).select(F.col("id").alias("ProductID"),
                                         F.lit(S.SOURCE_API).alias("source_key"))
    return csv.unionByName(api)


# --- J1-J11 ------------------------------------------------------------------------------
@query
def join_details_orders_q(spark, sf):
    return joined_lines(spark, sf).drop(REASON)


def _lookup_query(key):
    def fn(spark, sf):
        return keyed_lines(spark, sf, key).select("OrderID", "ProductID", key)
    return fn


for _name, _key in [("lookup_date", "date_key"), ("lookup_customer", "customer_key"),
                    ("lookup_product", "product_key"), ("lookup_status", "status_key"),
                    ("lookup_source", "source_key")]:
    _f = _lookup_query(_key)
    _f.__name__ = _name
    query(_f)


@query
def fact_sales(spark, sf):
    return first_fact(spark, sf)


@query
def reconcile_details(spark, sf):
    csv = unique_lines(spark, sf)
    db = read_db_details_from(spark, SI.db_order_details_table(spark, sf, perturbed=True, dated=False))
    return G.reconcile_details(csv, db)


@query
def reconcile_orders(spark, sf):
    csv = accepted(convert_orders(staged(spark, sf, "orders")))
    db = accepted(convert_db_orders(staged(spark, sf, "db_orders")))
    return G.reconcile_orders(csv, db)


# ids of the new members in a second batch: one id in twenty, shifted by this
NEW_ID_OFFSET = 1_000_000_000


def second_product_batch(spark, sf) -> DataFrame:
    """The product extract of a second run: every 50th price up 10 %, one new id in twenty."""
    st = staged(spark, sf, "products")
    pid = F.col("ProductID").cast("int")
    changed = st.withColumn("Price", F.when(pid % 50 == 0,
                                            (F.col("Price").cast(S.MONEY_SQL) * F.lit(1.1).cast("decimal(3,1)"))
                                            .cast(S.MONEY_SQL).cast("string")).otherwise(F.col("Price")))
    new = st.filter(pid % 20 == 1).withColumn("ProductID", (pid + NEW_ID_OFFSET).cast("string"))
    return changed.unionByName(new)


def second_customer_batch(spark, sf) -> DataFrame:
    """The customer extract of a second run: every 50th phone changed, one new id in twenty."""
    st = staged(spark, sf, "customers")
    cid = F.col("CustomerID").cast("int")
    changed = st.withColumn("Phone", F.when(cid % 50 == 0, F.concat(F.lit("+"), F.col("Phone")))
                            .otherwise(F.col("Phone")))
    new = st.filter(cid % 20 == 1).withColumn("CustomerID", (cid + NEW_ID_OFFSET).cast("string"))
    return changed.unionByName(new)


def product_second_load(spark, sf) -> D.DimLoad:
    current = first_dims(spark, sf)["product"]
    members = D.product_members(second_product_batch(spark, sf), staged(spark, sf, "api_products"))
    return D.load_dim_product(members, current)


def customer_second_load(spark, sf) -> D.DimLoad:
    current = first_dims(spark, sf)["customer"]
    return D.load_dim_customer(D.customer_members(second_customer_batch(spark, sf)), current)


@query
def dim_change_counts(spark, sf):
    p = product_second_load(spark, sf).counts().select(F.lit("product").alias("dimension"), "state", "n")
    c = customer_second_load(spark, sf).counts().select(F.lit("customer").alias("dimension"), "state", "n")
    return p.unionByName(c).withColumn("n", F.col("n").cast("bigint"))


@query
def dim_product_upsert(spark, sf):
    return product_second_load(spark, sf).table


@query
def dim_customer_upsert(spark, sf):
    return customer_second_load(spark, sf).table


@query
def dim_new_products(spark, sf):
    current = first_dims(spark, sf)["product"]
    members = D.product_members(second_product_batch(spark, sf), staged(spark, sf, "api_products"))
    return D.new_members(members, current, ["source_key", "product_id"])


@query
def unknown_key_counts(spark, sf):
    return A.unknown_key_counts(first_fact(spark, sf))


# --- A1-A9 -------------------------------------------------------------------------------
@query
def source_counts(spark, sf):
    frames = {t: staged(spark, sf, t) for t in S.STAGING_COLUMNS}
    return A.with_total(A.counts_by_name(frames))


@query
def dim_counts(spark, sf):
    d = first_dims(spark, sf)
    return A.counts_by_name({f"dim_{k}": v for k, v in d.items()}, label="dimension")


@query
def product_by_source(spark, sf):
    d = first_dims(spark, sf)
    return A.product_by_source(d["product"], d["source"])


@query
def fact_load_metrics(spark, sf):
    """A8 in one pass (``facts.load_metrics``)."""
    return load_metrics(fact_inputs(spark, sf))


@query
def fact_clean_report(spark, sf):
    return A.clean_report(first_fact(spark, sf)).drop("cleaned_at")


# --- D1-D6 -------------------------------------------------------------------------------
@query
def dim_source(spark, sf):
    """D1 with the rows each source delivers in this input."""
    counts = {S.SOURCE_CSV: ["products", "customers", "orders", "order_details"],
              S.SOURCE_DB: ["db_orders", "db_order_details"], S.SOURCE_API: ["api_products"]}
    per = None
    for key, tables in counts.items():
        for t in tables:
            c = staged(spark, sf, t).agg(F.count(F.lit(1)).alias("n")).select(
                F.lit(key).alias("source_key"), "n")
            per = c if per is None else per.unionByName(c)
    per = per.groupBy("source_key").agg(F.sum("n").cast("bigint").alias("rows_extracted"))
    return (D.dim_source(spark).join(per, "source_key", "left")
            .select(*S.DIM_SOURCE_COLUMNS,
                    F.coalesce("rows_extracted", F.lit(0).cast("bigint")).alias("rows_extracted")))


@query
def dim_status(spark, sf):
    return first_dims(spark, sf)["status"]


@query
def dim_date(spark, sf):
    return first_dims(spark, sf)["date"]


@query
def dim_customer(spark, sf):
    return first_dims(spark, sf)["customer"]


@query
def dim_product(spark, sf):
    return first_dims(spark, sf)["product"]


@query
def surrogate_keys(spark, sf):
    """D6 at fact size: one key per distinct (OrderID, ProductID), in key order."""
    pairs = SI.order_details(spark, sf).select("OrderID", "ProductID").distinct()
    return assign_keys(pairs, ["OrderID", "ProductID"], "line_key")


# --- K13, A7: load control of a real pipeline run ---------------------------------------
def pipeline_warehouse(spark: SparkSession, sf: str) -> str:
    """Run the whole load for ``sf`` into a fresh warehouse and return its folder."""
    from .pipeline import run
    wh = scratch_path(spark, "queries", "warehouse", path_key(sf), fresh=True)
    run(spark, source_config(spark, sf), wh)
    return wh


def source_config(spark: SparkSession, sf: str):
    from .pipeline import SourceConfig
    p = landing.land_all(spark, sf)
    return SourceConfig(products_csv=p["products"], customers_csv=p["customers"],
                        orders_csv=p["orders"], order_details_csv=p["order_details"],
                        api_pages=p["api_products"], db_orders={"path": p["db_orders"]},
                        db_order_details={"path": p["db_order_details"]})


@query
def load_control(spark, sf):
    lc = TableStore(spark, pipeline_warehouse(spark, sf)).load_control()
    return lc.select("process", "source", "state", "rows_read", "rows_inserted",
                     "rows_updated", "rows_rejected")


@query
def load_state_counts(spark, sf):
    return A.load_state_counts(TableStore(spark, pipeline_warehouse(spark, sf)).load_control())


# --- sales indicators ---------------------------------------------------------------------
@query
def sales_by_month(spark, sf):
    d = first_dims(spark, sf)
    return R.sales_by_month(first_fact(spark, sf, d), d["date"])


@query
def sales_by_category(spark, sf):
    d = first_dims(spark, sf)
    return R.sales_by_category(first_fact(spark, sf, d), d["product"])


@query
def sales_by_country(spark, sf):
    d = first_dims(spark, sf)
    return R.sales_by_country(first_fact(spark, sf, d), d["customer"])


@query
def sales_by_status(spark, sf):
    d = first_dims(spark, sf)
    return R.sales_by_status(first_fact(spark, sf, d), d["status"])


@query
def top_customers(spark, sf):
    d = first_dims(spark, sf)
    return R.top_customers(first_fact(spark, sf, d), d["customer"])


# the query of J1 is registered under its survey name
REGISTRY["join_details_orders"] = REGISTRY.pop("join_details_orders_q")
