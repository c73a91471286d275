"""Operator-level checks on small hand-written inputs and plan shape checks."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from salesmart.operators import dims as D
from salesmart.operators.dedup import dedup_order_lines
from salesmart.operators.facts import FactInputs, build_fact
from salesmart.operators.keys import assign_keys
from salesmart.operators.staging import to_staging
from tests.conftest import SF001


def _details(spark, rows):
    return spark.createDataFrame(rows, "OrderID string, ProductID string, Quantity string, TotalPrice string")


def _orders(spark, rows):
    return spark.createDataFrame(rows, "OrderID string, CustomerID string, OrderDate string, Status string")


def _dims(spark, details_staged, orders_staged):
    from salesmart.operators.validate import accepted, convert_orders
    o = accepted(convert_orders(orders_staged))
    prof = D.order_profile(o)
    cust = spark.createDataFrame([("1", "A", "B", "a@x", "1", "c", "k")],
                                 "CustomerID string, FirstName string, LastName string, Email string, "
                                 "Phone string, City string, Country string")
    prod = spark.createDataFrame([("5", "P", "C", "1.00", "1")],
                                 "ProductID string, ProductName string, Category string, Price string, Stock string")
    empty = prod.limit(0)
    return FactInputs(details=details_staged, orders=orders_staged,
                      dim_date=D.load_dim_date(D.date_candidates(prof), None).table,
                      dim_customer=D.load_dim_customer(D.customer_members(cust), None).table,
                      dim_product=D.load_dim_product(D.product_members(prod, empty), None).table,
                      dim_status=D.load_dim_status(D.status_candidates(prof), None).table,
                      dim_source=D.dim_source(spark))


def test_fact_rejects_bad_text_orphans_and_keeps_highest_duplicate(spark):
    details = _details(spark, [
        ("1", "5", "2", "10.00"), ("1", "5", "3", "12.00"),   # duplicate: 12.00 survives
        ("1", "6", "abc", "1.00"),                            # quantity not a number
        ("1", "7", "0", "1.00"),                              # zero quantity
        ("2", "5", "1", "3.00"),                              # orphan: no order 2
        ("1", "8", "3", "10.00"),                             # unknown product -> -1
    ])
    orders = _orders(spark, [("1", "1", "2024-02-28", " f "), ("3", "9", "2024-02-30", "O")])
    fl = build_fact(_dims(spark, details, orders))
    fact = {r.product_key: r for r in fl.fact.collect()}
    assert len(fact) == 2
    kept = [r for r in fact.values() if r.product_key != -1][0]
    assert kept.total_amount == Decimal("12.00") and kept.quantity == 3
    assert kept.unit_price == Decimal("4.00") and kept.date_key == 20240228
    assert fact[-1].unit_price == Decimal("3.33")
    reasons = sorted(r.reject_reason for r in fl.rejects.collect())
    assert reasons == ["OrderID not found in orders", "Quantity not an integer", "Quantity not positive"]


def test_load_metrics_count_every_outcome(spark):
    from salesmart.operators.facts import load_metrics
    details = _details(spark, [
        ("1", "5", "2", "10.00"), ("1", "5", "3", "12.00"), ("1", "6", "abc", "1.00"),
        ("1", "7", "0", "1.00"), ("2", "5", "1", "3.00"), ("1", "8", "3", "10.00")])
    orders = _orders(spark, [("1", "1", "2024-02-28", " f "), ("3", "9", "2024-02-30", "O")])
    got = {r.metric: r.n for r in load_metrics(_dims(spark, details, orders)).collect()}
    assert got == {"rows_read": 6, "rows_inserted": 2, "rows_rejected": 3,
                   "rows_dropped_duplicates": 1, "unknown_keys": 1}


def test_unit_price_half_up(spark):
    from salesmart.functions.convert import unit_price
    df = spark.createDataFrame([(Decimal("0.05"), 2), (Decimal("10.00"), 3), (Decimal("1.00"), 0)],
                               "t decimal(18,2), q int")
    got = [r.u for r in df.select(unit_price("t", "q").alias("u")).collect()]
    assert got == [Decimal("0.03"), Decimal("3.33"), None]


def test_assign_keys_equals_global_row_number(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 10007).alias("a"), (F.col("id") % 3).alias("b"))
    keyed = assign_keys(df, ["b", "a"], "k", start_after=100)
    rows = sorted((r.b, r.a, r.k) for r in keyed.collect())
    assert [k for _, _, k in rows] == list(range(101, 5101))


def test_assign_keys_text_keys_equal_global_row_number(spark, monkeypatch):
    from salesmart.operators import keys as KEYS
    monkeypatch.setattr(KEYS, "SAMPLE_KEYS", 50)       # force many buckets from a sample
    words = [f"{chr(65 + i % 26)}{i:05d}é" for i in range(3000)]
    df = spark.createDataFrame([(w, i % 2) for i, w in enumerate(words)], "w string, g int")
    keyed = assign_keys(df, ["w", "g"], "k", start_after=3)
    got = sorted((r.w, r.g, r.k) for r in keyed.collect())
    assert [k for *_, k in got] == list(range(4, 3004))
    plan = keyed._jdf.queryExecution().executedPlan().toString()
    assert "checkpoint" not in plan.lower()


def test_assign_keys_integer_keys_equal_global_row_number(spark):
    df = spark.range(0, 20000).select((F.col("id") % 4 - 1).cast("int").alias("s"),
                                      (F.col("id") * 7919 % 1000003 - 500000).cast("int").alias("i"))
    keyed = assign_keys(df, ["s", "i"], "k", start_after=7)
    rows = sorted((r.s, r.i, r.k) for r in keyed.collect())
    assert [k for _, _, k in rows] == list(range(8, 20008))


def test_assign_keys_two_level_path(spark, monkeypatch):
    from salesmart.operators import keys as KEYS
    monkeypatch.setattr(KEYS, "TWO_LEVEL_ROWS", 0)            # force the large-input path
    df = spark.range(0, 30000).select((F.col("id") % 2).cast("int").alias("s"),
                                      (F.col("id") * 7919 % 1000003).cast("int").alias("i"))
    keyed = assign_keys(df, ["s", "i"], "k", start_after=11)
    rows = sorted((r.s, r.i, r.k) for r in keyed.collect())
    assert [k for *_, k in rows] == list(range(12, 30012))
    assert "_bucket" not in keyed.columns


def test_upsert_updates_inserts_and_keeps(spark):
    cur = spark.createDataFrame([(1, 1, 10, "a"), (2, 1, 11, "b"), (3, 1, 12, "c"), (-1, -1, -1, "UNKNOWN")],
                                "k bigint, s int, id int, v string")
    inc = spark.createDataFrame([(1, 10, "a"), (1, 11, "B"), (1, 13, "d"), (1, 9, "e")],
                                "s int, id int, v string")
    load = D.upsert(inc, cur, "k", ["s", "id"], ["v"], ["s", "id"])
    rows = {r.id: (r.k, r.v, r.state) for r in load.rows.collect()}
    assert rows[10] == (1, "a", "unchanged") and rows[11] == (2, "B", "updated")
    assert rows[12] == (3, "c", "kept")
    assert rows[9] == (4, "e", "inserted") and rows[13] == (5, "d", "inserted")
    assert rows[-1][0] == -1


def test_dedup_plan_limits_before_the_shuffle(spark):
    from salesmart.sources import standins
    plan = dedup_order_lines(standins.order_details(spark, SF001))._jdf.queryExecution() \
        .executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_staging_text_formats(spark):
    df = spark.createDataFrame(
        [(1, dt.date(2020, 1, 2), Decimal("10"), dt.datetime(2020, 1, 2, 3, 4, 5, 120000))],
        "OrderID int, OrderDate date, TotalPrice decimal(18,2), CreatedAt timestamp_ntz")
    stg = to_staging(df.select(F.col("OrderID"), F.lit(2).alias("CustomerID"), "OrderDate",
                               F.lit("F").alias("Status"), "CreatedAt"), "db_orders").collect()[0]
    assert stg.FechaPedido == "2020-01-02"
    assert stg.FechaCreacion == "2020-01-02 03:04:05.1200000"
    txt = to_staging(df.select("OrderID", F.lit(5).alias("ProductID"), F.lit(2).alias("Quantity"),
                               "TotalPrice"), "order_details").collect()[0]
    assert txt.TotalPrice == "10.00"


def test_reconciliation_counts_of_the_perturbed_copy(spark):
    """FIXTURES.md: at sf0.01 the perturbed historical copy gives these counts."""
    from salesmart.plans.queries import reconcile_details
    from tests.conftest import SF01
    got = {r.state: r.n for r in reconcile_details(spark, SF01).collect()}
    assert got == {"match": 58776, "differs": 589, "only_csv": 580}
