"""Paths that small test data does not take on its own: shuffled dimension lookups
(dimensions above the broadcast bound) and a hot key holding a third of all rows."""

import contextlib
from decimal import Decimal

from pyspark.sql import functions as F

from salesmart.operators.facts import FactInputs, build_fact
from salesmart.plans.queries import first_dims, staged
from tests.conftest import SF001


@contextlib.contextmanager
def conf(spark, **kv):
    old = {k: spark.conf.get(k, None) for k in kv}
    for k, v in kv.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def _inputs(spark, details, broadcast):
    d = first_dims(spark, SF001).prefetch("date", "customer", "product", "status", "source")
    return FactInputs(details=details, orders=staged(spark, SF001, "orders"), dim_date=d["date"],
                      dim_customer=d["customer"], dim_product=d["product"], dim_status=d["status"],
                      dim_source=d["source"], broadcast=broadcast)


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_shuffled_lookups_equal_broadcast_lookups(spark):
    details = staged(spark, SF001, "order_details")
    with_bc = _rows(build_fact(_inputs(spark, details, {k: True for k in
                                                        ("date", "customer", "product", "status")})).fact)
    with conf(spark, **{"spark.sql.autoBroadcastJoinThreshold": "-1",
                        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}):
        fact = build_fact(_inputs(spark, details, {k: False for k in
                                                   ("date", "customer", "product", "status")})).fact
        plan = fact._jdf.queryExecution().executedPlan().toString()
        without = _rows(fact)
    assert "SortMergeJoin" in plan
    assert with_bc == without


def test_hot_order_with_a_third_of_all_lines(spark):
    """One order gets a third of all lines (distinct products): the fact must equal a
    brute-force computation, with AQE skew join splitting the hot partition."""
    base = staged(spark, SF001, "order_details")
    hot = (base.withColumn("_i", F.monotonically_increasing_id())
           .withColumn("OrderID", F.when(F.col("_i") % 3 == 0, F.lit("7")).otherwise(F.col("OrderID")))
           .drop("_i"))
    pdf = hot.toPandas()
    with conf(spark, **{"spark.sql.autoBroadcastJoinThreshold": "-1",
                        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
                        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
                        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
                        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k"}):
        hot_df = spark.createDataFrame(pdf)
        fact = build_fact(_inputs(spark, hot_df, {k: False for k in
                                                  ("date", "customer", "product", "status")})).fact
        got = fact.select("order_number", "quantity", "total_amount").toPandas()
    # brute force: keep the highest total (then quantity) per (order, product)
    b = pdf.assign(OrderID=pdf.OrderID.astype(int), ProductID=pdf.ProductID.astype(int),
                   Quantity=pdf.Quantity.astype(int), TotalPrice=pdf.TotalPrice.map(Decimal))
    b = (b.sort_values(["OrderID", "ProductID", "TotalPrice", "Quantity"],
                       ascending=[True, True, False, False])
         .drop_duplicates(["OrderID", "ProductID"]))
    assert len(got) == len(b)
    assert int(got.quantity.sum()) == int(b.Quantity.sum())
    assert Decimal(got.total_amount.sum()) == Decimal(b.TotalPrice.sum())
    assert int((got.order_number == 7).sum()) == int((b.OrderID == 7).sum())


def test_hot_keys_are_spread_in_one_pass(spark, monkeypatch):
    """Hot orders, customers and products, and lines without ids: the facts and the
    metrics equal the plain route, and the lines are scanned once."""
    from salesmart.operators import skew
    from salesmart.operators.facts import load_metrics, skew_plan
    base = staged(spark, SF001, "order_details")
    hot_df = (base.withColumn("_i", F.monotonically_increasing_id())
              .withColumn("OrderID", F.when(F.col("_i") % 3 == 0, F.lit("7")).when(F.col("_i") % 50 == 1, F.lit("x"))
                          .otherwise(F.col("OrderID")))
              .withColumn("ProductID", F.when(F.col("_i") % 4 == 1, F.lit("9")).otherwise(F.col("ProductID")))
              .drop("_i"))
    hot_df = spark.createDataFrame(hot_df.toPandas())
    no_bc = {k: False for k in ("date", "customer", "product", "status")}
    with conf(spark, **{"spark.sql.autoBroadcastJoinThreshold": "-1",
                        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}):
        inp = _inputs(spark, hot_df, no_bc)
        plain, metrics = _rows(build_fact(inp).fact), _rows(load_metrics(inp))
        monkeypatch.setattr(skew, "SAMPLE_FRACTION", 1.0)
        inp.hot = skew_plan(inp, hot_df.count(), inp.orders.count())
        assert 7 in inp.hot["order"] and 9 in inp.hot["product"] and inp.hot["customer"]
        load = build_fact(inp)
        plan = load.joined._jdf.queryExecution().executedPlan().toString()
        split, metrics_split = _rows(load.fact), _rows(load_metrics(inp))
    assert "Union" not in plan and "BroadcastHashJoin" in plan and plan.count("SortMergeJoin") == 1
    assert split == plain
    assert metrics_split == metrics


def test_lines_by_order_are_shuffled_once(spark):
    from salesmart.operators.dedup import dedup_order_lines
    from salesmart.operators.facts import join_details_orders, unique_orders

    rows = [(o, p, q, str(t)) for o in [1, 2, 3, None] for p in [7, 8, None] for q, t in [(1, 5), (2, 5), (1, 4)]]
    lines = spark.createDataFrame(rows, "OrderID int, ProductID int, Quantity int, TotalPrice string").withColumn(
        "TotalPrice", F.col("TotalPrice").cast("decimal(18,2)"))
    orders = spark.createDataFrame([("1", "4", "2024-01-02", "o"), ("3", "4", "2024-01-03", "f"), ("3", "5", "2024-01-03", "f")],
                                   "OrderID string, CustomerID string, OrderDate string, Status string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plain, once = (join_details_orders(dedup_order_lines(lines, **kw), unique_orders(orders)) for kw in ({}, {"by_order": True}))
        plan = once._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 2           # lines once, orders once
        assert sorted(map(str, plain.collect())) == sorted(map(str, once.collect()))
        assert once.count() == 12
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
