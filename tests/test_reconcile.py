"""Digests of key buckets against the full outer join; validation of a loaded warehouse."""

import random

import pytest
from pyspark.sql import functions as F

from salesmart.operators.compare import compare
from salesmart.operators.digests import BUCKETS, bucket_digests, digest_state_counts

SCHEMA = "OrderID int, ProductID int, Quantity int, TotalPrice decimal(18,2)"
KEYS, VALUES = ["OrderID", "ProductID"], ["Quantity", "TotalPrice"]


def _lines(n, seed=1):
    from decimal import Decimal
    rnd = random.Random(seed)
    return [(i // 3, i % 3, rnd.choice([None, 1, 2]), Decimal(rnd.randrange(1000)) / 100) for i in range(n)]


def _counts(df):
    return {r.state: r.n for r in df.collect()}


def _joined(a, b):
    return _counts(compare(a, b, KEYS, VALUES).groupBy("state").agg(F.count(F.lit(1)).alias("n")))


def test_equal_copies_match_in_any_order_and_open_no_bucket(spark):
    rows = _lines(900)
    a = spark.createDataFrame(rows, SCHEMA)
    b = spark.createDataFrame(rows[::-1], SCHEMA).repartition(7)
    assert _counts(digest_state_counts(a, b, KEYS, VALUES)) == {"match": 900}
    assert _counts(digest_state_counts(a, a, KEYS, VALUES)) == {"match": 900}      # the very same frame
    assert bucket_digests(a, KEYS, VALUES).exceptAll(bucket_digests(b, KEYS, VALUES)).isEmpty()


@pytest.mark.parametrize("buckets", [1, 16, BUCKETS])
def test_perturbed_copies_equal_the_full_outer_join(spark, buckets):
    rows = _lines(900)
    other = [r for i, r in enumerate(rows) if i % 101]
    other = [(o, p, (q or 0) + 1, t) if i % 103 == 0 else (o, p, None, t) if i % 97 == 0 else (o, p, q, t)
             for i, (o, p, q, t) in enumerate(other)]
    other += [(5000, 1, 1, None), other[10]]                       # a new line, and one twice
    nulls = [(None, 1, 1, None), (None, 1, 1, None), (2, None, 1, None)]
    a = spark.createDataFrame(rows + nulls, SCHEMA)
    b = spark.createDataFrame(other + nulls[:2], SCHEMA)
    got = _counts(digest_state_counts(a, b, KEYS, VALUES, buckets))
    assert got == _joined(a, b) and got["only_db"] == 3 and got["differs"] > 5


def test_swapped_values_and_moved_nulls_are_seen(spark):
    # the same values in other rows of one bucket, and a NULL that changes its column
    a = spark.createDataFrame([(1, 1, 5, 7), (2, 2, 7, 5), (3, 3, None, 4)], "k int, l int, q int, p int")
    b = spark.createDataFrame([(1, 1, 7, 5), (2, 2, 5, 7), (3, 3, 4, None)], "k int, l int, q int, p int")
    assert _counts(digest_state_counts(a, b, ["k", "l"], ["q", "p"], 1)) == {"differs": 3}


def test_empty_sides_other_types_and_extra_columns(spark):
    a = spark.createDataFrame(_lines(30), SCHEMA)
    none = a.limit(0)
    assert _counts(digest_state_counts(none, none, KEYS, VALUES)) == {}
    assert _counts(digest_state_counts(a, none, KEYS, VALUES)) == {"only_csv": 30}
    assert _counts(digest_state_counts(none, a, KEYS, VALUES)) == {"only_db": 30}
    wide = a.select("*", F.lit(1).alias("bucket"), F.lit(2).alias("n"), F.lit("x").alias("state")).withColumn(
        "OrderID", F.col("OrderID").cast("bigint"))
    assert _counts(digest_state_counts(a, wide, KEYS, VALUES)) == {"match": 30}


def test_only_rows_of_open_buckets_are_joined(spark):
    rows = _lines(3000)
    a = spark.createDataFrame(rows, SCHEMA)
    b = spark.createDataFrame(rows[:-1] + [(999, 2, 77, None)], SCHEMA)
    counts = digest_state_counts(a, b, KEYS, VALUES)
    assert _counts(counts) == {"match": 2999, "differs": 1}
    plan = counts._jdf.queryExecution().executedPlan().toString()
    # the key join stands behind a semi-join with the open buckets on both sides
    assert plan.count("LeftSemi") >= 2


def test_validation_reconciles_the_staged_sources(spark, tmp_root):
    from salesmart import schemas as S
    from salesmart.plans.store import TableStore
    from salesmart.plans.validation import reconcile_staged
    store = TableStore(spark, tmp_root + "/wh")
    t = S.STAGING_COLUMNS
    frame = lambda rows, name: spark.createDataFrame(rows, ", ".join(f"{c} string" for c in t[name]))
    assert reconcile_staged(store) == []
    store.publish("stg/orders", frame([("1", "5", "2024-01-02", "F"), ("2", "5", "2024-01-02", "O")], "orders"))
    store.publish("stg/db_orders", frame([("1", "5", "2024-01-02", " f", ""), ("3", "5", "2024-01-02", "O", "")],
                                         "db_orders"))
    store.publish("stg/order_details", frame([("1", "7", "2", "3.00"), ("1", "7", "2", "1.00"), ("2", "7", "1", "1.00")],
                                             "order_details"))
    store.publish("stg/db_order_details", frame([("9", "1", "7", "2", "1.50", "3.00", ""),
                                                 ("10", "2", "7", "4", "1.00", "1.00", "")], "db_order_details"))
    got = {r.check: (r.value, r.expected) for df in reconcile_staged(store) for r in df.collect()}
    assert got == {
        "orders, CSV and database: match": (1, None), "orders, CSV and database: differs": (0, 0),
        "orders, CSV and database: only_csv": (1, 0), "orders, CSV and database: only_db": (1, 0),
        "order lines, CSV and database: match": (1, None), "order lines, CSV and database: differs": (1, 0),
        "order lines, CSV and database: only_csv": (0, 0), "order lines, CSV and database: only_db": (0, 0)}
