"""Property tests: the distributed operators equal their one-machine definitions."""

from decimal import ROUND_HALF_UP, Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from salesmart.functions.convert import unit_price
from salesmart.operators.keys import assign_keys

SETTINGS = dict(max_examples=8, deadline=None,
                suppress_health_check=[HealthCheck.function_scoped_fixture])

keys = st.lists(st.tuples(st.integers(-3, 3), st.integers(-2 ** 31, 2 ** 31 - 1)),
                min_size=0, max_size=400, unique=True)
clustered = st.lists(st.integers(0, 50), min_size=1, max_size=300, unique=True)


@settings(**SETTINGS)
@given(rows=keys, start=st.integers(0, 10 ** 6))
def test_assign_keys_is_a_global_row_number(spark, rows, start):
    df = spark.createDataFrame(rows, "s int, i int")
    got = sorted((r.s, r.i, r.k) for r in assign_keys(df, ["s", "i"], "k", start_after=start).collect())
    assert [(s, i) for s, i, _ in got] == sorted(rows)
    assert [k for _, _, k in got] == list(range(start + 1, start + 1 + len(rows)))


@settings(**SETTINGS)
@given(ids=clustered, far=st.lists(st.integers(10 ** 6, 2 ** 31 - 1), max_size=5, unique=True))
def test_assign_keys_with_clustered_keys(spark, ids, far):
    rows = sorted(set(ids) | set(far))
    df = spark.createDataFrame([(i,) for i in rows], "i int")
    got = sorted((r.i, r.k) for r in assign_keys(df, ["i"], "k").collect())
    assert got == [(i, n + 1) for n, i in enumerate(rows)]


@settings(**SETTINGS)
@given(pairs=st.lists(st.tuples(st.integers(0, 10 ** 9), st.integers(0, 60)), min_size=1, max_size=50))
def test_unit_price_is_half_up_division(spark, pairs):
    df = spark.createDataFrame([(Decimal(c) / 100, q) for c, q in pairs], "t decimal(18,2), q int")
    got = [r.u for r in df.select(unit_price("t", "q").alias("u")).collect()]
    want = [None if q == 0 else (Decimal(c) / 100 / q).quantize(Decimal("0.01"), ROUND_HALF_UP)
            for c, q in pairs]
    assert got == want
