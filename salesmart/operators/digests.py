"""J7, J8 at scale: two tables reconciled by order-free digests of key buckets.

Every row gets a 128-bit digest of its keys and compared values; a bucket's digest is
its row count and the sums of the digests' four 32-bit parts, so the order of the rows
and the partitioning do not matter.  Equal buckets hold equal rows and are only counted;
the rows of differing buckets alone are joined key by key.  Two equal sources therefore
exchange one row per bucket and map task instead of both tables, and the join grows with
what differs.

The counts are those of ``compare`` (a full outer join) as long as the keys of one side
are unique, which its de-duplication guarantees; in an equal bucket every row is one
match.  Rows with a NULL key match nothing and are counted apart, never joined.  Empty
tables give no rows.  Different rows pass for equal with a probability of 2**-128 per
bucket.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .compare import DIFFERS, MATCH, ONLY_CSV, ONLY_DB, compare

#: Buckets: bounds the bucket tables, and the broadcast list of differing buckets (at most
#: this many 4-byte numbers), whatever the size of the sources.
BUCKETS = 1 << 16
_PARTS = ["_d0", "_d1", "_d2", "_d3"]
_LOW = 0xFFFFFFFF


def _bucket(keys: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def _digest_parts(columns: list[str]) -> list[Column]:
    # a hash skips NULLs, so their places are hashed as well
    nulls = F.concat(*[F.when(F.col(c).isNull(), F.lit("1")).otherwise(F.lit("0")) for c in columns])
    parts = []
    for seed in ("first", "second"):
        h = F.xxhash64(F.lit(seed), nulls, *columns)
        parts += [h.bitwiseAND(F.lit(_LOW)), F.shiftrightunsigned(h, 32)]
    return parts


def bucket_digests(rows: DataFrame, keys: list[str], values: list[str],
                   buckets: int = BUCKETS) -> DataFrame:
    """``bucket, n`` and the digest sums of ``rows`` (no NULL keys), combined map-side."""
    parts = [p.alias(n) for n, p in zip(_PARTS, _digest_parts([*keys, *values]))]
    return (rows.select(_bucket(keys, buckets).alias("bucket"), *parts).groupBy("bucket")
            .agg(F.count(F.lit(1)).alias("n"), *[F.sum(p).alias(p) for p in _PARTS]))


def _null_key(keys: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])


def digest_state_counts(left: DataFrame, right: DataFrame, keys: list[str], values: list[str],
                        buckets: int = BUCKETS) -> DataFrame:
    """``state, n`` of the full outer comparison of ``left`` (CSV) and ``right``
    (relational), states without rows left out.

    Both sides are cast to the left side's types, so that equal values have equal digests."""
    types = dict(left.dtypes)
    cols = [*keys, *values]
    sides = [df.select([F.col(c).cast(types[c]).alias(c) for c in cols]) for df in (left, right)]
    known = [df.filter(~_null_key(keys)) for df in sides]
    a, b = (bucket_digests(df, keys, values, buckets) for df in known)
    b = b.withColumnsRenamed({c: f"_r{c}" for c in ["n", *_PARTS]})
    same = reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.col(f"_r{c}")) for c in ["n", *_PARTS]])
    tree = a.join(b, "bucket", "full_outer").select("bucket", "n", same.alias("same"))
    open_buckets = F.broadcast(tree.filter(~F.col("same")).select("bucket"))     # at most BUCKETS rows
    rest = [df.withColumn("bucket", _bucket(keys, buckets)).join(open_buckets, "bucket", "left_semi")
            .drop("bucket") for df in known]
    parts = [tree.filter("same").select(F.lit(MATCH).alias("state"), "n"),
             compare(*rest, keys, values).groupBy("state").agg(F.count(F.lit(1)).alias("n"))]
    for df, state in zip(sides, (ONLY_CSV, ONLY_DB)):
        parts.append(df.filter(_null_key(keys)).agg(F.count(F.lit(1)).alias("n"))
                     .select(F.lit(state).alias("state"), "n"))
    return (reduce(DataFrame.unionByName, parts).groupBy("state").agg(F.sum("n").alias("n"))
            .filter(F.col("n") > 0))


STATES = [MATCH, DIFFERS, ONLY_CSV, ONLY_DB]


def reconcile_details(csv_lines: DataFrame, db_lines: DataFrame) -> DataFrame:
    """De-duplicated CSV lines vs historical lines on (OrderID, ProductID)."""
    return digest_state_counts(csv_lines, db_lines, ["OrderID", "ProductID"], ["Quantity", "TotalPrice"])


def reconcile_orders(csv_orders: DataFrame, db_orders: DataFrame) -> DataFrame:
    """CSV orders vs historical orders on OrderID (customer, date, status)."""
    return digest_state_counts(csv_orders, db_orders, ["OrderID"], ["CustomerID", "OrderDate", "Status"])
