"""Surrogate keys without a single-partition window.

New members get ``start_after + 1 .. start_after + N`` in the order of their natural
key, exactly as a global ``row_number()`` would give, but computed in parallel and
deterministically (a recomputed task after a lost executor yields the same keys):

* **Integer natural keys** (the usual case: source key + source id).  The keys are
  packed into one order-preserving 64-bit ordinal, and ``percentile_approx`` picks up
  to 4095 cut points once (numbers on the driver, then literals and a <= 256-row table
  in the plan).  A row's bucket is a pure function of its key (a two-level binary
  search), the buckets hold about equal numbers of rows because natural keys are
  unique, ``row_number()`` runs per bucket (up to 4096 parallel windows), and a table
  of one row per bucket (at most 4096 rows) gives each bucket its offset.
* **Other key types** (e.g. a status text).  Cut points come from a seeded sample of
  the key tuples (at most ``4 * SAMPLE_KEYS`` reach the driver), and the bucket is a
  binary search over struct literals; the rest is the same as above.

Existing members are never renumbered (the caller passes only new rows), which keeps
keys stable from one run to the next.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


# A binary search over literal cut points compiles to Java up to about 256 leaves (1024
# was tried: Spark falls back to interpreted evaluation, 3-4x slower).  Integer keys
# therefore search two levels: <= 256 group heads in the expression, then the group's
# FINE_PER_GROUP cut points, attached by a broadcast join of a <= 256-row table - up to
# 4096 numbering windows (parallel tasks) and an offset table of <= 4096 rows.
MAX_BUCKETS = 256
FINE_PER_GROUP = 16
TWO_LEVEL_ROWS = 512_000_000   # above this many new rows, 256 windows become too few
_PAD = 2 ** 63 - 1        # fills the last group; no ordinal reaches it
SAMPLE_KEYS = 20_000      # expected sample size for the cut points of non-integer keys
SAMPLE_SEED = 29
_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType)


def _offsets(per_bucket: DataFrame, bucket: str) -> DataFrame:
    """Rows before each bucket.  ``per_bucket`` has one row per non-empty bucket (its
    size is bounded by the bucket count), so this small window and its broadcast do not
    grow with the data."""
    before = Window.orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    return per_bucket.select(bucket, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))


def _ordinal(rows: DataFrame, order_cols: list[str]) -> Column | None:
    """One order-preserving bigint for up to two 32-bit integer key columns."""
    types = {f.name: f.dataType for f in rows.schema.fields}
    if not (1 <= len(order_cols) <= 2) or not all(isinstance(types[c], _INTEGRAL) for c in order_cols):
        return None
    shifted = [F.col(c).cast("bigint") + F.lit(2 ** 31) for c in order_cols]   # 0 .. 2^32-1
    if len(shifted) == 1:
        return shifted[0]
    # (hi, lo) -> (hi + 2^30) * 2^32 + (lo + 2^31): order-preserving for |hi| < 2^30
    hi = F.col(order_cols[0]).cast("bigint")
    return F.when(hi.between(-(2 ** 30), 2 ** 30 - 1),
                  F.shiftleft(hi + F.lit(2 ** 30), 32) + shifted[1]) \
        .otherwise(F.raise_error(F.lit("leading key column outside the packable range")).cast("bigint"))


def _bucket_of(x: Column, cuts: list) -> Column:
    """Number of cut points <= x, as a balanced binary search over literal cut points
    (``x`` and the cut points are numbers, or structs compared field by field)."""
    def node(lo: int, hi: int) -> Column:          # the answer lies in [lo, hi]
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi + 1) // 2                   # answer >= mid  <=>  x >= cuts[mid - 1]
        return F.when(x >= cuts[mid - 1], node(mid, hi)).otherwise(node(lo, mid - 1))
    return node(0, len(cuts))


def _ordinal_cuts(rows: DataFrame, ordinal: Column) -> tuple[int, list[int]] | None:
    """(rows, sorted cut points) of a numeric ordinal (None: no rows).

    One aggregate gives the row count and up to ``MAX_BUCKETS - 1`` cut points; only
    above ``TWO_LEVEL_ROWS`` rows a second one picks ``MAX_BUCKETS * FINE_PER_GROUP``."""
    probs = [i / MAX_BUCKETS for i in range(1, MAX_BUCKETS)]
    r = rows.select(F.count(F.lit(1)).alias("n"),
                    F.percentile_approx(ordinal, probs, 10000).alias("q")).first()
    if not r["q"]:
        return None
    if r["n"] <= TWO_LEVEL_ROWS:
        return r["n"], sorted(set(int(v) for v in r["q"]))
    n_cuts = MAX_BUCKETS * FINE_PER_GROUP
    fine = [i / n_cuts for i in range(1, n_cuts)]
    q = rows.select(F.percentile_approx(ordinal, fine, 10 * n_cuts).alias("q")).first()["q"]
    return r["n"], sorted(set(int(v) for v in q))


def _with_two_level_bucket(rows: DataFrame, ordinal: Column, cuts: list[int]) -> DataFrame:
    """``rows`` + ``_bucket`` = number of cut points <= the ordinal.

    Level 1: a binary search over the heads of groups of ``FINE_PER_GROUP`` cut points
    (<= 256, compiled).  Level 2: the group's cut points come from a broadcast join with
    a table of one row per group (<= 256 rows) and are searched as an array column."""
    g = FINE_PER_GROUP
    groups = [cuts[i:i + g] for i in range(0, len(cuts), g)]
    table = rows.sparkSession.createDataFrame(
        [(i + 1, grp + [_PAD] * (g - len(grp))) for i, grp in enumerate(groups)],
        "_g int, _cuts array<bigint>")
    b = rows.withColumn("_x", ordinal)
    b = b.withColumn("_g", _bucket_of(F.col("_x"), [F.lit(grp[0]) for grp in groups]))
    b = b.join(F.broadcast(table), "_g", "left")         # group 0 (below every cut): no row

    def node(lo: int, hi: int) -> Column:                 # cut points of the group <= x
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi + 1) // 2
        return F.when(F.col("_x") >= F.element_at("_cuts", mid), node(mid, hi)).otherwise(node(lo, mid - 1))
    bucket = F.when(F.col("_g") == 0, F.lit(0)).otherwise((F.col("_g") - 1) * g + node(1, g))
    return b.withColumn("_bucket", bucket).drop("_x", "_g", "_cuts")


def _sampled_cuts(rows: DataFrame, order_cols: list[str]) -> list | None:
    """Cut points of any orderable key from a seeded sample of at most
    ``4 * SAMPLE_KEYS`` key tuples, sorted on the driver (None: no rows).  Python orders
    text by code point, as Spark does by UTF-8 bytes; the cut points only steer balance,
    never the keys."""
    n = rows.count()
    if n == 0:
        return None
    fraction = min(1.0, SAMPLE_KEYS / n)
    sample = (rows.select(*order_cols).na.drop().sample(False, fraction, SAMPLE_SEED)
              .limit(4 * SAMPLE_KEYS).collect())
    keys = sorted(set(tuple(r) for r in sample))
    if not keys:
        return []
    step = max(1, len(keys) // MAX_BUCKETS)
    types = {f.name: f.dataType for f in rows.schema.fields}
    picked = keys[step::step][: MAX_BUCKETS - 1]
    return [F.struct(*[F.lit(v).cast(types[c]).alias(c) for c, v in zip(order_cols, k)])
            for k in picked]


def assign_keys(rows: DataFrame, order_cols: list[str], key_col: str,
                start_after: int | Column = 0) -> DataFrame:
    """Add ``key_col`` numbering ``rows`` by ``order_cols`` (which must be unique)."""
    start = start_after if isinstance(start_after, Column) else F.lit(start_after)
    ordinal = _ordinal(rows, order_cols)
    found = _ordinal_cuts(rows, ordinal) if ordinal is not None else None
    cuts = found[1] if found else (None if ordinal is not None else _sampled_cuts(rows, order_cols))
    if cuts is None:
        # no rows: nothing to number (and no constant bucket that would plan a
        # single-partition window)
        return rows.select(*rows.columns, F.lit(None).cast("bigint").alias(key_col))
    if ordinal is not None and found[0] > TWO_LEVEL_ROWS:
        b = _with_two_level_bucket(rows, ordinal, cuts)
    elif ordinal is not None:
        b = rows.withColumn("_bucket", _bucket_of(ordinal, [F.lit(c) for c in cuts]))
    else:
        # (an empty cut list with rows present means all keys are null: one bucket)
        x = F.struct(*[F.col(c).alias(c) for c in order_cols])
        b = rows.withColumn("_bucket", _bucket_of(x, cuts))
    per_bucket = b.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n"))
    rn = F.row_number().over(Window.partitionBy("_bucket").orderBy(*order_cols))
    keyed = b.withColumn("_rn", rn).join(F.broadcast(_offsets(per_bucket, "_bucket")), "_bucket")
    key = start.cast("bigint") + F.col("_off") + F.col("_rn")
    return keyed.select(*rows.columns, key.alias(key_col))
