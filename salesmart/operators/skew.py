"""Hot-key handling for many-to-one joins (a line side against a unique-key side).

A key may hold a large share of one side (one order with a third of all lines).  A
shuffled join would send all of it to one task, and AQE's own skew split does not apply
when the unique side comes straight out of a de-duplication that the join reuses.  So:

1. ``hot_keys`` finds the keys holding more than ``share`` of the rows from a seeded
   sample (a pass over one column, partial aggregation before the shuffle).  At most
   ``1/share`` keys can qualify, so the list brought to the driver is bounded.
2. ``spread_join`` is one shuffled left join in which rows of hot (and null) keys carry a
   salt that matches nothing and so spread over all tasks; their values come from a
   broadcast of just the hot rows of the unique side (at most one per hot key).

The same route runs at every size; it never changes the result, only where the work runs.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed parameters of the hot-key rule
HOT_SHARE = 0.001          # a key is hot above 0.1 % of the rows
SAMPLE_FRACTION = 0.01     # share of rows sampled to find hot keys
SAMPLE_SEED = 17
SALTS = 1 << 20            # values that spread hot rows over the shuffle's partitions


def hot_keys(df: DataFrame, col: Column | str, total_rows: int, share: float | None = None,
             fraction: float | None = None) -> list:
    """Values of ``col`` holding more than ``share`` of ``total_rows`` (estimated)."""
    share = HOT_SHARE if share is None else share
    fraction = SAMPLE_FRACTION if fraction is None else fraction
    c = F.col(col) if isinstance(col, str) else col
    threshold = max(2.0, total_rows * fraction * share)
    max_keys = int(1 / share)
    cand = (df.select(c.alias("k")).sample(False, fraction, SAMPLE_SEED)
            .filter(F.col("k").isNotNull())
            .groupBy("k").agg(F.count(F.lit(1)).alias("n"))
            .filter(F.col("n") >= threshold)
            .orderBy(F.col("n").desc()).limit(max_keys))
    return [r["k"] for r in cand.collect()]


def spread_join(big: DataFrame, small: DataFrame, on: dict[str, str], hot_col: str | None = None,
                hot: list | None = None) -> DataFrame:
    """``big`` left-joined with ``small`` on ``on`` (big column -> small column): all
    columns of both.  ``small`` must hold at most one row per key and share no column
    name with ``big``; ``hot`` are values of ``hot_col``, one of the joined columns."""
    def match(right: DataFrame, prefix: str = "") -> Column:
        return reduce(lambda a, b: a & b, [F.col(l) == right[prefix + r] for l, r in on.items()])
    if not hot or hot_col is None:
        return big.join(small, match(small), "left")
    is_hot = F.col(hot_col).isin(hot)
    salt = F.when(is_hot | F.col(hot_col).isNull(), 1 + F.pmod(F.xxhash64(*big.columns), F.lit(SALTS))).otherwise(0)
    left = big.withColumn("_salt", salt.cast("long"))
    right = small.withColumn("_zero", F.lit(0).cast("long"))
    joined = left.join(right, match(right) & (F.col("_salt") == F.col("_zero")), "left").drop("_salt", "_zero")
    few = small.filter(F.col(on[hot_col]).isin(hot)).select([F.col(c).alias(f"_hot_{c}") for c in small.columns])
    joined = joined.join(F.broadcast(few), match(few, "_hot_"), "left")        # <= len(hot) rows
    return joined.select(*big.columns, *[F.coalesce(c, f"_hot_{c}").alias(c) for c in small.columns])
