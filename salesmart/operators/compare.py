"""Compare the CSV extracts with the historical relational source key by key.

A full outer join on the shared key classifies every key as ``match`` (all compared
values equal, NULL-safe), ``differs``, ``only_csv`` or ``only_db``.  ``digests`` keeps the join to the
key buckets that differ.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MATCH, DIFFERS, ONLY_CSV, ONLY_DB = "match", "differs", "only_csv", "only_db"


def compare(left: DataFrame, right: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """Per-key comparison: keys + ``state``."""
    l = left.select(*keys, *[F.col(v).alias(f"_l_{v}") for v in values], F.lit(True).alias("_l"))
    r = right.select(*keys, *[F.col(v).alias(f"_r_{v}") for v in values], F.lit(True).alias("_r"))
    j = l.join(r, keys, "full_outer")
    same = F.lit(True)
    for v in values:
        same = same & F.col(f"_l_{v}").eqNullSafe(F.col(f"_r_{v}"))
    state = (F.when(F.col("_r").isNull(), F.lit(ONLY_CSV))
             .when(F.col("_l").isNull(), F.lit(ONLY_DB))
             .when(same, F.lit(MATCH))
             .otherwise(F.lit(DIFFERS)))
    return j.select(*keys, state.alias("state"))
