"""Dimension key lookups, with broadcast only behind a checked size bound."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import UNKNOWN_KEY

log = logging.getLogger(__name__)

# Row bounds under which a dimension is broadcast.  Calendar, status and source
# dimensions are small by nature; customer and product dimensions are checked at run
# time and fall back to a shuffled (AQE skew-aware) join above the bound.
SMALL_DIM_ROWS = 100_000
WIDE_DIM_ROWS = 1_000_000


def fits(df: DataFrame, max_rows: int) -> bool:
    """True when ``df`` has at most ``max_rows`` rows.

    A plain ``count`` aggregates partially on every task (one number each) and, on the
    Parquet tables lookups read, touches only row-group metadata.  (``limit(n).count()``
    would instead shuffle up to n rows per task into a single partition.)"""
    return df.count() <= max_rows


def bounded_broadcast(df: DataFrame, max_rows: int) -> DataFrame:
    if fits(df, max_rows):
        return F.broadcast(df)
    log.info("dimension above %d rows: shuffled join", max_rows)
    return df


def lookup(facts: DataFrame, dim: DataFrame, on: dict[str, str], key_col: str,
           max_rows: int | None = None, broadcast: bool | None = None,
           hot: list | None = None, hot_col: str | None = None) -> DataFrame:
    """Left-join ``dim`` on ``on`` (fact column -> dim column) and add ``key_col``.

    Unmatched rows get the unknown member key.  ``dim`` must be unique on the
    ``on`` columns (dimensions are, by construction), so the fact keeps its row count.
    When the dimension is not broadcast, fact rows of ``hot`` values of ``hot_col``
    are spread over the shuffle (``skew.spread_join``).
    """
    from .skew import spread_join
    names = list(on)
    sel = [F.col(d).alias(f"_lk_{i}") for i, d in enumerate(on.values())]
    right = dim.select(*sel, F.col(key_col).alias(f"_lk_{key_col}"))
    is_broadcast = bool(broadcast) or (broadcast is None and max_rows is not None and fits(right, max_rows))
    if is_broadcast:
        right = F.broadcast(right)

    out = spread_join(facts, right, {c: f"_lk_{i}" for i, c in enumerate(names)},
                      None if is_broadcast else hot_col, hot)
    return out.select(*facts.columns, F.coalesce(F.col(f"_lk_{key_col}"), F.lit(UNKNOWN_KEY)).alias(key_col))
