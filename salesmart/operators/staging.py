"""Staging as text, full refresh, empty extracts skipped."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions.text import as_text

log = logging.getLogger(__name__)

# canonical column -> staging column, for the tables whose staging names differ
_RENAMES = {
    "db_orders": {v: k for k, v in S.DB_ORDER_COLUMNS.items()},
    "db_order_details": {v: k for k, v in S.DB_ORDER_DETAIL_COLUMNS.items()},
}


def to_staging(df: DataFrame, table: str) -> DataFrame:
    """Render a typed extract as the all-text staging rows of ``table``."""
    renames = _RENAMES.get(table, {})
    types = {f.name: f.dataType for f in df.schema.fields}
    by_stage_name = {renames.get(c, c): c for c in types}
    cols = []
    for name in S.STAGING_COLUMNS[table]:
        src = by_stage_name[name]
        cols.append(as_text(F.col(src), types[src]).alias(name))
    return df.select(cols)


def write_staging(store, table: str, staged: DataFrame) -> bool:
    """K8/K9: publish ``staged`` as the new version of ``stg/<table>``.

    An empty extract is skipped with a warning *before* anything is replaced, so the
    previous staging rows stay.  Returns whether a new version was published.
    """
    if staged.isEmpty():
        log.warning("no rows for staging table %s; previous rows kept", table)
        return False
    store.publish(f"stg/{table}", staged)
    return True


def write_staging_jdbc(staged: DataFrame, url: str, table: str, properties: dict | None = None,
                       batch_size: int = 5000) -> bool:
    """K8 for a relational staging target: truncate and bulk insert by column name.

    ``truncate`` keeps the table definition, ``batchsize`` groups inserts like the
    modelled bulk copy, and every task inserts its own partition in parallel.  An empty
    extract is skipped before the truncate (K9).
    """
    if staged.isEmpty():
        log.warning("no rows for staging table %s; previous rows kept", table)
        return False
    (staged.write.format("jdbc")
     .option("url", url).option("dbtable", table)
     .option("truncate", True).option("batchsize", batch_size)
     .options(**(properties or {}))
     .mode("overwrite").save())
    return True
