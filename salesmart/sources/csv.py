"""CSV extracts bound by trimmed header name, strict like the source loader.

Files are read in groups of equal headers, so folders may mix column orders.  The
reader runs without a schema (a CSV schema binds by *position* and would swap
reordered columns silently), trims header names, selects the model's columns by name and
converts with ANSI casts, so a bad or missing value fails the load.  Extra columns are
ignored; a missing column raises ``UNRESOLVED_COLUMN``.
"""

from __future__ import annotations

import csv
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import fs
from .. import schemas as S
from ..schemas import DATE_FORMATS


def strict_value(col: Column, name: str, dtype: T.DataType, origin: str = "CSV",
                 thousands: bool = True) -> Column:
    """Text -> ``dtype``; a missing or unconvertible value fails the load.

    The failure is explicit (``raise_error``), so it does not depend on the session's
    ANSI setting.  ``thousands`` accepts ``1,234.50`` in decimals (CSV number text)."""
    missing = F.raise_error(F.lit(f"{origin} value missing in column {name}"))
    bad = F.raise_error(F.concat(F.lit(f"{origin} value not a {dtype.simpleString()} in column {name}: "),
                                 col))
    if isinstance(dtype, T.DateType):
        value = F.coalesce(*[F.try_to_date(col, f) for f in DATE_FORMATS])
    elif isinstance(dtype, T.DecimalType) and thousands:
        value = F.replace(col, F.lit(","), F.lit("")).try_cast(dtype)
    else:
        value = col.try_cast(dtype)
    return (F.when(col.isNull(), missing).when(value.isNull(), bad).otherwise(value)
            .cast(dtype).alias(name))


def _strict(col: Column, name: str, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.StringType):
        return F.coalesce(col, F.lit("")).alias(name)            # T6
    return strict_value(col, name, dtype)


def read_csv(spark: SparkSession, path: str | list[str], schema: T.StructType,
             multiline: bool = False) -> DataFrame:
    """Read CSV file(s) with a header row into the typed ``schema`` (by column name).

    ``multiline`` allows line breaks inside quoted cells; it makes each file one
    split, so it is off by default to keep large files parallel.
    """
    reader = (spark.read
              .option("header", True)
              .option("inferSchema", False)
              .option("enforceSchema", False)      # a header unlike its group's fails
              .option("ignoreLeadingWhiteSpace", True)
              .option("ignoreTrailingWhiteSpace", True)
              .option("mode", "FAILFAST")
              .option("escape", '"')
              .option("multiLine", multiline))
    parts = []
    for files in _by_header(spark, [path] if isinstance(path, str) else list(path)):
        raw = reader.csv(files)
        raw = raw.toDF(*[c.strip() for c in raw.columns])
        parts.append(raw.select([_strict(F.col(f"`{f.name}`"), f.name, f.dataType) for f in schema.fields]))
    return reduce(DataFrame.unionByName, parts)


def _by_header(spark: SparkSession, paths: list[str]) -> list[list[str]]:
    """The files at ``paths`` in groups of equal headers.  Spark takes the names of all
    files of a reader from one header and binds the others by position, so files with
    another column order need a reader of their own.  A missing path fails (S8); a file
    without a header line has no rows; only first lines are read here, concurrently."""
    groups: dict[tuple, list[str]] = {}
    found = []
    for path in paths:
        files = fs.data_files(spark, path)
        if not files and not fs.exists(spark, path):
            raise FileNotFoundError(f"CSV input not found: {path}")
        found += sorted(s.getPath().toString() for s in files if s.getLen() > 0)
    with ThreadPoolExecutor(max_workers=16) as pool:
        lines = list(pool.map(lambda f: fs.first_line(spark, f), found))
    for file, line in zip(found, lines):
        names = next(csv.reader([line.lstrip("\ufeff")]), [])
        if names:
            groups.setdefault(tuple(n.strip() for n in names), []).append(file)
    return list(groups.values()) or [paths]


def read_products_csv(spark: SparkSession, path, **kw) -> DataFrame:
    return read_csv(spark, path, S.PRODUCT, **kw)


def read_customers_csv(spark: SparkSession, path, **kw) -> DataFrame:
    return read_csv(spark, path, S.CUSTOMER, **kw)


def read_orders_csv(spark: SparkSession, path, **kw) -> DataFrame:
    return read_csv(spark, path, S.ORDER, **kw)


def read_order_details_csv(spark: SparkSession, path, **kw) -> DataFrame:
    return read_csv(spark, path, S.ORDER_DETAIL, **kw)
