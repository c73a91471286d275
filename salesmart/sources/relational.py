"""S5, S6 (P1, P2): relational extracts of the historical orders and order lines.

With ``jdbc`` options the table is read through Spark's JDBC source, split into
ranges of ``partition_column`` so executors fetch in parallel (bounds and the number of
ranges, one for each RANGE_ROWS rows, come from one ``min/max/count`` query).  Without them the same table is read from a
Parquet copy (how the tests and the bench feed it: no database is started here).
Either way only the five or seven named columns are selected and renamed to the
canonical names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S

#: rows of one range of a parallel JDBC read
RANGE_ROWS = 1_000_000


def _jdbc(spark: SparkSession, jdbc: dict, table: str, partition_column: str,
          num_partitions: int | None) -> DataFrame:
    base = {"url": jdbc["url"], "fetchsize": str(jdbc.get("fetchsize", 10000))}
    if "query_timeout" in jdbc:
        base["queryTimeout"] = str(jdbc["query_timeout"])
    for k in ("user", "password", "driver"):
        if k in jdbc:
            base[k] = jdbc[k]
    bounds = (spark.read.format("jdbc").options(**base)
              .option("query", f"SELECT MIN({partition_column}) AS lo, MAX({partition_column}) AS hi, "
                               f"COUNT(*) AS n FROM {table}")
              .load().first())
    reader = spark.read.format("jdbc").options(**base).option("dbtable", table)
    if bounds is not None and bounds["lo"] is not None:
        reader = (reader.option("partitionColumn", partition_column)
                  .option("lowerBound", str(bounds["lo"]))
                  .option("upperBound", str(bounds["hi"]))
                  .option("numPartitions", str(num_partitions or max(1, -(-int(bounds["n"]) // RANGE_ROWS)))))
    return reader.load()


def read_relational(spark: SparkSession, table: str, columns: dict[str, str],
                    schema, *, path: str | None = None, jdbc: dict | None = None,
                    partition_column: str | None = None, num_partitions: int | None = None) -> DataFrame:
    """Read ``table`` and return its ``columns`` renamed to canonical names, typed."""
    if jdbc:
        raw = _jdbc(spark, jdbc, table, partition_column or next(iter(columns)), num_partitions)
    elif path:
        raw = spark.read.parquet(path)
    else:
        raise ValueError(f"no JDBC options and no path for relational table {table}")
    types = {f.name: f.dataType for f in schema.fields}
    return raw.select([_present(F.col(src), src, types[dst]).alias(dst) for src, dst in columns.items()])


def _present(col: Column, name: str, dtype) -> Column:
    """A NULL fails the load, as the source's typed getters do."""
    missing = F.raise_error(F.lit(f"relational value missing in column {name}"))
    return F.when(col.isNull(), missing.cast(dtype)).otherwise(col.cast(dtype))


def read_db_orders(spark: SparkSession, **kw) -> DataFrame:
    """PedidoId, ClienteId, FechaPedido, Estado, FechaCreacion -> canonical names."""
    return read_relational(spark, "dbo.Pedidos", S.DB_ORDER_COLUMNS, S.HIST_ORDER,
                           partition_column="PedidoId", **kw)


def read_db_order_details(spark: SparkSession, **kw) -> DataFrame:
    """The seven order-line columns -> canonical names."""
    return read_relational(spark, "dbo.DetallesPedido", S.DB_ORDER_DETAIL_COLUMNS,
                           S.HIST_ORDER_DETAIL, partition_column="DetallePedidoId", **kw)
