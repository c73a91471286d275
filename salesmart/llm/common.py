"""Helpers shared by the operators: text defaults, scratch tables, components."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesmart.session import checkpoint_root, scratch_path

#: The words of a text: runs without space, tab, line ends, vertical tab and form feed.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def text_of(col: str | Column = "text") -> Column:
    """The text column as a string, null as the empty text."""
    return F.coalesce((F.col(col) if isinstance(col, str) else col).cast("string"), F.lit(""))


def free_name(columns: list[str], name: str) -> str:
    """``name``, made longer until no column has it."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def packed(columns: list[str]) -> Column:
    """The columns as one struct, so that none of them clashes with a step's own."""
    return F.struct(*[F.col(f"`{c}`") for c in columns])


def schema_with(df: DataFrame, ddl: str) -> T.StructType:
    """The schema of ``df`` with further columns."""
    return T.StructType(df.schema.fields + T.StructType.fromDDL(ddl).fields)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet below ``spark.checkpoint.dir`` and read back, so a
    later stage neither recomputes it nor depends on one executor's disk."""
    spark = df.sparkSession
    path = scratch_path(spark, "llm", name, fresh=True)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_of(spark: SparkSession, partitions: int) -> Iterator[None]:
    """Jobs started inside shuffle into at least so many partitions, and small ones are
    not merged: for steps whose memory grows with a partition's rows, not its bytes."""
    wanted = {"spark.sql.shuffle.partitions": str(max(partitions, int(spark.conf.get("spark.sql.shuffle.partitions")))),
              "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Rows of text go to Python in batches of at most so many, from here on in the session
    (smaller ones that the session asks for stay): a batch is held whole on both sides."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= rows:
        spark.conf.set(key, str(rows))


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` with its lineage cut by a reliable checkpoint."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def components(edges: DataFrame) -> DataFrame:
    """Connected components of the undirected edges (u, v) of any orderable type:
    (node, root) with root the smallest node of the component, for every node with an
    edge to another.  Null ends and loops are ignored.

    Alternating large-star and small-star steps (Kiveris et al., 2014): each step is a
    grouped minimum with map-side partials and a join, so a node with very many
    neighbours is never gathered, and about log(n) steps are needed."""
    e = edges.select("u", "v").where("u IS NOT NULL AND v IS NOT NULL AND u <> v")
    e = checkpointed(e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    state = _state(e)
    while state[0]:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u <> v").distinct())
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        e = (small.where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
             .unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        e = checkpointed(e)
        new = _state(e)
        if new == state:
            break
        state = new
    return (e.select(F.col("u").alias("node"), F.col("v").alias("root"))
            .unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()))


def _state(e: DataFrame) -> tuple:
    """Count and two order-free checksums of an edge set: equal sets give equal states."""
    h = F.xxhash64("u", "v").cast("decimal(38,0)")
    g = F.hash("v", "u").cast("long")
    r = e.agg(F.count("*").alias("n"), F.sum(h).alias("h"), F.sum(g).alias("g")).first()
    return r["n"], r["h"], r["g"]
