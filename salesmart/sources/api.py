"""The JSON product feed, read from landed response pages.

Each landed page is one envelope ``{products: [...], total, skip, limit}``.  Pages are
read in parallel (one JSON document per line by default; ``multiline`` for
pretty-printed one-page files), and ``inline`` turns the
``products`` array into rows.  ``check_coverage`` holds ``total`` and ``skip`` of the
pages against the products they carry, so a lost, doubled or overlapping page fails.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from .csv import strict_value


class FeedCoverageError(ValueError):
    """The landed pages are not exactly the feed they announce."""


def _pages(spark: SparkSession, path: str | list[str], multiline: bool) -> DataFrame:
    return (spark.read.schema(S.API_ENVELOPE)
            .option("mode", "FAILFAST")
            .option("multiLine", multiline)
            .json(path))


def coverage_faults(pages: DataFrame) -> DataFrame:
    """Positions where the pages fail to tile ``0 .. total``: ``pos, starts, ends, total``.

    A page covers ``skip .. skip + size``; pages without products cover nothing.  The pages
    tile the feed if one starts at 0, one ends at ``total``, and at every position between
    as many end as start, one at most.  Each page gives two positions, counted by one
    aggregate: no sort of all pages, no window over them.  A missing ``skip`` or ``total``
    is 0, as the modelled reader takes it.  All pages must announce one total: any other is
    a fault at its own position.
    """
    zero = F.lit(0).cast("bigint")
    page = pages.select(F.coalesce(F.col("skip").cast("bigint"), zero).alias("a"),
                        F.coalesce(F.size("products"), zero).cast("bigint").alias("n"),
                        F.coalesce(F.col("total").cast("bigint"), zero).alias("total"))
    marks = F.when(F.col("n") > 0, F.array(
        F.struct(F.col("a").alias("pos"), F.lit(1).alias("s"), F.lit(0).alias("e"), zero.alias("t")),
        F.struct((F.col("a") + F.col("n")).alias("pos"), F.lit(0).alias("s"), F.lit(1).alias("e"), zero.alias("t"))
    )).otherwise(F.array().cast("array<struct<pos:bigint,s:int,e:int,t:bigint>>"))
    # the announced total is a mark as well: there one page ends and none starts; 0 is
    # marked too, so that a feed without its first page is seen
    ends = F.array(F.struct(F.col("total").alias("pos"), F.lit(0).alias("s"), F.lit(0).alias("e"),
                            F.lit(1).cast("bigint").alias("t")),
                   F.struct(zero.alias("pos"), F.lit(0).alias("s"), F.lit(0).alias("e"), zero.alias("t")))
    by_pos = (page.select(F.inline(F.concat(marks, ends))).groupBy("pos")
              .agg(F.sum("s").alias("starts"), F.sum("e").alias("ends"), F.max("t").alias("total")))
    is_end = F.col("total") > 0
    right = (F.when(is_end & (F.col("pos") == 0), (F.col("starts") == 0) & (F.col("ends") == 0))
             .when(is_end, (F.col("starts") == 0) & (F.col("ends") == 1))
             .when(F.col("pos") == 0, (F.col("starts") == 1) & (F.col("ends") == 0))
             .otherwise((F.col("starts") == 1) & (F.col("ends") == 1)))
    return by_pos.filter(~right).withColumn("total", is_end)


def check_coverage(spark: SparkSession, path: str | list[str], multiline: bool = False) -> None:
    """L1: raise ``FeedCoverageError`` unless the landed pages are the whole feed, once."""
    faults = coverage_faults(_pages(spark, path, multiline)).orderBy("pos").limit(5).collect()
    if faults:
        raise FeedCoverageError("landed pages do not cover the feed: " + "; ".join(
            f"at {r.pos}{' (announced total)' if r.total else ''}: {r.ends} end, {r.starts} start" for r in faults))


def read_api_pages(spark: SparkSession, path: str | list[str], multiline: bool = False) -> DataFrame:
    pages = _pages(spark, path, multiline)
    # a page without products is an empty page (inline of null gives no row)
    items = pages.select(F.inline("products"))
    out = []
    for src, dst in S.API_FIELDS.items():
        c = F.col(src)
        if src in S.API_ITEM_TYPES:
            # a missing number is 0, as in the modelled feed; a malformed one fails
            c = strict_value(F.coalesce(F.trim(c), F.lit("0")), src, S.API_ITEM_TYPES[src], origin="API", thousands=False)
        else:
            c = F.coalesce(c, F.lit(""))                        # T6
        out.append(c.alias(dst))
    return items.select(out)
