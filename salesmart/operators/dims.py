"""Conformed dimensions, loaded incrementally.

A dimension load compares the incoming members with the current version on the
natural key (full outer join, J9): new members are inserted with fresh surrogate keys
(D6), members whose attributes changed are updated in place (type 1), the rest are
kept.  Members absent from the new extract are not deleted.  Loading the same input
twice inserts 0 and updates 0, and keys never move.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas as S
from ..functions.calendar import calendar_columns
from ..functions.clean import clean_key_text
from .dedup import dedup_members
from .keys import assign_keys
from .validate import accepted, convert_customers, convert_products

INSERTED, UPDATED, UNCHANGED, KEPT = "inserted", "updated", "unchanged", "kept"


UNKNOWN_STATE = "unknown_member"


@dataclass
class DimLoad:
    """Result of a dimension load.

    ``rows`` is the complete next version (unknown member included) with one extra
    column, ``state``: inserted / updated / unchanged for incoming members, kept for
    current members absent from the extract.  Writers count the states with an
    ``Observation`` in the same job and drop the column (``table``).
    """
    rows: DataFrame
    columns: list[str]

    @property
    def table(self) -> DataFrame:
        return self.rows.select(self.columns)

    def counts(self) -> DataFrame:
        """J9 counts: state, n (incoming rows only: inserted, updated, unchanged)."""
        return (self.rows.filter(F.col("state").isin(INSERTED, UPDATED, UNCHANGED))
                .groupBy("state").agg(F.count(F.lit(1)).alias("n")))


def _unknown_row(spark: SparkSession, schema: T.StructType, key_cols: list[str]) -> DataFrame:
    vals = []
    for f in schema.fields:
        if f.name in key_cols:
            vals.append(S.UNKNOWN_KEY)
        elif isinstance(f.dataType, T.StringType):
            vals.append(S.UNKNOWN_TEXT)
        else:
            vals.append(None)
    nullable = T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])
    return spark.createDataFrame([tuple(vals)], nullable)


def upsert(incoming: DataFrame, current: DataFrame | None, key_col: str,
           natural: list[str], attrs: list[str], unknown_keys: list[str]) -> DimLoad:
    """Merge de-duplicated ``incoming`` members into ``current`` (type 1, no deletes)."""
    spark = incoming.sparkSession
    inc = incoming.select(*natural, *attrs)
    cols = [key_col, *natural, *attrs]
    if current is None:
        # first load: every member is new; no comparison join is needed
        new = assign_keys(inc, natural, key_col, start_after=0).withColumn("state", F.lit(INSERTED))
        new = new.select(F.col(key_col).cast("bigint").alias(key_col), *natural, *attrs, "state")
        unknown = _unknown_row(spark, new.select(cols).schema, [key_col, *unknown_keys])
        rows = new.unionByName(unknown.withColumn("state", F.lit(UNKNOWN_STATE)))
        return DimLoad(rows=rows, columns=cols)
    current = current.select(key_col, *natural, *attrs)
    max_key = current.agg(F.max(key_col)).first()[0] or 0
    max_key = max(int(max_key), 0)
    cur = current.filter(F.col(key_col) != S.UNKNOWN_KEY)

    j = (cur.select(key_col, *natural, *[F.col(a).alias(f"_cur_{a}") for a in attrs])
         .join(inc.select(*natural, *[F.col(a).alias(f"_new_{a}") for a in attrs],
                          F.lit(True).alias("_in")),
               natural, "full_outer"))
    same = F.lit(True)
    for a in attrs:
        same = same & F.col(f"_cur_{a}").eqNullSafe(F.col(f"_new_{a}"))
    state = (F.when(F.col(key_col).isNull(), F.lit(INSERTED))
             .when(F.col("_in").isNull(), F.lit(KEPT))
             .when(same, F.lit(UNCHANGED))
             .otherwise(F.lit(UPDATED)))
    j = j.withColumn("state", state)

    take_new = F.col("state").isin(INSERTED, UPDATED)
    merged = j.select(F.col(key_col).cast("bigint").alias(key_col), *natural,
                      *[F.when(take_new, F.col(f"_new_{a}")).otherwise(F.col(f"_cur_{a}")).alias(a)
                        for a in attrs], "state")
    old = merged.filter(F.col("state") != INSERTED)
    new = assign_keys(merged.filter(F.col("state") == INSERTED).drop(key_col),
                      natural, key_col, start_after=max_key)
    unknown = _unknown_row(spark, old.select(cols).schema, [key_col, *unknown_keys])
    rows = (old.unionByName(new.select(old.columns))
            .unionByName(unknown.withColumn("state", F.lit(UNKNOWN_STATE))))
    return DimLoad(rows=rows, columns=cols)


# --- D1 ---------------------------------------------------------------------------
def dim_source(spark: SparkSession) -> DataFrame:
    """The data sources (a fixed list) and the unknown member."""
    schema = "source_key int, source_name string, source_type string"
    rows = [*S.SOURCES, (S.UNKNOWN_KEY, S.UNKNOWN_TEXT, S.UNKNOWN_TEXT)]
    return spark.createDataFrame(rows, schema)


# --- D2, D3 -----------------------------------------------------------------------------
def order_profile(*order_frames: DataFrame) -> DataFrame:
    """One pass over the order sources -> cleaned status, first/last date, rows.

    One row per distinct status (a null status included), so the result is tiny and
    feeds both the status and the date dimension; the aggregation is partial on every
    map task, so a status holding most orders costs no more than any other.
    """
    out = None
    for df in order_frames:
        s = df.select(clean_key_text("Status").alias("status"), F.col("OrderDate").alias("d"))
        out = s if out is None else out.unionByName(s)
    return out.groupBy("status").agg(F.min("d").alias("lo"), F.max("d").alias("hi"),
                                     F.count(F.lit(1)).alias("n"))


def status_candidates(profile: DataFrame) -> DataFrame:
    """Distinct cleaned statuses (from ``order_profile``)."""
    return profile.filter(F.col("status").isNotNull()).select("status")


def load_dim_status(candidates: DataFrame, current: DataFrame | None) -> DimLoad:
    return upsert(candidates, current, "status_key", ["status"], [], [])


def date_candidates(profile: DataFrame) -> DataFrame:
    """Every day from the first to the last order date (from ``order_profile``).

    ``sequence`` expands min..max inside the plan, so the output is bounded by the
    calendar span, not by the number of orders.
    """
    span = profile.agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).filter(F.col("lo").isNotNull())
    days = span.select(F.explode(F.sequence("lo", "hi", F.expr("interval 1 day"))).alias("date"))
    return days.select(calendar_columns("date"))


def load_dim_date(candidates: DataFrame, current: DataFrame | None) -> DimLoad:
    """Dates are keyed by ``yyyymmdd``: insert the days not yet present."""
    spark = candidates.sparkSession
    cols = S.DIM_DATE_COLUMNS
    if current is None:
        cur = spark.createDataFrame([], candidates.schema)
    else:
        cur = current.filter(F.col("date_key") != S.UNKNOWN_KEY).select(cols)
    # the calendar attributes of a day never change: present days are unchanged
    inc = candidates.select("date_key", F.lit(True).alias("_in"))
    cur_state = (cur.join(inc, "date_key", "left")
                 .withColumn("state", F.when(F.col("_in"), F.lit(UNCHANGED)).otherwise(F.lit(KEPT)))
                 .select(*cols, "state"))
    new = (candidates.join(cur.select("date_key"), "date_key", "left_anti")
           .select(*cols, F.lit(INSERTED).alias("state")))
    unknown = _unknown_row(spark, candidates.select(cols).schema, ["date_key"])
    rows = (cur_state.unionByName(new)
            .unionByName(unknown.withColumn("state", F.lit(UNKNOWN_STATE))))
    return DimLoad(rows=rows, columns=cols)


# --- D4 ---------------------------------------------------------------------------
def customer_members(staged_customers: DataFrame) -> DataFrame:
    """P6 -> P7 -> F1 -> W2: one clean row per (source_key, customer_id)."""
    good = accepted(convert_customers(staged_customers)).withColumn("source_key", F.lit(S.SOURCE_CSV))
    return dedup_members(good, ["source_key", "customer_id"], S.DIM_CUSTOMER_ATTRS)


def load_dim_customer(members: DataFrame, current: DataFrame | None) -> DimLoad:
    return upsert(members, current, "customer_key", ["source_key", "customer_id"],
                  S.DIM_CUSTOMER_ATTRS, ["source_key", "customer_id"])


# --- D5 ---------------------------------------------------------------------------
def product_members(staged_csv: DataFrame, staged_api: DataFrame) -> DataFrame:
    """CSV and API products tagged with their source, converted, de-duplicated.

    The same id from two sources stays two members (natural key = source, id).
    """
    csv = accepted(convert_products(staged_csv)).withColumn("source_key", F.lit(S.SOURCE_CSV))
    api = accepted(convert_products(staged_api)).withColumn("source_key", F.lit(S.SOURCE_API))
    both = csv.unionByName(api)
    return dedup_members(both, ["source_key", "product_id"], S.DIM_PRODUCT_ATTRS)


def load_dim_product(members: DataFrame, current: DataFrame | None) -> DimLoad:
    return upsert(members, current, "product_key", ["source_key", "product_id"],
                  S.DIM_PRODUCT_ATTRS, ["source_key", "product_id"])


def new_members(incoming: DataFrame, current: DataFrame, natural: list[str]) -> DataFrame:
    """Incoming members whose natural key is not in ``current``."""
    return incoming.join(current.select(*natural), natural, "left_anti")
