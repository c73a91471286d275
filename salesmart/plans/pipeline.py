"""The end-to-end load: extract -> stage -> dimensions -> fact -> load control.

Each step is a set of DataFrame plans; steps hand over through published tables, which
cut lineage and make a lost executor cost at most the step it was running.  Nothing
but counts reaches the driver.
"""

from __future__ import annotations

import datetime as _dt
import logging
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from ..operators import dims as D
from ..operators import staging as K
from ..operators.dedup import dedup_order_lines
from ..operators.facts import (ORPHAN, FactInputs, broadcast_plan, fact_rows, join_details_orders,
                               orphan_lines, resolve_keys, skew_plan, typed_lines, unique_orders)
from ..operators.validate import (REASON, accepted, convert_customers, convert_db_orders,
                                  convert_order_details, convert_orders, convert_products,
                                  raw_rejects)
from ..session import apply_job_conf, size_shuffles
from ..sources.api import check_coverage, read_api_pages
from ..sources.csv import (read_customers_csv, read_order_details_csv, read_orders_csv,
                           read_products_csv)
from ..sources.relational import read_db_order_details, read_db_orders
from .store import TableStore

log = logging.getLogger(__name__)


@dataclass
class SourceConfig:
    """Where the seven extracts come from.

    ``db_*`` take ``{"path": ...}`` (a Parquet copy) or ``{"jdbc": {url, user, ...}}``.
    """
    products_csv: str
    customers_csv: str
    orders_csv: str
    order_details_csv: str
    api_pages: str
    db_orders: dict
    db_order_details: dict
    csv_multiline: bool = False
    api_multiline: bool = False        # pretty-printed feed pages, one document per file
    api_coverage: bool = True          # pages must tile 0 .. total (False for a feed that gives neither)
    staging_jdbc: dict | None = None   # {url, properties}: also bulk-insert staging there (K8)


@dataclass
class RunResult:
    run_id: str
    staged: dict[str, int | None] = field(default_factory=dict)   # rows staged per table
    metrics: list[dict] = field(default_factory=list)


def _now() -> _dt.datetime:
    return _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)


# --- extract ------------------------------------------------------------------------
def extract(spark: SparkSession, src: SourceConfig) -> dict[str, DataFrame]:
    """S1-S7 as lazy typed DataFrames (nothing is read until staging writes).

    Binding CSV columns by header name reads each file's header row first; the seven
    readers are set up concurrently so those small jobs overlap, and so is the check that
    the landed feed pages are complete (L1)."""
    ml = src.csv_multiline

    def feed() -> DataFrame:
        if src.api_coverage:
            check_coverage(spark, src.api_pages, multiline=src.api_multiline)
        return read_api_pages(spark, src.api_pages, multiline=src.api_multiline)
    return _parallel({
        "products": lambda: read_products_csv(spark, src.products_csv, multiline=ml),
        "customers": lambda: read_customers_csv(spark, src.customers_csv, multiline=ml),
        "orders": lambda: read_orders_csv(spark, src.orders_csv, multiline=ml),
        "order_details": lambda: read_order_details_csv(spark, src.order_details_csv, multiline=ml),
        "db_orders": lambda: read_db_orders(spark, **src.db_orders),
        "db_order_details": lambda: read_db_order_details(spark, **src.db_order_details),
        "api_products": feed,
    })


# --- helpers ------------------------------------------------------------------------
def _parallel(tasks: dict[str, Callable[[], object]], threads: int = 8) -> dict[str, object]:
    """Run independent driver-side steps at once; each submits its own Spark jobs,
    labelled with the step's name (job descriptions are per thread)."""
    if not tasks:
        return {}
    from pyspark import SparkContext

    def labelled(name: str, fn: Callable[[], object]):
        def run():
            sc = SparkContext._active_spark_context
            if sc is not None:
                sc.setJobDescription(name)
            return fn()
        return run
    with ThreadPoolExecutor(max_workers=min(threads, len(tasks))) as ex:
        futs = {k: ex.submit(labelled(k, fn)) for k, fn in tasks.items()}
        return {k: f.result() for k, f in futs.items()}


def _count(df: DataFrame | None) -> int:
    """Row count; on a Parquet table this reads only row-group metadata."""
    return 0 if df is None else df.count()


# --- stage --------------------------------------------------------------------------
def stage(store: TableStore, extracts: dict[str, DataFrame]) -> dict[str, int | None]:
    """K1-K9: every non-empty extract becomes the next staging version.

    The seven tables are written concurrently and published only after all writes
    succeeded, so a failed extract (bad CSV value, missing column, empty API envelope)
    leaves every staging table as it was.  An empty extract is never published, so the
    previous rows stay (K9).  Returns rows staged per table (A2; None for a skipped
    table), counted from the written files' metadata.
    """
    def one(table: str, df: DataFrame):
        # write first, publish only a version that holds rows: an empty extract leaves
        # an unpublished (never read) folder and the previous version stays current
        v = store.write_version(f"stg/{table}", K.to_staging(df, table))
        return v, store.read(f"stg/{table}", v, unpublished=True).count()   # metadata count

    written = _parallel({t: (lambda t=t, df=df: one(t, df)) for t, df in extracts.items()})
    for t, (v, n) in written.items():
        if n:
            store.mark(f"stg/{t}", v)
            log.info("staged %s rows into stg.%s", n, t)
        else:
            log.warning("no rows for staging table %s; previous rows kept", t)
    return {t: (n or None) for t, (v, n) in written.items()}


# --- dimensions ---------------------------------------------------------------------
def _publish_dim(store: TableStore, table: str, load: D.DimLoad) -> dict:
    obs = Observation(f"dim_{table.replace('/', '_')}_{uuid.uuid4().hex[:6]}")
    # the change states are counted while the new version is written (one job)
    rows = load.rows.observe(
        obs,
        F.count_if(F.col("state") == D.INSERTED).alias("inserted"),
        F.count_if(F.col("state") == D.UPDATED).alias("updated"),
        F.count_if(F.col("state") == D.UNCHANGED).alias("unchanged"))
    store.publish(table, rows.select(load.columns))
    m = obs.get
    return {"inserted": int(m.get("inserted") or 0), "updated": int(m.get("updated") or 0)}


def _publish_rejects(store: TableStore, name: str, run_id: str, *bad: DataFrame) -> int:
    """Publish this run's rejects (staged text, reason, run id), none included, so that no
    earlier run's remain current.  Returns how many there are, from the files' metadata."""
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), bad)
    v = store.publish(f"etl/rejects/{name}", rows.withColumn("run_id", F.lit(run_id)))
    return store.read(f"etl/rejects/{name}", v).count()


def _dim_source(store: TableStore) -> list[dict]:
    started = _now()
    ins = 0
    if not store.exists("dw/dim_source"):
        store.publish("dw/dim_source", D.dim_source(store.spark))
        ins = len(S.SOURCES)
    return [dict(process="dim_source", source="config", started_at=started, ended_at=_now(),
                 rows_read=len(S.SOURCES), rows_inserted=ins, rows_updated=0, rows_rejected=0)]


def _dim_status_and_date(store: TableStore, stg: dict, run_id: str) -> list[dict]:
    frames, bad = [], []
    if stg["orders"] is not None:
        frames.append(accepted(convert_orders(stg["orders"])))
        bad.append(raw_rejects(stg["orders"], convert_orders))
    if stg["db_orders"] is not None:
        frames.append(accepted(convert_db_orders(stg["db_orders"])).select(
            "OrderID", "CustomerID", "OrderDate", "Status"))
        bad.append(raw_rejects(stg["db_orders"], convert_db_orders))
    if not frames:
        return []
    started = _now()
    # one pass over both order sources; the profile has one row per status
    profile = D.order_profile(*frames).cache()
    try:
        # fill the cache once (and count the rows read) before the two loads share it
        r = _parallel({"profile": profile.count, "o": lambda: _count(stg["orders"]),
                       "d": lambda: _count(stg["db_orders"]),
                       "rej": lambda: _publish_rejects(store, "orders", run_id, *bad)})
        n_read = r["o"] + r["d"]
        loads = _parallel({
            "dim_status": lambda: _publish_dim(store, "dw/dim_status", D.load_dim_status(
                D.status_candidates(profile), store.read("dw/dim_status"))),
            "dim_date": lambda: _publish_dim(store, "dw/dim_date", D.load_dim_date(
                D.date_candidates(profile), store.read("dw/dim_date"))),
        })
    finally:
        profile.unpersist()
    return [dict(process=p, source="stg.orders+stg.db_orders", started_at=started, ended_at=_now(),
                 rows_read=n_read, rows_inserted=m["inserted"], rows_updated=m["updated"],
                 rows_rejected=r["rej"]) for p, m in loads.items()]


def _dim_customer(store: TableStore, stg: dict, run_id: str) -> list[dict]:
    if stg["customers"] is None:
        return []
    started = _now()
    rejected = lambda: _publish_rejects(
        store, "dim_customer", run_id, raw_rejects(stg["customers"], convert_customers))
    load = lambda: _publish_dim(store, "dw/dim_customer", D.load_dim_customer(
        D.customer_members(stg["customers"]), store.read("dw/dim_customer")))
    r = _parallel({"rej": rejected, "n": lambda: _count(stg["customers"]), "m": load})
    return [dict(process="dim_customer", source="stg.customers", started_at=started,
                 ended_at=_now(), rows_read=r["n"], rows_inserted=r["m"]["inserted"],
                 rows_updated=r["m"]["updated"], rows_rejected=r["rej"])]


def _dim_product(store: TableStore, stg: dict, run_id: str) -> list[dict]:
    if stg["products"] is None and stg["api_products"] is None:
        return []
    started = _now()
    empty = store.spark.createDataFrame(
        [], ", ".join(f"{c} string" for c in S.STAGING_COLUMNS["products"]))
    csv = stg["products"] if stg["products"] is not None else empty
    api = stg["api_products"] if stg["api_products"] is not None else empty
    rejected = lambda: _publish_rejects(
        store, "dim_product", run_id, raw_rejects(csv, convert_products), raw_rejects(api, convert_products))
    load = lambda: _publish_dim(store, "dw/dim_product", D.load_dim_product(
        D.product_members(csv, api), store.read("dw/dim_product")))
    r = _parallel({"rej": rejected, "n": lambda: _count(csv) + _count(api), "m": load})
    return [dict(process="dim_product", source="stg.products+stg.api_products",
                 started_at=started, ended_at=_now(), rows_read=r["n"],
                 rows_inserted=r["m"]["inserted"], rows_updated=r["m"]["updated"],
                 rows_rejected=r["rej"])]


DIMENSION_STEPS = {"source": ["dim_source"], "status_date": ["dim_status", "dim_date"],
                   "customer": ["dim_customer"], "product": ["dim_product"]}


def load_dimensions(store: TableStore, run_id: str = "") -> list[dict]:
    """D1-D5 from the current staging versions (S9), loaded concurrently, each published
    as a new version.  A step that fails does not undo the others: its processes carry
    the ``error`` and its exception under ``raised``."""
    stg = _parallel({t: (lambda t=t: store.read(f"stg/{t}")) for t in S.STAGING_COLUMNS})

    def step(name: str, fn: Callable[[], list[dict]]) -> Callable[[], list[dict]]:
        def guarded() -> list[dict]:
            started = _now()
            try:
                return fn()
            except Exception as e:
                return [dict(process=p, started_at=started, ended_at=_now(), error=str(e), raised=e)
                        for p in DIMENSION_STEPS[name]]
        return guarded
    parts = _parallel({name: step(name, fn) for name, fn in {
        "source": lambda: _dim_source(store),
        "status_date": lambda: _dim_status_and_date(store, stg, run_id),
        "customer": lambda: _dim_customer(store, stg, run_id),
        "product": lambda: _dim_product(store, stg, run_id),
    }.items()})
    return [m for k in DIMENSION_STEPS for m in parts[k]]


# --- fact ---------------------------------------------------------------------------
def load_facts(store: TableStore, run_id: str = "") -> list[dict]:
    """K10 + K11 as one publish: the new fact version replaces the old one atomically.

    The read, rejected, duplicate, inserted and unknown-key counts are observed inside
    the one write job (A8), without extra passes over the data.
    """
    details, orders = store.read("stg/order_details"), store.read("stg/orders")
    if details is None or orders is None:
        raise RuntimeError("fact load needs staged order details and orders")
    started = _now()
    inp = FactInputs(details=details, orders=orders,
                     dim_date=store.read("dw/dim_date"), dim_customer=store.read("dw/dim_customer"),
                     dim_product=store.read("dw/dim_product"), dim_status=store.read("dw/dim_status"),
                     dim_source=store.read("dw/dim_source"))
    pre = _parallel({"before": lambda: _count(store.read("dw/fact_sales")),     # K10 report
                     "broadcast": lambda: broadcast_plan(inp),
                     "details_rows": lambda: _count(details), "orders_rows": lambda: _count(orders)})
    inp.broadcast = pre["broadcast"]
    inp.hot = skew_plan(inp, pre["details_rows"], pre["orders_rows"])

    o_lines, o_unique, o_joined, o_fact = (Observation(f"{n}_{uuid.uuid4().hex[:6]}")
                                           for n in ("lines", "unique", "joined", "fact"))
    lines = typed_lines(details).observe(
        o_lines, F.count(F.lit(1)).alias("read"),
        F.count_if(F.col(REASON).isNotNull()).alias("rejected"))
    unique = dedup_order_lines(accepted(lines), by_order=not inp.hot.get("order")).observe(o_unique, F.count(F.lit(1)).alias("n"))
    joined = join_details_orders(unique, unique_orders(orders), inp.hot.get("order")).observe(
        o_joined, F.count_if(F.col(REASON) == ORPHAN).alias("orphans"))
    fact = fact_rows(resolve_keys(joined.filter(F.col(REASON).isNull()), inp))
    keys = ["date_key", "customer_key", "product_key", "status_key", "source_key"]
    fact = fact.observe(o_fact, F.count(F.lit(1)).alias("n"),
                        *[F.count_if(F.col(k) == S.UNKNOWN_KEY).alias(f"unknown_{k}") for k in keys])
    # partitioned by order year (not by day): year-range reads prune files at scale
    year = F.when(F.col("date_key") > 0, (F.col("date_key") / 10000).cast("int")).otherwise(F.lit(-1))
    # rows of a year are brought together first (AQE splits large years, merges small ones):
    # few files a year, however many tasks the joins have
    rows = fact.select(*S.FACT_COLUMNS, year.alias("order_year")).hint("rebalance", "order_year")
    v = store.publish("dw/fact_sales", rows, partition_by=["order_year"])

    ml, mu, mj, mf = o_lines.get, o_unique.get, o_joined.get, o_fact.get
    read, bad, uniq, orphans = (int(ml["read"]), int(ml["rejected"]), int(mu["n"]), int(mj["orphans"]))
    # Observations in shuffle-map stages may count twice if a stage is retried after a
    # lost executor; the totals are checked against exact metadata counts and, if they
    # disagree, the split is recounted exactly (an extra pass only in that case).
    exact_read, exact_ins = pre["details_rows"], _count(store.read("dw/fact_sales", v))
    if read != exact_read or int(mf["n"]) != exact_ins or uniq - orphans != exact_ins:
        log.warning("observed fact counts disagree with the written data; recounting")
        read, bad, uniq, orphans = _exact_fact_counts(details, orders)
        mf = dict(mf, n=exact_ins)
    rejected = bad + orphans
    dropped = read - bad - uniq
    # lines that do not convert: one scan; lines without an order: joined again only if
    # there are any
    _publish_rejects(store, "fact_sales", run_id, raw_rejects(details, convert_order_details),
                     *([orphan_lines(details, orders)] if orphans else []))
    return [dict(process="fact_sales", source="stg.order_details", started_at=started,
                 rows_read=read, rows_inserted=int(mf["n"]), rows_updated=0,
                 rows_rejected=rejected, rows_dropped_duplicates=dropped,
                 rows_before_clean=pre["before"], rows_after_clean=0,
                 unknown_keys=sum(int(mf[f"unknown_{k}"]) for k in keys))]


def _exact_fact_counts(details: DataFrame, orders: DataFrame) -> tuple[int, int, int, int]:
    """read, rejected by F1, unique lines, orphans - as plain aggregates (exact)."""
    lines = typed_lines(details)
    unique = dedup_order_lines(accepted(lines))
    joined = join_details_orders(unique, unique_orders(orders))
    r = _parallel({
        "lines": lambda: lines.agg(F.count(F.lit(1)), F.count_if(F.col(REASON).isNotNull())).first(),
        "unique": lambda: unique.count(),
        "orphans": lambda: joined.filter(F.col(REASON) == ORPHAN).count(),
    })
    return int(r["lines"][0]), int(r["lines"][1]), int(r["unique"]), int(r["orphans"])


# --- orchestration ------------------------------------------------------------------
def _control_rows(spark: SparkSession, run_id: str, metrics: list[dict]) -> DataFrame:
    rows = []
    for m in metrics:
        state = S.STATE_FAILED if m.get("error") else S.STATE_STARTED if not m.get("ended_at") else (
            S.STATE_COMPLETED_WITH_ERRORS if m.get("rows_rejected") else S.STATE_COMPLETED)
        rows.append((run_id, m.get("source"), m["process"], m.get("started_at"),
                     m.get("ended_at"), state, m.get("rows_read"), m.get("rows_inserted"),
                     m.get("rows_updated"), m.get("rows_rejected"), m.get("error"),
                     m.get("rows_dropped_duplicates"), m.get("unknown_keys"),
                     m.get("rows_before_clean"), m.get("rows_after_clean")))
    return spark.createDataFrame(rows, S.LOAD_CONTROL)


RETIRED_TABLES = ["stg/" + t for t in S.STAGING_COLUMNS] + [
    "dw/dim_source", "dw/dim_status", "dw/dim_date", "dw/dim_customer", "dw/dim_product",
    "dw/fact_sales", "etl/rejects/fact_sales", "etl/rejects/dim_customer",
    "etl/rejects/dim_product", "etl/rejects/orders"]


def _input_bytes(spark: SparkSession, src: SourceConfig) -> int:
    """Bytes of the file sources (relational sources read over JDBC are not counted)."""
    from .. import fs
    paths = [src.products_csv, src.customers_csv, src.orders_csv, src.order_details_csv,
             src.api_pages, src.db_orders.get("path"), src.db_order_details.get("path")]
    return sum(fs.size_of(spark, p) for p in paths if p)


def run(spark: SparkSession, sources: SourceConfig, warehouse: str,
        run_id: str | None = None, keep_versions: int | None = None) -> RunResult:
    """Run the whole load once.  Every process gets a STARTED row before it begins and a
    row with its outcome; a failure is recorded with its whole message and re-raised.
    Dimensions that were published before another failed stay published.

    ``keep_versions`` (optional, >= 2 recommended) retires older table versions after a
    successful run; by default every version is kept."""
    apply_job_conf(spark)
    size_shuffles(spark, _input_bytes(spark, sources))
    store = TableStore(spark, warehouse)
    res = RunResult(run_id=run_id or uuid.uuid4().hex)
    run_started = _now()
    step, failed = "extract", False

    def begin(processes: list[str]) -> None:
        """STARTED rows; they stay current if the driver dies before the end is recorded."""
        store.append_load_control(_control_rows(spark, res.run_id, [
            dict(process=p, started_at=_now()) for p in processes]))

    def record(metrics: list[dict]) -> None:
        res.metrics.extend(metrics)
        store.append_load_control(_control_rows(spark, res.run_id, metrics))

    try:
        t = _now()
        res.staged = stage(store, extract(spark, sources))
        if sources.staging_jdbc:
            _parallel({table: (lambda table=table: K.write_staging_jdbc(
                store.read(f"stg/{table}"), sources.staging_jdbc["url"], f"stg.{table}",
                sources.staging_jdbc.get("properties"))) for table, n in res.staged.items() if n})
        log.info("extract + stage: %.2f s", (_now() - t).total_seconds())
        step, t = "dimensions", _now()
        begin([p for ps in DIMENSION_STEPS.values() for p in ps])
        done = load_dimensions(store, res.run_id)
        record(done)
        for m in done:
            if "raised" in m:
                failed = True                   # recorded already, process by process
                raise m["raised"]
        log.info("dimensions: %.2f s", (_now() - t).total_seconds())
        step, t = "fact_sales", _now()
        begin([step])
        done = load_facts(store, res.run_id)
        for m in done:
            m["ended_at"] = _now()
        record(done)
        log.info("fact: %.2f s", (_now() - t).total_seconds())
    except Exception as e:  # record, then fail the run
        if not failed:
            record([dict(process=step, started_at=run_started, ended_at=_now(), error=str(e))])
        raise
    if keep_versions:
        for t in RETIRED_TABLES:
            store.retire(t, keep_versions)
    return res
