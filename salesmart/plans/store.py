"""Versioned Parquet tables with an atomic switch, plus the append-only load control.

Each publish writes a complete new folder ``<table>/v<NNNNNNNN>``; once the write job
has committed (every task done) the driver adds a ``_PUBLISHED`` marker, and readers
take the highest marked version.  A failed or half-written version is never read, a table being
read is never overwritten in place, and readers keep the previous version until the
switch.  Published tables also cut the lineage between load steps.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import fs
from .. import schemas as S

_PREFIX = "v"
_MARKER = "_PUBLISHED"
_SCHEMA = "_schema.json"


class TableStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def versions(self, table: str) -> list[int]:
        """Published versions of ``table``, oldest first (one glob call, however many
        versions exist)."""
        names = fs.glob_names(self.spark, f"{self.path(table)}/{_PREFIX}*/{_MARKER}")
        return sorted(int(n[1:]) for n in names if n.startswith(_PREFIX) and n[1:].isdigit())

    def _next_version(self, table: str) -> int:
        used = [int(n[1:]) for n in fs.list_dirs(self.spark, self.path(table))
                if n.startswith(_PREFIX) and n[1:].isdigit()]
        return (max(used) if used else 0) + 1

    def version_path(self, table: str, version: int) -> str:
        return f"{self.path(table)}/{_PREFIX}{version:08d}"

    def current_version(self, table: str) -> int | None:
        v = self.versions(table)
        return v[-1] if v else None

    def exists(self, table: str) -> bool:
        return self.current_version(table) is not None

    def read(self, table: str, version: int | None = None,
             unpublished: bool = False) -> DataFrame | None:
        """The current (or given) version; its saved schema spares a footer-reading job.

        ``unpublished`` allows reading a written but not yet marked version (the writer
        checking its own output before the switch)."""
        v = version if version is not None else self.current_version(table)
        if v is None:
            return None
        if not unpublished and v not in self.versions(table):
            raise ValueError(f"version {v} of {table} is not published")
        path = self.version_path(table, v)
        text = fs.read_text(self.spark, f"{path}/{_SCHEMA}")
        reader = self.spark.read
        if text:
            reader = reader.schema(T.StructType.fromJson(json.loads(text)))
        return reader.parquet(path)

    def write_version(self, table: str, df: DataFrame,
                      partition_by: list[str] | None = None) -> int:
        """Write ``df`` as the next version of ``table`` without making it visible."""
        v = self._next_version(table)
        w = df.write.mode("errorifexists")
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(self.version_path(table, v))
        fs.write_text(self.spark, f"{self.version_path(table, v)}/{_SCHEMA}", df.schema.json())
        return v

    def mark(self, table: str, version: int) -> None:
        fs.touch(self.spark, f"{self.version_path(table, version)}/{_MARKER}")

    def publish(self, table: str, df: DataFrame, partition_by: list[str] | None = None) -> int:
        """Write ``df`` as the next version of ``table``, make it current, return it."""
        v = self.write_version(table, df, partition_by)
        self.mark(table, v)
        return v

    def retire(self, table: str, keep: int = 2) -> list[int]:
        """Delete all but the newest ``keep`` published versions of ``table`` (and any
        unpublished version older than the newest kept one).  Returns what was removed.

        ``keep`` >= 2 leaves readers of the previous version undisturbed."""
        if keep < 1:
            raise ValueError("keep at least the current version")
        published = self.versions(table)
        if len(published) <= keep:
            return []
        oldest_kept = published[-keep]
        removed = []
        for name in fs.list_dirs(self.spark, self.path(table)):
            if name.startswith(_PREFIX) and name[1:].isdigit() and int(name[1:]) < oldest_kept:
                fs.delete_tree(self.spark, f"{self.path(table)}/{name}")
                removed.append(int(name[1:]))
        return sorted(removed)

    def tables(self) -> list[str]:
        """Every table with a published version (``layer/name``)."""
        out = []
        for layer in fs.list_dirs(self.spark, self.root):
            for name in fs.list_dirs(self.spark, f"{self.root}/{layer}"):
                if self.versions(f"{layer}/{name}"):
                    out.append(f"{layer}/{name}")
                else:
                    out += [f"{layer}/{name}/{sub}" for sub in fs.list_dirs(self.spark, self.path(f"{layer}/{name}"))
                            if not sub.startswith(_PREFIX) and self.versions(f"{layer}/{name}/{sub}")]
        return sorted(out)

    def register_views(self) -> list[str]:
        """Temp views over the current versions (``stg_orders``, ``dw_fact_sales``,
        ``etl_load_control`` ...), so the warehouse can be queried with ``spark.sql``."""
        names = []
        for t in self.tables():
            name = t.replace("/", "_")
            self.read(t).createOrReplaceTempView(name)
            names.append(name)
        self.load_control().createOrReplaceTempView("etl_load_control")
        return names + ["etl_load_control"]

    # --- K13: load control ------------------------------------------------------
    def append_load_control(self, rows: DataFrame) -> None:
        rows.select([f.name for f in S.LOAD_CONTROL.fields]).write.mode("append").parquet(
            self.path("etl/load_control"))

    def load_control(self) -> DataFrame:
        """One row per run and process: its last state (a process that began and never
        ended is STARTED).  Columns added later read as NULL in older rows."""
        p = self.path("etl/load_control")
        if not fs.exists(self.spark, p):
            return self.spark.createDataFrame([], S.LOAD_CONTROL)
        names = [f.name for f in S.LOAD_CONTROL.fields]
        rows = self.spark.read.schema(S.LOAD_CONTROL).parquet(p)
        last = F.max(F.struct(F.col("ended_at").isNotNull().alias("ended"), "ended_at", F.struct(*names).alias("row")))
        return rows.groupBy("run_id", "process").agg(last.alias("last")).select("last.row.*")
