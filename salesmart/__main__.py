"""Command line: run one complete load from a JSON configuration.

    python -m salesmart run --config load.json
    python -m salesmart validate --warehouse s3a://bucket/warehouse

``load.json``::

    {"warehouse": "s3a://bucket/warehouse",
     "sources": {"products_csv": "...", "customers_csv": "...", "orders_csv": "...",
                 "order_details_csv": "...", "api_pages": "...",
                 "db_orders": {"jdbc": {"url": "jdbc:...", "user": "...", "password": "..."}},
                 "db_order_details": {"jdbc": {"url": "jdbc:..."}},
                 "csv_multiline": false}}

The session comes from ``spark-submit`` (cluster settings, ``spark.checkpoint.dir``);
the exit code is 0 on success and 1 when the load failed (recorded in load control).
"""

from __future__ import annotations

import argparse
import json
import logging
import sys


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="salesmart")
    sub = ap.add_subparsers(dest="cmd", required=True)
    r = sub.add_parser("run", help="extract, stage, load dimensions and the fact")
    r.add_argument("--config", required=True)
    r.add_argument("--run-id")
    v = sub.add_parser("validate", help="run the warehouse checks (duplicates, unfinished loads, ...)")
    v.add_argument("--warehouse", required=True)
    args = ap.parse_args(argv)

    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(name)s %(message)s")
    from pyspark.sql import SparkSession
    from .plans.pipeline import SourceConfig, run

    if args.cmd == "validate":
        from .plans.store import TableStore
        from .plans.validation import validate_warehouse
        spark = SparkSession.builder.appName("salesmart-validate").getOrCreate()
        checks = validate_warehouse(TableStore(spark, args.warehouse)).collect()  # ~15 rows
        for c in checks:
            logging.info("%-45s %12s %s", c.check, c.value, "ok" if c.ok else f"FAILED (expected {c.expected})")
        return 0 if all(c.ok for c in checks) else 1

    with open(args.config) as f:
        cfg = json.load(f)
    spark = SparkSession.builder.appName("salesmart").getOrCreate()
    try:
        res = run(spark, SourceConfig(**cfg["sources"]), cfg["warehouse"], run_id=args.run_id)
    except Exception:
        logging.exception("load failed")
        return 1
    for m in res.metrics:
        logging.info("%s: read %s, inserted %s, updated %s, rejected %s", m["process"],
                     m.get("rows_read"), m.get("rows_inserted"), m.get("rows_updated"),
                     m.get("rows_rejected"))
    return 0


if __name__ == "__main__":
    sys.exit(main())
