"""Print the physical plans of the main jobs (used to write PLANS.md).

    python tools/show_plans.py [sf_dir]

Runs one load into a fresh folder below spark.checkpoint.dir, then prints the plan
trees of the fact load, a re-run customer upsert and some registered queries.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def tree(df) -> str:
    """The physical plan tree, with expression ids and long lists shortened."""
    text = df._jdf.queryExecution().executedPlan().toString()
    text = re.sub(r"#\d+L?", "", text)
    text = re.sub(r"Location: InMemoryFileIndex\([^)]*\)\[[^\]]*\]", "Location: …", text)
    out = []
    for line in text.splitlines():
        out.append(line if len(line) <= 160 else line[:157] + "…")
    return "\n".join(out)


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    from salesmart.operators import dims as D
    from salesmart.operators.facts import FactInputs, broadcast_plan, build_fact
    from salesmart.plans import pipeline as P
    from salesmart.plans.queries import REGISTRY, source_config
    from salesmart.plans.store import TableStore
    from salesmart.session import local_session, scratch_path

    spark = local_session()
    wh = scratch_path(spark, "plans", fresh=True)
    P.run(spark, source_config(spark, sf), wh)
    store = TableStore(spark, wh)
    inp = FactInputs(details=store.read("stg/order_details"), orders=store.read("stg/orders"),
                     dim_date=store.read("dw/dim_date"), dim_customer=store.read("dw/dim_customer"),
                     dim_product=store.read("dw/dim_product"), dim_status=store.read("dw/dim_status"),
                     dim_source=store.read("dw/dim_source"))
    inp.broadcast = broadcast_plan(inp)
    print("### fact load (pipeline)\n```\n" + tree(build_fact(inp).fact) + "\n```\n")
    load = D.load_dim_customer(D.customer_members(store.read("stg/customers")),
                               store.read("dw/dim_customer"))
    print("### customer dimension, second run (upsert)\n```\n" + tree(load.table) + "\n```\n")
    for name in ("reconcile_details", "surrogate_keys", "sales_by_month"):
        print(f"### query {name}\n```\n" + tree(REGISTRY[name](spark, sf)) + "\n```\n")


if __name__ == "__main__":
    main()
