"""Write the formatted physical plans of the key queries to docs/plans/<query>.txt.

Usage: python scripts/dump_plans.py [sf_dir]
Plans are taken before execution (the initial adaptive plan); staged queries write
their staging table first, as they do when run.
"""

from __future__ import annotations

import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from tallyspark.plans import catalog  # noqa: E402
from tallyspark.session import local_session  # noqa: E402

KEY_QUERIES = ["kpi_mart", "kpi_published", "kpi_non_null_profile", "date_anchors", "reconcile_daily",
               "reconcile_latest_day", "audit_rows", "trx_base"]


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    out_dir = os.path.join(ROOT, "docs", "plans")
    os.makedirs(out_dir, exist_ok=True)
    spark = local_session(cores=8, shuffle_partitions=16)
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    qs = catalog.queries()
    for name in KEY_QUERIES:
        text = qs[name](spark, sf)._jdf.queryExecution().explainString(mode)
        text = re.sub(r"file:/[^\s,\]]*", "<path>", text)  # machine paths are noise
        with open(os.path.join(out_dir, f"{name}.txt"), "w") as fh:
            fh.write(f"-- {name} over {os.path.basename(sf.rstrip('/'))}, initial adaptive plan\n{text}")
        print(name, len(text))


if __name__ == "__main__":
    main()
