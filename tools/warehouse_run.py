"""Run the warehouse job end to end on files derived from one test scale, timing each stage.

Usage: python tools/warehouse_run.py [sf_dir]  -> one JSON line with stage seconds.
Source files are written first (not timed): customers as 10 CSV files, login attempts as 10
JSON-lines files, coupons as column-oriented JSON, order items (old versions, then latest)
and orders as parquet, the catalogue as CSV exports.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tillstar.plans import warehouse  # noqa: E402
from tillstar.session import build_session, new_scratch_dir  # noqa: E402
from tillstar.sources.testdata import write_source_files  # noqa: E402


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session("local[8]", 8)
    root = new_scratch_dir(spark, "warehouse-run")
    specs = write_source_files(spark, sf_dir, root)
    tag = root.rsplit("-", 1)[-1]
    raw, dim, pres, dbo = (f"{x}_{tag}" for x in ("raw", "dimensional", "presentation", "dbo"))
    locs = {dim: f"{root}/dim", pres: f"{root}/pres"}
    times = {}
    for label, fn in (("ingest", lambda: warehouse.ingest(spark, specs, raw, f"{root}/raw")),
                      ("star", lambda: warehouse.build_star(spark, raw, dim, pres, locs)),
                      ("dbo", lambda: warehouse.build_erd(spark, raw, dbo, f"{root}/dbo", ranges=False)),
                      ("ingest_rerun", lambda: warehouse.ingest(spark, specs, raw)),
                      ("star_rerun", lambda: warehouse.build_star(spark, raw, dim, pres, locs))):
        t0 = time.perf_counter()
        fn()
        times[label] = round(time.perf_counter() - t0, 2)
    counts = {t: spark.table(f"{pres}.{t}").count() for t in ("daily_order_revenue", "daily_order_revenue_per_product")}
    print(json.dumps({"sf_dir": sf_dir, "stage_sec": times, "rows": counts}))


if __name__ == "__main__":
    main()
