"""Benchmark of the headline queries.

Runs each query to completion (``noop`` sink: every row is computed, nothing is collected)
at ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on ``local[$BENCH_CPUS]`` and prints one
JSON line. Per query: one warm-up run, then the median of ``$BENCH_REPS`` (default 3) runs.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tillstar.plans import warehouse  # noqa: E402
from tillstar.queries import QUERIES  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from tillstar.session import build_session, new_scratch_dir  # noqa: E402
from tillstar.sources.testdata import write_source_files  # noqa: E402

HEADLINE = [
    "fact_sales_orders",            # M1: star join of every order item
    "daily_revenue",                # M5
    "daily_revenue_per_product",    # M4
    "daily_revenue_per_category",   # M6
    "daily_revenue_per_supplier",   # M7 (keyed)
    "product_performance",          # M2
    "category_performance",         # M3
    "dedup_keep_last",              # P6
    "upsert_orders_subset",         # K3 (write, staging, swap)
    "check_foreign_key",            # C2 over 12 keys
]


def run_once(spark, name: str, sf_dir: str) -> float:
    t0 = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    reps = int(os.environ.get("BENCH_REPS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = build_session(f"local[{cpus}]", shuffle_partitions=cpus,
                          extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")})
    times = {}
    for name in names:
        run_once(spark, name, sf_dir)
        times[name] = round(statistics.median(run_once(spark, name, sf_dir) for _ in range(reps)), 3)
    pipeline = {} if os.environ.get("BENCH_PIPELINE", "1") == "0" else run_pipeline(spark, sf_dir)
    sf = sf_dir.rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "headline_total_sec", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "pipeline_sec": pipeline,
                      "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf}))


def new_rows(spark, raw: str) -> dict:
    """A batch: the last month's orders again, with another status, and their items with one more piece each."""
    orders = spark.table(f"{raw}.orders")
    last = orders.select(F.date_trunc("month", F.max("created_at"))).scalar()
    late = orders.where(F.col("created_at") >= last)
    items = spark.table(f"{raw}.order_items").join(late.select(F.col("id").alias("order_id")), "order_id", "left_semi")
    return {"orders": late.withColumn("status", F.lit("P")), "order_items": items.withColumn("amount", F.col("amount") + 1).select(*spark.table(f"{raw}.order_items").columns)}


def run_pipeline(spark, sf_dir: str) -> dict:
    """The warehouse job once: ingest of the source files (written first, not timed) and the
    star build (dimensions, fact, performance facts, marts), first load and re-run, and a batch."""
    root = new_scratch_dir(spark, "bench-warehouse")
    specs = write_source_files(spark, sf_dir, root)
    tag = root.rsplit("-", 1)[-1]
    raw, dim, pres = (f"{x}_{tag}" for x in ("raw", "dimensional", "presentation"))
    locs = {dim: f"{root}/dim", pres: f"{root}/pres"}
    out = {}
    for label, fn in (("ingest", lambda: warehouse.ingest(spark, specs, raw, f"{root}/raw")),
                      ("star_build", lambda: warehouse.build_star(spark, raw, dim, pres, locs)),
                      ("star_rerun", lambda: warehouse.build_star(spark, raw, dim, pres, locs)),
                      ("star_batch", lambda: warehouse.build_batch(spark, new_rows(spark, raw), raw, dim, pres))):
        t0 = time.perf_counter()
        fn()
        out[label] = round(time.perf_counter() - t0, 3)
    return out


if __name__ == "__main__":
    main()
