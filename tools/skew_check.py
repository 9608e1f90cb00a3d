"""Skew experiment: a third of all order items on one product and a third on one order.

Usage: python tools/skew_check.py [sf_dir] -> per operator: result check and the largest reduce
task's shuffle read against the median (from the event log).

Broadcast joins are switched off and AQE's skew thresholds lowered, so the joins run as they
would at warehouse scale (sort-merge, skew split) on test-sized data.
"""

from __future__ import annotations

import glob
import json
import os
import statistics
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from tillstar.operators import quality  # noqa: E402
from tillstar.operators.dedup import keep_last  # noqa: E402
from tillstar.plans import dims, facts, marts  # noqa: E402
from tillstar.session import build_session  # noqa: E402
from tillstar.sources.testdata import ITEM_VERSION, SourceTables  # noqa: E402


def task_reads(log_dir: str) -> dict:
    """job group -> list of per-stage lists of per-task shuffle bytes read."""
    stage_group, reads = {}, {}
    for path in [p for p in glob.glob(f"{log_dir}/**/*", recursive=True) if os.path.isfile(p)]:
        with open(path) as f:
            for line in f:
                e = json.loads(line)
                if e.get("Event") == "SparkListenerJobStart":
                    g = (e.get("Properties") or {}).get("spark.jobGroup.id")
                    for sid in e.get("Stage IDs", []):
                        stage_group[sid] = g
                elif e.get("Event") == "SparkListenerTaskEnd":
                    g = stage_group.get(e.get("Stage ID"))
                    r = (e.get("Task Metrics") or {}).get("Shuffle Read Metrics") or {}
                    b = r.get("Remote Bytes Read", 0) + r.get("Local Bytes Read", 0)
                    if g and b:
                        reads.setdefault(g, {}).setdefault(e["Stage ID"], []).append(b)
    return reads


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    log_dir = tempfile.mkdtemp(prefix="tillstar-skew-", dir="/tmp")
    spark = build_session("local[8]", 16, extra={
        "spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir, "spark.eventLog.compress": "false",
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256k"})
    sc = spark.sparkContext
    t = SourceTables(spark, sf_dir)
    # one product and one order receive a third of all items each (derived from lineitem)
    u = F.rand(7)
    items = (t.order_items
             .withColumn("product_id", F.when(u < 1 / 3, F.lit(0)).otherwise(F.col("product_id")))
             .withColumn("order_id", F.when(u >= 2 / 3, F.lit(0)).otherwise(F.col("order_id"))))
    items = items.checkpoint()
    raw = t.raw()
    d = dims.build_all(raw)
    results = {}

    def run(name, df, check):
        sc.setJobGroup(name, name)
        df.write.format("noop").mode("overwrite").save()
        results[name] = check()

    fact = facts.fact_sales_orders(items, d["dim_products"], d["dim_orders"], d["dim_customers"], d["dim_coupons"])
    n_items = items.count()
    run("fact_sales_orders", fact, lambda: fact.count() == n_items)
    mart = marts.daily_revenue_per_product(fact, d["dim_date"], d["dim_products"], d["dim_suppliers"],
                                           d["dim_product_categories"])
    run("daily_revenue_per_product", mart,
        lambda: mart.agg(F.sum("amount")).first()[0] == fact.where("product_key is not null").agg(F.sum("amount")).first()[0])
    # keep-last with one id holding a third of all versions
    versions = t.order_item_versions.withColumn("id", F.when(F.rand(11) < 1 / 3, F.lit(-1)).otherwise(F.col("id")))
    versions = versions.checkpoint()
    kl = keep_last(versions, ["id"], ITEM_VERSION)
    run("keep_last", kl, lambda: kl.count() == versions.select("id").distinct().count())
    pk = quality.check_primary_key(versions.select("id"), ["id"])
    run("check_primary_key", pk, lambda: pk.where("id = -1").first().n_rows == versions.where("id = -1").count())
    spark.stop()
    report = {}
    for group, stages in task_reads(log_dir).items():
        biggest = max(stages.values(), key=sum)
        report[group] = {"result_ok": results.get(group), "tasks": len(biggest),
                         "max_task_read_kb": round(max(biggest) / 1024, 1),
                         "median_task_read_kb": round(statistics.median(biggest) / 1024, 1),
                         "stage_read_kb": round(sum(biggest) / 1024, 1)}
    print(json.dumps(report))


if __name__ == "__main__":
    main()
