"""Command line of the warehouse job (spark-submit / python -m tillstar).

  python -m tillstar all    --sources sources.json --raw-db raw     (ingest, star and dbo in one session)
  python -m tillstar ingest --sources sources.json --raw-db raw
  python -m tillstar batch  --sources new.json --raw-db raw          (new and changed rows into a built warehouse)
  python -m tillstar star   --raw-db raw [--dim-db dimensional] [--pres-db presentation] [--append-marts]
  python -m tillstar dbo    --raw-db raw [--dbo-db dbo]
  python -m tillstar quality [--dim-db dimensional] [--pres-db presentation] [--quality-db quality]
  python -m tillstar stream --name login_attemps --format json_records --folder IN --table raw.login_attemps
                            --checkpoint CKPT [--continuous]

Separate commands share tables through the session catalog: the cluster's persistent metastore. ``batch`` also
finds the tables by their files, if the warehouse folder is the same and the catalog is empty.

``sources.json``: a list of {"name": raw table, "format": csv | json_columns | json_records | avro |
parquet, "paths": [files in read order], "options": {...}}.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from tillstar import schemas
from tillstar.operators.clean import clean
from tillstar.plans import warehouse
from tillstar.session import scratch_root
from tillstar.sources.spec import SourceSpec, read_source


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="tillstar")
    sub = ap.add_subparsers(dest="cmd", required=True)
    a = sub.add_parser("ingest")
    a.add_argument("--sources", required=True)
    a.add_argument("--raw-db", required=True)
    n = sub.add_parser("batch")
    n.add_argument("--sources", required=True)
    n.add_argument("--raw-db", required=True)
    n.add_argument("--dim-db", default=schemas.D)
    n.add_argument("--pres-db", default=schemas.P)
    e = sub.add_parser("all")
    e.add_argument("--sources", required=True)
    e.add_argument("--raw-db", required=True)
    e.add_argument("--any-range", action="store_true")
    b = sub.add_parser("star")
    b.add_argument("--raw-db", required=True)
    b.add_argument("--dim-db", default=schemas.D)
    b.add_argument("--pres-db", default=schemas.P)
    b.add_argument("--append-marts", action="store_true")
    c = sub.add_parser("dbo")
    c.add_argument("--raw-db", required=True)
    c.add_argument("--dbo-db", default=schemas.E)
    c.add_argument("--any-range", action="store_true", help="store sums beyond DECIMAL(10,2) instead of failing")
    q = sub.add_parser("quality")
    q.add_argument("--dim-db", default=schemas.D)
    q.add_argument("--pres-db", default=schemas.P)
    q.add_argument("--quality-db", default="quality")
    d = sub.add_parser("stream")
    for k in ("--name", "--format", "--folder", "--table", "--checkpoint"):
        d.add_argument(k, required=True)
    d.add_argument("--continuous", action="store_true")
    args = ap.parse_args(argv)

    # the session as launched (spark-submit --conf wins); AQE, skew join and ANSI are Spark 4 defaults
    spark = SparkSession.builder.appName(f"tillstar-{args.cmd}").getOrCreate()
    scratch_root(spark)
    if args.cmd in ("ingest", "all", "batch"):
        with open(args.sources) as f:
            specs = [SourceSpec(s["name"], s["format"], tuple(s["paths"]), s.get("options", {})) for s in json.load(f)]
    if args.cmd == "batch":
        rows = {s.name: clean(s.name, read_source(spark, s)) for s in specs}
        warehouse.build_batch(spark, rows, args.raw_db, args.dim_db, args.pres_db)
    elif args.cmd in ("ingest", "all"):
        warehouse.ingest(spark, specs, args.raw_db)
        if args.cmd == "all":
            warehouse.build_star(spark, args.raw_db)
            warehouse.build_erd(spark, args.raw_db, ranges=not args.any_range)
            for t in ("daily_order_revenue", "daily_order_revenue_per_product",
                      "daily_order_revenue_per_categories", "daily_order_revenue_per_suppliers"):
                print(f"{schemas.P}.{t}: {spark.table(f'{schemas.P}.{t}').count()} rows")
    elif args.cmd == "star":
        warehouse.build_star(spark, args.raw_db, args.dim_db, args.pres_db,
                             marts_mode="append" if args.append_marts else "overwrite_partitions")
    elif args.cmd == "dbo":
        warehouse.build_erd(spark, args.raw_db, args.dbo_db, ranges=not args.any_range)
    elif args.cmd == "quality":
        warehouse.quality_reports(spark, args.dim_db, args.pres_db, args.quality_db)
    else:
        from tillstar.streaming.ingest import start_ingest
        q = start_ingest(spark, args.name, args.format, args.folder, args.table, args.checkpoint,
                         available_now=not args.continuous)
        q.awaitTermination()


if __name__ == "__main__":
    main()
