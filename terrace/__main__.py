"""Command-line run of the layered deliveries job.

    python -m terrace --deliveries RAW.csv --materials RAW.csv --root /lake \\
        [--tenants ec,hn | all] [--start 2025-01-01] [--end 2025-01-31] \\
        [--fail-on-critical] [--fail-fast] [--unknown drop|quarantine] [--month-partitions]

Runs catalog, bronze, silver and gold for all selected tenants in one job
and prints the status table.  The Spark session comes from the environment
(``spark-submit`` settings or ``spark-defaults.conf``).
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from terrace.config import ACTIVE_TENANTS, MONTH_KEY
from terrace.plans.medallion import Layout, RunConfig, run
from terrace.session import RECOMMENDED_CONF


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="terrace", description="Layered multi-tenant deliveries run")
    p.add_argument("--deliveries", required=True, help="raw deliveries file(s) or folder")
    p.add_argument("--materials", required=True, help="raw material catalog file(s) or folder")
    p.add_argument("--root", required=True, help="root folder of the layered tables")
    p.add_argument("--tenants", default="all", help="comma-separated tenant codes, or 'all'")
    p.add_argument("--start", help="first process date, yyyy-MM-dd or yyyyMMdd")
    p.add_argument("--end", help="last process date, yyyy-MM-dd or yyyyMMdd")
    p.add_argument("--fail-on-critical", action="store_true", help="stop tenants with critical failures before gold")
    p.add_argument("--fail-fast", action="store_true", help="raise on the first failing stage or tripped breaker")
    p.add_argument("--unknown", choices=("drop", "quarantine"), default="drop",
                   help="rows whose rules are NULL: dropped (parity) or quarantined")
    p.add_argument("--month-partitions", action="store_true", help="partition tables by month, not by day")
    args = p.parse_args(argv)

    builder = SparkSession.builder.appName("terrace")
    for k, v in RECOMMENDED_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    tenants = ACTIVE_TENANTS if args.tenants.lower() == "all" else tuple(
        t.strip().lower() for t in args.tenants.split(",") if t.strip())
    cfg = RunConfig(tenants=tenants, start=args.start, end=args.end,
                    fail_on_critical=args.fail_on_critical, fail_fast=args.fail_fast, unknown=args.unknown,
                    partition_by=("_tenant_id", "mes") if args.month_partitions else ("_tenant_id", "fecha_proceso"),
                    derived=(MONTH_KEY,) if args.month_partitions else ())
    status = run(spark, args.deliveries, args.materials, Layout(args.root.rstrip("/")), cfg)
    rows = status.orderBy("tenant", "stage").collect()
    for r in rows:
        print(f"{r.tenant:14s} {r.stage:24s} {r.status:8s} {r.rows:>10d}  {r.reason or ''}")
    return 1 if any(r.status in ("failed", "blocked") for r in rows) else 0


if __name__ == "__main__":
    sys.exit(main())
