"""Command line: run the whole pipeline once (for any scheduler).

    spark-submit --py-files ordermart.zip tools/run_pipeline.py \\
        --orders s3://.../orders.csv --customers ... --restaurants ... --partners ... \\
        --target s3://.../orders_mart [--database orders_mart] [--as-of 2024-06-30]
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from .plans import pipeline


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="ordermart")
    for name in ("orders", "customers", "restaurants", "partners"):
        ap.add_argument(f"--{name}", required=True, help=f"raw {name} CSV path")
    ap.add_argument("--target", required=True, help="output root (bronze/silver/gold)")
    ap.add_argument("--database", default=None, help="catalog database for the gold tables")
    ap.add_argument("--as-of", default=None, help="recency reference date (default: today)")
    ap.add_argument("--format", default="parquet")
    a = ap.parse_args(argv)
    spark = SparkSession.builder.appName("ordermart").getOrCreate()
    sources = {n: getattr(a, n) for n in ("orders", "customers", "restaurants", "partners")}
    out = pipeline.run(spark, sources, a.target, as_of=a.as_of, database=a.database,
                       fmt=a.format)
    summary = {r.metric: r.value for r in out["dq_summary"].collect()}
    manifest = {r.table_name: r.row_count for r in out["manifest"].collect()}
    print(json.dumps({"dq_summary": summary, "manifest": manifest, "gold": out["gold"]}))


if __name__ == "__main__":
    main()
