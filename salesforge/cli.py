"""Command-line entry points matching the three runs of the original pipeline.

    python -m salesforge etl      --input EXPORTS/ --warehouse WH/        # daily ETL (CSV -> Parquet)
    python -m salesforge payload  --warehouse WH/ --out PAYLOAD_DIR/      # dashboard JSON payload
    python -m salesforge report   --warehouse WH/ --out REPORT_DIR/ [--format csv]

Each builds (or reuses) a Spark session, runs one job and prints a short JSON
summary.  On a cluster, submit it with spark-submit and the platform's
configuration; nothing here assumes local mode.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession

from .operators import etl, payload, quality
from .session import build_session, configure, ensure_checkpoint_dir
from .sources import sinks
from .sources.csv_export import read_csv_export
from .sources.warehouse import read_fact, write_fact


def run_etl(spark, input_path: str, warehouse: str, strict: bool = False) -> dict:
    raw = read_csv_export(spark, input_path, with_file_order=True, count_unparsed=True, strict=strict)
    if strict:
        etl.check_strict(etl.quality_metrics(raw, etl.dedup_lines(raw)))
    fact, obs = etl.clean_fact_observed(raw)
    write_fact(fact, warehouse)
    return etl.observed_metrics(obs)


def run_payload(spark, warehouse: str, out: str) -> dict:
    path = sinks.write_payload_json(payload.dashboard_payload(read_fact(spark, warehouse)), out)
    return {"payload": path}


def run_report(spark, warehouse: str, out: str, fmt: str = "parquet") -> dict:
    return sinks.write_report(quality.quality_report(read_fact(spark, warehouse)), out, fmt)


def main(argv: list[str] | None = None) -> dict:
    ap = argparse.ArgumentParser(prog="salesforge")
    sub = ap.add_subparsers(dest="cmd", required=True)
    e = sub.add_parser("etl", help="raw CSV export -> clean fact_transactions (Parquet)")
    e.add_argument("--input", required=True)
    e.add_argument("--warehouse", required=True)
    e.add_argument("--strict", action="store_true", help="fail on null quantity / return flag")
    p = sub.add_parser("payload", help="fact -> dashboard JSON payload")
    p.add_argument("--warehouse", required=True)
    p.add_argument("--out", required=True)
    r = sub.add_parser("report", help="fact -> five quality report tables")
    r.add_argument("--warehouse", required=True)
    r.add_argument("--out", required=True)
    r.add_argument("--format", default="parquet", choices=["parquet", "csv", "json"])
    ap.add_argument("--master", default=None,
                    help="e.g. local[8]; omit under spark-submit to use the cluster's master")
    args = ap.parse_args(argv)

    if args.master:
        spark = build_session(master=args.master, app_name=f"salesforge-{args.cmd}")
    else:
        spark = SparkSession.builder.appName(f"salesforge-{args.cmd}").getOrCreate()
    configure(spark)
    ensure_checkpoint_dir(spark)
    if args.cmd == "etl":
        result = run_etl(spark, args.input, args.warehouse, args.strict)
    elif args.cmd == "payload":
        result = run_payload(spark, args.warehouse, args.out)
    else:
        result = run_report(spark, args.warehouse, args.out, args.format)
    print(json.dumps(result))
    return result


if __name__ == "__main__":
    main(sys.argv[1:])
