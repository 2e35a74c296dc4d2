"""Command line: ``python -m salesmart <command> ...``.

Commands:
  batch     --data-dir D [--strict] [--unique-products] [--partition-by-day]
  generate  --data-dir D [--rows N]                      synthetic raw zone (parallel)
"""

from __future__ import annotations

import argparse
import json

from salesmart.session import build_session


def main(argv=None):
    parser = argparse.ArgumentParser(prog="salesmart")
    sub = parser.add_subparsers(dest="command", required=True)
    b = sub.add_parser("batch")
    b.add_argument("--data-dir", required=True)
    b.add_argument("--strict", action="store_true")
    b.add_argument("--unique-products", action="store_true")
    b.add_argument("--partition-by-day", action="store_true", help="partition silver by order_date")
    g = sub.add_parser("generate")
    g.add_argument("--data-dir", required=True)
    g.add_argument("--rows", type=int, default=1_000_000)
    args = parser.parse_args(argv)

    spark = build_session()
    if args.command == "batch":
        from salesmart.plans import batch

        doc = batch.run(
            spark,
            args.data_dir,
            strict=args.strict,
            unique_products=args.unique_products,
            partition_by=("order_date",) if args.partition_by_day else (),
        )
        print(json.dumps({"order_count": doc["order_count"], "pipeline_seconds": doc["pipeline_seconds"]}))
    else:
        from salesmart.sources import synth

        synth.write_raw(spark, args.rows, f"{args.data_dir.rstrip('/')}/raw")
    spark.stop()


if __name__ == "__main__":
    main()
