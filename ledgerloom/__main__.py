"""Run the layered pipeline from the command line.

    python -m ledgerloom --tables DIR [--lake DIR] [--until gold] [--cutoff YYYY-MM-DD] [--no-stop]
    python -m ledgerloom --feeds SALES_CSV FX_CSV ORDERS_PARQUET ERP_JSON [--erp-lines | --erp-ranges] ...

The session is ``SparkSession.builder.getOrCreate()``: master, executors and
``spark.checkpoint.dir`` come from the environment (spark-defaults.conf,
``PYSPARK_SUBMIT_ARGS``); without any, a default local session.
"""

from __future__ import annotations

import argparse
import json
from datetime import date

from pyspark.sql import SparkSession

from .plans.layers import LAYERS, run_layers
from .sources import FeedPaths


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="ledgerloom", description="bronze -> silver -> checks -> gold")
    p.add_argument("--tables", help="directory of the benchmark tables")
    p.add_argument("--feeds", nargs=4, metavar=("SALES_CSV", "FX_CSV", "ORDERS_PARQUET", "ERP_JSON"), help="the raw files instead")
    p.add_argument("--erp-lines", action="store_true", help="the ERP documents are JSON Lines")
    p.add_argument("--erp-ranges", action="store_true", help="the ERP export is one large document: read its bytes in ranges")
    p.add_argument("--lake", default=None, help="lake root (default: under spark.checkpoint.dir)")
    p.add_argument("--until", choices=LAYERS, default="gold", help="last layer to build")
    p.add_argument("--cutoff", type=date.fromisoformat, default=None, help="fix the sales cutoff (YYYY-MM-DD)")
    p.add_argument("--stock-cutoff", type=date.fromisoformat, default=None, help="fix the stock cutoff (YYYY-MM-DD)")
    p.add_argument("--no-stop", action="store_true", help="report failed error checks without stopping")
    a = p.parse_args(argv)

    spark = SparkSession.builder.appName("ledgerloom").getOrCreate()
    feeds = FeedPaths(*a.feeds, erp_multiline=not a.erp_lines, erp_ranges=a.erp_ranges) if a.feeds else None
    r = run_layers(
        spark, a.tables, a.lake, until=a.until, stop_on_error=not a.no_stop,
        cutoff=a.cutoff, stock_cutoff=a.stock_cutoff, feeds=feeds,
    )
    failed = [row["check"] for row in r.report if not row["ok"]]
    print(json.dumps({"lake": r.lake, "cutoff": str(r.cutoff), "stock_cutoff": str(r.stock_cutoff),
                      "seconds": r.seconds, "failed_checks": failed}))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
