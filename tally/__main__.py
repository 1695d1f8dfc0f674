"""Command line: ``python -m tally <command> ...``.

Commands mirror the original step scripts, on Spark:

* ``warehouse RAW_DIR REGISTRY_CSV OUT_DIR``: consolidate the quarterly files
  under RAW_DIR (folders named ``<year>_T<quarter>``), enrich, validate and
  write ledger, mart, dimension, fact, quarantine and audit tables.
* ``analytics WAREHOUSE_DIR``: the three analytical answers (growth top 5,
  top 5 states, operators above the mean in 2+ quarters), printed.
* ``stats WAREHOUSE_DIR``: the dashboard statistics as JSON.

The session comes from ``spark-submit``/the environment when one exists; a
local one is created otherwise.
"""

from __future__ import annotations

import argparse
import json

def _session():
    from pyspark.sql import SparkSession

    from tally.session import SCALE_CONFS

    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    b = SparkSession.builder.appName("tally")
    for k, v in SCALE_CONFS.items():
        b = b.config(k, v)
    return b.getOrCreate()


def main(argv=None) -> None:
    p = argparse.ArgumentParser(prog="tally")
    sub = p.add_subparsers(dest="cmd", required=True)
    w = sub.add_parser("warehouse")
    w.add_argument("raw_dir")
    w.add_argument("registry_csv")
    w.add_argument("out_dir")
    w.add_argument("--latest", type=int, default=None,
                   help="ingest only the N latest quarters found in the folder names")
    a = sub.add_parser("analytics")
    a.add_argument("warehouse_dir")
    s = sub.add_parser("stats")
    s.add_argument("warehouse_dir")
    args = p.parse_args(argv)
    spark = _session()

    if args.cmd == "warehouse":
        from tally.plans.batch import build_warehouse

        wh = build_warehouse(spark, [args.raw_dir], args.registry_csv, out=args.out_dir,
                             latest_quarters=args.latest)
        print(json.dumps({"ledger_rows": wh.ledger.count(), "operators": wh.dimension.count(),
                          "quarantined": wh.quarantined.count()}))
        return

    from tally.sinks.snapshots import open_table

    dim = open_table(spark, args.warehouse_dir, "dimension")
    fact = open_table(spark, args.warehouse_dir, "fact")
    if args.cmd == "analytics":
        from tally.plans import analytics

        for title, df in (("growth_top5", analytics.growth_top(fact, dim, 5)),
                          ("top_states", analytics.top_states(fact, dim, 5)),
                          ("above_mean", analytics.above_mean(fact, dim, 2, "rows"))):
            print(title)
            df.show(truncate=False)
    else:
        from tally.plans.service import LedgerService

        print(json.dumps(LedgerService(dim, fact).statistics(), default=str))


if __name__ == "__main__":
    main()
