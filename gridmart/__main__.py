"""Command line: ``python -m gridmart build ...`` (full run) or ``python -m gridmart checks ...``.

Run it through ``spark-submit`` on a cluster (the master comes from there); paths
must be on shared storage.
"""

from __future__ import annotations

import argparse
import json
import sys


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="gridmart")
    sub = p.add_subparsers(dest="cmd", required=True)
    b = sub.add_parser("build", help="bronze -> silver -> gold -> geo -> checks")
    b.add_argument("--long", required=True, nargs="+", help="long statistics CSV path(s)")
    b.add_argument("--wide", required=True, nargs="+", help="wide indicator CSV path(s)")
    b.add_argument("--capacity", help="capacity CSV (curated fallback when absent or incomplete)")
    b.add_argument("--geo", help="JSON file listing geo resources: [{dataset, name, id, format, path}]")
    b.add_argument("--seed", help="category seed CSV (packaged seed when absent)")
    b.add_argument("--entities", nargs="*", help="entity codes to keep (default: all)")
    b.add_argument("--countries", nargs="*", help="capacity country names to keep (default: all)")
    b.add_argument("--out", required=True, help="output folder on shared storage")
    c = sub.add_parser("checks", help="re-run the declared column checks on stored tables")
    c.add_argument("--out", required=True, help="folder written by 'build'")
    return p


def main(argv: list[str] | None = None) -> int:
    args = _parser().parse_args(argv)
    from gridmart.plans.build import Inputs, build_all, run_checks_only
    from gridmart.session import get_spark
    spark = get_spark()
    if args.cmd == "build":
        geo = []
        if args.geo:
            with open(args.geo) as fh:
                geo = json.load(fh)
        inputs = Inputs(long_csv=args.long, wide_csv=args.wide, capacity_csv=args.capacity,
                        geo_resources=geo, seed_csv=args.seed, entities=args.entities,
                        capacity_countries=args.countries)
        print(json.dumps(build_all(spark, inputs, args.out), indent=1))
        return 0
    failed = run_checks_only(spark, args.out).filter("NOT passed").collect()     # one row per declared check at most
    for r in failed:
        print(r["table_name"], r["column_name"], r["check_name"], r["violations"])
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
