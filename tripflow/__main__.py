"""Command line: ``python -m tripflow <command> ...``

  pipeline     --sf DIR --out DIR [--as-of TS]          full batch update (all tables)
  stream       --landing DIR --sf DIR --out DIR          triggered incremental update; DIR/<type>/ per source
  maintenance  --out DIR [--as-of TS]                    compact 15 tables + purge quarantine
  query        NAME --sf DIR [--show N] [--explain]     run one registered query
  list                                                   list registered queries
"""

from __future__ import annotations

import argparse
import json
import os

from tripflow import config


def main(argv=None) -> None:
    p = argparse.ArgumentParser(prog="tripflow")
    sub = p.add_subparsers(dest="cmd", required=True)
    a = sub.add_parser("pipeline")
    a.add_argument("--sf", required=True)
    a.add_argument("--out", required=True)
    a.add_argument("--as-of")
    a = sub.add_parser("stream")
    a.add_argument("--landing", required=True)
    a.add_argument("--sf", required=True, help="directory holding the zone dimension inputs")
    a.add_argument("--out", required=True)
    a.add_argument("--as-of")
    a.add_argument("--max-files-per-trigger", type=int)
    a = sub.add_parser("maintenance")
    a.add_argument("--out", required=True)
    a.add_argument("--as-of")
    a = sub.add_parser("query")
    a.add_argument("name")
    a.add_argument("--sf", required=True)
    a.add_argument("--show", type=int, default=20)
    a.add_argument("--explain", action="store_true")
    sub.add_parser("list")
    args = p.parse_args(argv)

    from tripflow.plans import catalog
    if args.cmd == "list":
        print("\n".join(sorted(catalog.queries())))
        return

    from tripflow.session import get_session
    spark = get_session()
    if args.cmd == "pipeline":
        from tripflow.plans.pipeline import run_batch_pipeline
        print(json.dumps(run_batch_pipeline(spark, args.sf, args.out, as_of=args.as_of), indent=1))
    elif args.cmd == "stream":
        from tripflow.plans.pipeline import run_stream_pipeline
        from tripflow.sources import fixtures
        landing = {t: os.path.join(args.landing, t) for t in config.TAXI_TYPES}
        print(json.dumps(run_stream_pipeline(spark, landing, fixtures.raw_zones(spark, args.sf), args.out,
                                             args.as_of, args.max_files_per_trigger), indent=1))
    elif args.cmd == "maintenance":
        from tripflow.plans.maintenance import run_maintenance
        from tripflow.plans.pipeline import table_paths
        print(json.dumps(run_maintenance(spark, table_paths(args.out), args.as_of), indent=1))
    elif args.cmd == "query":
        df = catalog.queries()[args.name](spark, args.sf)
        if args.explain:
            df.explain("formatted")
        df.show(args.show, truncate=False)


if __name__ == "__main__":
    main()
