"""One job per layer: spark-submit this module, or ``python -m hearthlake <job> ...``.

What a run covers comes from the environment (see ``RunParams.from_env``).
"""

from __future__ import annotations

import argparse

from hearthlake.params import RunParams
from hearthlake.plans import pipeline
from hearthlake.session import Staging, build_session
from hearthlake.sources.pages import scan_raw_pages
from hearthlake.sources.tables import Lake

JOBS = ("snapshots", "bronze", "silver", "gold", "all")


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="hearthlake")
    parser.add_argument("job", choices=JOBS)
    parser.add_argument("--lake", required=True, help="root folder of the tables")
    parser.add_argument("--snapshots", required=True, help="root folder of the snapshots")
    parser.add_argument("--pages", help="landed pages (parquet: page_id, url, html)")
    parser.add_argument("--layout", choices=("table", "files"), default="table")
    args = parser.parse_args(argv)

    params = RunParams.from_env()
    spark = build_session(f"hearthlake-{args.job}")
    lake = Lake(spark, args.lake, params.environment)
    pages = scan_raw_pages(spark, args.pages) if args.pages else None
    if args.job == "all":
        pipeline.run(lake, pages, args.snapshots, params, args.layout)
        return
    with Staging(spark) as stage:
        if args.job == "snapshots":
            pipeline.land_snapshots(pages, args.snapshots, params, stage)
        elif args.job == "bronze":
            pipeline.load_landed(lake, args.snapshots, params, stage, args.layout)
        elif args.job == "silver":
            pipeline.build_silver(lake, params, stage)
        else:
            pipeline.build_gold(lake, params, stage)


if __name__ == "__main__":
    main()
