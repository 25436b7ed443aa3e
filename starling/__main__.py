"""Command line: ``python -m starling staging ...`` and ``python -m starling warehouse ...``."""

from __future__ import annotations

import argparse
from datetime import datetime

from starling.plans.staging_load import load_staging, load_unified
from starling.plans.warehouse_load import WarehouseLoad
from starling.schemas import STAGING, STAR, STAR_BANDS, UNIFIED
from starling.session import get_session
from starling.sources.store import Store


def main() -> None:
    parser = argparse.ArgumentParser(prog="starling")
    commands = parser.add_subparsers(dest="command", required=True)
    common = argparse.ArgumentParser(add_help=False)
    common.add_argument("--staging", required=True, help="folder of the staging store")
    common.add_argument("--log", required=True, help="folder the run log is appended to")
    common.add_argument("--run-ts", type=datetime.fromisoformat, default=datetime.now().replace(microsecond=0))
    staging = commands.add_parser("staging", parents=[common], help="copy source folders into staging")
    staging.add_argument("--source", action="append", default=[], metavar="NAME=FOLDER")
    staging.add_argument("--unified", action="store_true", help="one shared table per entity, first source wins")
    warehouse = commands.add_parser("warehouse", parents=[common], help="load the star schema from staging")
    warehouse.add_argument("--star", required=True, help="folder of the star store")
    warehouse.add_argument("--mode", choices=["incremental", "refresh"], default="incremental")
    warehouse.add_argument("--keys", choices=["natural", "source"], default="natural")
    args = parser.parse_args()

    spark = get_session()
    if args.command == "staging":
        folders = dict(item.split("=", 1) for item in args.source)
        load, schemas = (load_unified, UNIFIED) if args.unified else (load_staging, STAGING)
        log = load(spark, folders, Store(spark, args.staging, schemas), args.run_ts)
    else:
        stores = Store(spark, args.staging, STAGING), Store(spark, args.star, STAR, STAR_BANDS)
        log = WarehouseLoad(spark, *stores, args.run_ts, args.mode, args.keys).run()
    log.write(spark, args.log)
    spark.stop()


if __name__ == "__main__":
    main()
