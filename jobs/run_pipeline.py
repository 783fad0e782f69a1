"""``spark-submit jobs/run_pipeline.py --retail_csv ... --logistics_csv ... --out_dir ...``"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from orderflow.models import delay, demand
from orderflow.models.forest import ForestSize
from orderflow.plans.pipeline import ROW_ID, run_pipeline


def parse(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description="Build the supply-chain result tables.")
    # Names of the published inputs and of the result folder.
    parser.add_argument("--retail_csv", default="data_raw/retail_store_inventory.csv")
    parser.add_argument("--logistics_csv", default="data_raw/smart_logistics_dataset.csv")
    parser.add_argument("--out_dir", default="data_processed")
    parser.add_argument(
        "--tie_breakers",
        nargs="*",
        default=[ROW_ID],
        help="columns that order rows of one store, product and day; name or name:type",
    )
    parser.add_argument("--demand_trees", type=int, default=demand.SIZE.trees)
    parser.add_argument("--demand_depth", type=int, default=demand.SIZE.depth)
    parser.add_argument("--delay_trees", type=int, default=delay.SIZE.trees)
    parser.add_argument("--delay_depth", type=int, default=delay.SIZE.depth)
    return parser.parse_args(argv)


def main(argv: list[str] | None = None) -> None:
    args = parse(argv)
    spark = SparkSession.builder.appName("orderflow").getOrCreate()
    run_pipeline(
        spark,
        args.retail_csv,
        args.logistics_csv,
        args.out_dir,
        tie_breakers=args.tie_breakers,
        demand_size=ForestSize(args.demand_trees, args.demand_depth),
        delay_size=ForestSize(args.delay_trees, args.delay_depth),
    )


if __name__ == "__main__":
    main()
