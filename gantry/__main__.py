"""The batch run as a job: ``spark-submit`` or ``python -m gantry``."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from gantry.plans.medallion import run_pipeline
from gantry.schema import LakePaths


def main() -> None:
    parser = argparse.ArgumentParser(prog="gantry", description="Landing files to Bronze, Silver and Gold tables.")
    parser.add_argument("base", help="folder that holds the tables")
    parser.add_argument("--landing", help="landing folder (default: <base>/landing_zone)")
    parser.add_argument("--mode", choices=["fail", "report"], default="fail", help="on a broken contract")
    parser.add_argument("--full", action="store_true", help="merge all rows again, not only changed days")
    parser.add_argument("--infer", action="store_true", help="take the columns from the files")
    parser.add_argument("--evolve", action="store_true", help="add new columns to the tables")
    parser.add_argument("--moves-within", type=int, metavar="DAYS", help="days that a correction moves a reading by at most")
    args = parser.parse_args()

    paths = LakePaths(args.base.rstrip("/"))
    spark = (
        SparkSession.builder.appName("gantry").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    # The session is left to whoever owns it.
    schema_mode = "evolve" if args.evolve else "strict"
    landing = args.landing or paths.landing
    for v in run_pipeline(
        spark, landing, paths, args.mode, not args.full, args.infer, schema_mode, args.moves_within
    ):
        print(f"contract: {v.column} {v.check} {v.failures}")


if __name__ == "__main__":
    main()
