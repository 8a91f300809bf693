"""``python -m netload STAGE FOLDER``; also the entry for ``spark-submit``."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from netload import jobs, scratch
from netload.sources import synthetic


def main() -> None:
    parser = argparse.ArgumentParser(prog="netload")
    parser.add_argument("stage", choices=["produce", "convert", "saturate", "follow", "views"])
    parser.add_argument("folder", help="data folder all executors share")
    parser.add_argument("--rows", type=int, default=synthetic.DEFAULT_ROWS)
    parser.add_argument("--seed", type=int, default=synthetic.EVENT_SEED)
    parser.add_argument("--no-compact", action="store_true", help="convert without a shuffle: more and uneven files")
    parser.add_argument("--heure", help="show one hour only, e.g. 8")
    args = parser.parse_args()

    spark = SparkSession.builder.appName(f"netload {args.stage}").getOrCreate()
    if args.stage == "produce":
        jobs.produce(spark, args.folder, args.rows, args.seed)
    elif args.stage == "convert":
        jobs.convert(spark, args.folder, not args.no_compact).show(truncate=False)
    elif args.stage == "saturate":
        jobs.saturate(spark, args.folder)
    elif args.stage == "follow":
        jobs.follow(spark, args.folder).awaitTermination()
    else:
        for name, view in jobs.views(spark, args.folder, args.heure).items():
            print(name)
            view.show(30, truncate=False)
    scratch.clear(spark)
    spark.stop()


if __name__ == "__main__":
    main()
