"""``spark-submit`` entry: one run of the whole pipeline with the session it is given."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from tidemark import config as C
from tidemark.operators.history import publish_history
from tidemark.plans import pipeline
from tidemark.sources.lake import Lake


def main() -> None:
    parser = argparse.ArgumentParser(prog="tidemark", description=__doc__)
    parser.add_argument("lake", help="folder of the tables, reachable by all executors")
    parser.add_argument("--raw", help="folder of the history CSV files (full refresh)")
    parser.add_argument("--landing", help="landing zone of JSON Lines files (new files only)")
    parser.add_argument("--item-buckets", type=int, default=16, help="hash parts per load day")
    parser.add_argument("--tolerate-errors", action="store_true", help="do not fail on checks")
    parser.add_argument("--lookback-hours", type=int, default=C.LOOKBACK_HOURS,
                        help="how far before the newest item an increment reaches back")
    parser.add_argument("--payment-types", nargs="+", default=list(C.ACCEPTED_PAYMENT_TYPES),
                        help="accepted payment types")
    parser.add_argument("--trust-file-times", action="store_true",
                        help="do not compare the content of known landing files")
    parser.add_argument("--rebuild-items", action="store_true", help="build the item fact anew")
    args = parser.parse_args()
    lake = Lake(SparkSession.builder.appName("tidemark").getOrCreate(), args.lake)
    result = pipeline.run(
        lake, args.raw, args.landing, item_buckets=args.item_buckets,
        raise_on_error=not args.tolerate_errors, lookback_hours=args.lookback_hours,
        payment_types=args.payment_types, trust_file_times=args.trust_file_times,
        rebuild_items=args.rebuild_items,
    )
    lake.publish()
    publish_history(lake, "snap_customers")
    result.orderBy("status", "check").show(100, truncate=False)


if __name__ == "__main__":
    main()
