"""Command line for spark-submit.

    spark-submit -m daybook.plans.cli create   --table T --location L
    spark-submit -m daybook.plans.cli backfill --source SRC [--location L] [--table T] [--share-source] [--by-version]
    spark-submit -m daybook.plans.cli daily    --source SRC --table T [--date YYYY-MM-DD] [--dimension D | --dimension-table DT] [--broadcast-limit-mb N]
    spark-submit -m daybook.plans.cli catch-up --source SRC --table T --dates YYYY-MM-DD [YYYY-MM-DD ...] [--dimension D | --dimension-table DT]
    spark-submit -m daybook.plans.cli repair   --source SRC --late LATE --table T (--old D1 --location D2 | --dimension-table DT)
    spark-submit -m daybook.plans.cli dimension --source SRC --location D [--through YYYY-MM-DD]
    spark-submit -m daybook.plans.cli merge-dimension --source SRC --old D1 --location D2 [--through YYYY-MM-DD]
    spark-submit -m daybook.plans.cli bucket-dimension --source SRC --table DT --location D --buckets N [--through YYYY-MM-DD]
    spark-submit -m daybook.plans.cli merge-buckets --source SRC --table DT [--through YYYY-MM-DD]

``SRC`` is a catalog table name or a parquet folder with the line-item
columns (order_id, email, order_date, quantity, price); ``--partition-column``
names its DATE partition column, if it has one that holds the order day.
With ``--csv`` sources are folders of CSV files, each read by its own header.
``--time-zone`` is the shop's zone, which decides what yesterday is.

Publishing commands print the run's profile. ``repair`` takes the late lines
(``LATE``, already part of ``SRC``) and the dimension of before, and writes the
new dimension.

``--shuffle-partitions N`` sets ``spark.sql.shuffle.partitions``. Size it to
the input: about one partition per 128 MB of line-item data read. AQE merges
partitions that turn out small but cannot split large ones (except skewed
join partitions), so err on the high side.
"""

from __future__ import annotations

import argparse
import datetime as dt

from daybook.plans.jobs import (
    create_table,
    merge_dimension,
    merge_into_bucketed_dimension,
    refresh_bucketed_dimension,
    refresh_dimension,
    run_backfill,
    run_catch_up,
    run_daily,
    run_repair,
    run_repair_in_buckets,
)
from daybook.operators.run_profile import RunProfile
from daybook.session import build_session
from daybook.sources import line_items_from_csv_by_header, line_items_from_table


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="daybook")
    parser.add_argument("--shuffle-partitions", type=int, default=None)
    parser.add_argument("--time-zone", help="session time zone: a region or an offset such as +02:00")
    parser.add_argument("--partition-column", help="DATE partition column of the source with the order day")
    parser.add_argument("--csv", action="store_true", help="sources are folders of CSV files with headers")
    sub = parser.add_subparsers(dest="command", required=True)

    p_create = sub.add_parser("create", help="create the partitioned statistics table")
    p_create.add_argument("--table", required=True)
    p_create.add_argument("--location", required=True)

    p_back = sub.add_parser("backfill", help="recompute and publish every day")
    p_back.add_argument("--source", required=True)
    p_back.add_argument("--location", help="default: the table's location")
    p_back.add_argument("--table")
    p_back.add_argument(
        "--share-source",
        action="store_true",
        help="read the source once (for sources that are views over joins or text files)",
    )

    p_back.add_argument("--by-version", action="store_true", help="stage, audit, then switch partitions (CSV table)")

    p_catch = sub.add_parser("catch-up", help="publish several days in one pass")
    p_catch.add_argument("--source", required=True)
    p_catch.add_argument("--table", required=True)
    p_catch.add_argument("--dates", nargs="+", type=dt.date.fromisoformat, required=True)
    p_catch.add_argument("--dimension", help="folder of a persisted first-order dimension")
    p_catch.add_argument("--dimension-table", help="table of a first-order dimension in buckets")

    p_repair = sub.add_parser("repair", help="publish the days that late lines change")
    p_repair.add_argument("--source", required=True, help="all lines, the late ones included")
    p_repair.add_argument("--late", required=True, help="the late lines")
    p_repair.add_argument("--table", required=True)
    p_repair.add_argument("--old", help="the dimension from before the late lines")
    p_repair.add_argument("--location", help="where the new dimension goes")
    p_repair.add_argument("--dimension-table", help="a dimension in buckets, merged in place")

    p_daily = sub.add_parser("daily", help="publish one day (default yesterday)")
    p_daily.add_argument("--source", required=True)
    p_daily.add_argument("--table", required=True)
    p_daily.add_argument("--date")
    p_daily.add_argument("--dimension", help="folder of a persisted first-order dimension")
    p_daily.add_argument("--dimension-table", help="table of a first-order dimension in buckets")
    p_daily.add_argument(
        "--broadcast-limit-mb",
        type=int,
        help="cap for broadcasting the day's customers (default: session threshold; 0: never)",
    )

    p_dim = sub.add_parser("dimension", help="rebuild the first-order dimension into a new folder")
    p_dim.add_argument("--source", required=True)
    p_dim.add_argument("--location", required=True)
    p_dim.add_argument("--through", type=dt.date.fromisoformat, help="last day whose lines are all there")

    p_merge = sub.add_parser("merge-dimension", help="fold new lines into a new version of the dimension")
    p_merge.add_argument("--source", required=True, help="the lines loaded since the old version")
    p_merge.add_argument("--old", required=True)
    p_merge.add_argument("--location", required=True)
    p_merge.add_argument("--through", type=dt.date.fromisoformat, help="last day whose lines are all there")

    p_bucket = sub.add_parser("bucket-dimension", help="rebuild the first-order dimension into a table in buckets")
    p_bucket.add_argument("--source", required=True)
    p_bucket.add_argument("--table", required=True)
    p_bucket.add_argument("--location", required=True)
    p_bucket.add_argument("--buckets", type=int, required=True, help="about one for each 128 MB of (email, date)")
    p_bucket.add_argument("--through", type=dt.date.fromisoformat, help="last day whose lines are all there")

    p_fold = sub.add_parser("merge-buckets", help="fold new lines into a dimension in buckets")
    p_fold.add_argument("--source", required=True, help="the lines loaded since the last merge")
    p_fold.add_argument("--table", required=True)
    p_fold.add_argument("--through", type=dt.date.fromisoformat, help="last day whose lines are all there")

    args = parser.parse_args(argv)
    if args.command == "repair" and bool(args.dimension_table) == bool(args.old and args.location):
        parser.error("repair takes --old and --location, or --dimension-table")
    spark = build_session(shuffle_partitions=args.shuffle_partitions)
    if args.shuffle_partitions:
        spark.conf.set("spark.sql.shuffle.partitions", str(args.shuffle_partitions))
    if args.time_zone:
        spark.conf.set("spark.sql.session.timeZone", args.time_zone)
    if args.command == "create":
        create_table(spark, args.table, args.location)
        return

    def read(source: str):
        if args.csv:
            return line_items_from_csv_by_header(spark, source)
        return line_items_from_table(spark, source, args.partition_column)

    lines = read(args.source)
    if args.command == "backfill":
        show(run_backfill(spark, lines, args.location, args.table, share_source=args.share_source, by_version=args.by_version))
    elif args.command == "catch-up":
        show(run_catch_up(spark, lines, args.table, args.dates, args.dimension, args.dimension_table))
    elif args.command == "repair":
        late = read(args.late)
        if args.dimension_table:
            show(run_repair_in_buckets(spark, lines, late, args.table, args.dimension_table))
        else:
            show(run_repair(spark, lines, late, args.table, args.old, args.location))
    elif args.command == "dimension":
        refresh_dimension(lines, args.location, args.through)
    elif args.command == "merge-dimension":
        merge_dimension(spark, lines, args.old, args.location, args.through)
    elif args.command == "bucket-dimension":
        refresh_bucketed_dimension(spark, lines, args.table, args.location, args.buckets, args.through)
    elif args.command == "merge-buckets":
        print(f"buckets rewritten: {len(merge_into_bucketed_dimension(spark, lines, args.table, args.through))}")
    else:
        limit = None if args.broadcast_limit_mb is None else args.broadcast_limit_mb << 20
        show(run_daily(spark, lines, args.table, args.date, args.dimension, broadcast_limit_bytes=limit, dimension_table=args.dimension_table))


def show(profile: RunProfile | None) -> None:
    """Prints what a job saw and wrote."""
    if profile is None:
        return
    for column, kind in profile.types.items():
        print(f"{column}: {kind}")
    for scope, figures in profile.figures().items():
        for item, value in figures.items():
            if item == "first_rows":
                value = "\n  ".join(["", *(str(tuple(r)) for r in value)])
            print(f"{scope} {item}: {value if item != 'listed' else len(value)}")
    if profile.published is not None:
        print(f"partitions added or moved: {len(profile.published)}")


if __name__ == "__main__":
    main()
