from __future__ import annotations

import datetime as dt
import os
import uuid

from pyspark.sql import functions as F

from fixtures import GOLDEN_EXPECTED, GOLDEN_LINES, text_lines

from daybook.operators import daily_stats
from daybook.operators.sink import (
    create_daily_stats_table,
    drop_daily_stats_table,
    read_daily_stats,
    registered_partitions,
    table_location,
    write_daily_stats,
)
from daybook.plans import run_backfill, run_daily
from daybook.schema import DAILY_STATS_COLUMNS
from fixtures import local_path


def _table():
    return f"t_{uuid.uuid4().hex[:10]}"


def _rows(df):
    return sorted((tuple(r) for r in df.select(*DAILY_STATS_COLUMNS).collect()), key=lambda r: r[0])


def test_roundtrip_preserves_null_and_zero(spark, scratch):
    loc = scratch("rt")
    write_daily_stats(daily_stats(text_lines(spark, GOLDEN_LINES)), loc)
    back = read_daily_stats(spark, loc)
    assert _rows(back) == GOLDEN_EXPECTED
    assert back.where(F.col("partition_date") != F.col("order_date")).count() == 0
    days = sorted(d for d in os.listdir(local_path(loc)) if d.startswith("partition_date="))
    assert len(days) == len(GOLDEN_EXPECTED)
    for d in days:
        files = [f for f in os.listdir(os.path.join(local_path(loc), d)) if f.startswith("part-")]
        assert len(files) == 1  # one file per day


def test_legacy_float_counts_and_header_only_file(spark, scratch):
    loc = local_path(scratch("legacy"))
    header = ",".join(DAILY_STATS_COLUMNS)
    os.makedirs(f"{loc}/partition_date=2024-01-01")
    with open(f"{loc}/partition_date=2024-01-01/legacy.csv", "w") as fh:
        fh.write(header + "\n")
        fh.write("2024-01-01,60.0,3.0,2.0,20.0,2.0,60.0,,\n")
        fh.write("2024-01-01,1.0,1.0,1.0,1.0,,,3.0,1.0\n")
    os.makedirs(f"{loc}/partition_date=2024-01-02")
    with open(f"{loc}/partition_date=2024-01-02/empty.csv", "w") as fh:
        fh.write(header + "\n")
    rows = read_daily_stats(spark, loc).orderBy("total_product_revenue").collect()
    assert len(rows) == 2
    assert rows[0].repeat_customer_count == 3 and rows[0].new_customer_count is None
    assert rows[1].total_order_count == 3 and rows[1].repeat_customer_count is None


def test_rerun_is_idempotent_and_leaves_other_days(spark, scratch):
    loc = scratch("idem")
    lines = text_lines(spark, GOLDEN_LINES)
    run_backfill(spark, lines, loc)
    run_backfill(spark, lines, loc)
    assert _rows(read_daily_stats(spark, loc)) == GOLDEN_EXPECTED
    # A backfill over a subset only replaces the days it contains.
    subset = lines.where(F.col("order_date") <= "2024-01-02")
    run_backfill(spark, subset, loc)
    assert _rows(read_daily_stats(spark, loc)) == GOLDEN_EXPECTED


def test_daily_job_table_overwrite_empty_day_and_registration(spark, scratch):
    loc = scratch("daily")
    table = _table()
    lines = text_lines(spark, GOLDEN_LINES)
    create_daily_stats_table(spark, table, loc)
    try:
        run_backfill(spark, lines, loc, table)
        assert _rows(spark.table(table)) == GOLDEN_EXPECTED
        # Rerun of one day: same table.
        run_daily(spark, lines, table, "2024-01-02")
        run_daily(spark, lines, table, dt.date(2024, 1, 2))
        assert _rows(spark.table(table)) == GOLDEN_EXPECTED
        # A day that lost its lines is emptied, not left stale, and stays registered.
        shrunk = lines.where(F.col("order_date") != "2024-01-04")
        run_daily(spark, shrunk, table, "2024-01-04")
        expected = [r for r in GOLDEN_EXPECTED if r[0] != dt.date(2024, 1, 4)]
        assert _rows(spark.table(table)) == expected
        assert _rows(read_daily_stats(spark, loc)) == expected
        # A day with no lines at all is registered with zero rows.
        run_daily(spark, lines, table, "2024-02-01")
        days = {r[0] for r in registered_partitions(spark, table).collect()}
        assert dt.date(2024, 2, 1) in days and dt.date(2024, 1, 4) in days
        assert len(days) == len(GOLDEN_EXPECTED) + 1
    finally:
        drop_daily_stats_table(spark, table)


def test_create_table_never_alters_existing(spark, scratch):
    loc = scratch("ddl")
    table = _table()
    try:
        create_daily_stats_table(spark, table, loc)
        create_daily_stats_table(spark, table, scratch("other"))
        cols = [(c.name, c.dataType) for c in spark.catalog.listColumns(table)]
        assert [c[0] for c in cols] == list(DAILY_STATS_COLUMNS) + ["partition_date"]
        assert table_location(spark, table).rstrip("/").endswith(os.path.basename(loc))
    finally:
        drop_daily_stats_table(spark, table)


def test_daily_job_with_dimension(spark, scratch):
    from daybook.plans import refresh_dimension

    loc = scratch("dimdaily")
    dim = scratch("dimension")
    table = _table()
    lines = text_lines(spark, GOLDEN_LINES)
    refresh_dimension(lines, dim)
    create_daily_stats_table(spark, table, loc)
    try:
        for d in range(1, 9):
            run_daily(spark, lines, table, dt.date(2024, 1, d), dimension_location=dim)
        assert _rows(spark.table(table)) == GOLDEN_EXPECTED
    finally:
        drop_daily_stats_table(spark, table)


def test_cli_help_parses():
    import pytest

    from daybook.plans.cli import main

    with pytest.raises(SystemExit) as exc:
        main(["--help"])
    assert exc.value.code == 0


def test_cli_backfill_and_daily_end_to_end(spark, scratch):
    from daybook.plans.cli import main

    src = scratch("cli-src") + "/lines.parquet"
    text_lines(spark, GOLDEN_LINES).write.parquet(src)
    loc = scratch("cli-out")
    table = _table()
    try:
        main(["create", "--table", table, "--location", loc])
        old = spark.conf.get("spark.sql.shuffle.partitions")
        main(["--shuffle-partitions", "16", "backfill", "--source", src, "--location", loc, "--table", table, "--share-source"])
        assert spark.conf.get("spark.sql.shuffle.partitions") == "16"
        spark.conf.set("spark.sql.shuffle.partitions", old)
        main(["daily", "--source", src, "--table", table, "--date", "2024-01-03", "--broadcast-limit-mb", "64"])
        assert _rows(spark.table(table)) == GOLDEN_EXPECTED
    finally:
        drop_daily_stats_table(spark, table)


def test_daily_dimension_versions_roll_forward(spark, scratch):
    from daybook.plans import merge_dimension, refresh_dimension

    lines = text_lines(spark, GOLDEN_LINES)
    early = lines.where(F.col("order_date") <= "2024-01-03")
    later = lines.where(F.col("order_date") > "2024-01-03")
    v1, v2 = scratch("v1"), scratch("v2")
    refresh_dimension(early, v1)
    merge_dimension(spark, later, v1, v2)
    loc, table = scratch("roll"), _table()
    create_daily_stats_table(spark, table, loc)
    try:
        for d in range(1, 9):
            run_daily(spark, lines, table, dt.date(2024, 1, d), dimension_location=v2)
        assert _rows(spark.table(table)) == GOLDEN_EXPECTED
    finally:
        drop_daily_stats_table(spark, table)


def test_parquet_table_format(spark, scratch):
    loc = scratch("pq")
    table = _table()
    lines = text_lines(spark, GOLDEN_LINES)
    create_daily_stats_table(spark, table, loc, fmt="parquet")
    try:
        run_backfill(spark, lines, loc, table, fmt="parquet")
        assert _rows(spark.table(table)) == GOLDEN_EXPECTED
        back = spark.read.parquet(loc)
        assert _rows(back) == GOLDEN_EXPECTED
        assert back.where(F.col("partition_date") != F.col("order_date")).count() == 0
    finally:
        drop_daily_stats_table(spark, table)
