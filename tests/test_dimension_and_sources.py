from __future__ import annotations

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from fixtures import GOLDEN_EXPECTED, GOLDEN_LINES, text_lines

from daybook.operators import daily_stats, with_first_order
from daybook.operators.dimension import (
    build_first_order_dimension,
    daily_stats_for_day_from_dimension,
    merge_first_order_dimension,
    read_dimension,
    write_dimension,
)
from fixtures import local_path
from daybook.sources import line_items_from_csv


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: r[0])


@pytest.mark.parametrize("day", [dt.date(2024, 1, d) for d in range(1, 10)])
def test_daily_from_dimension_equals_backfill_slice(spark, day):
    lines = text_lines(spark, GOLDEN_LINES)
    dim = build_first_order_dimension(lines)
    expected = [r for r in GOLDEN_EXPECTED if r[0] == day]
    assert _rows(daily_stats_for_day_from_dimension(lines, dim, day)) == expected


def test_dimension_merge_handles_late_lines(spark, scratch):
    lines = text_lines(spark, GOLDEN_LINES)
    loc = scratch("dim")
    write_dimension(build_first_order_dimension(lines), loc, dt.date(2024, 1, 8))
    late = text_lines(spark, [("9001", "b@x.com", "2023-12-31", "1", "1.0"), ("9002", "z@x.com", "2024-01-05", "1", "1.0")])
    merged = {r.email: r.first_order_date for r in merge_first_order_dimension(read_dimension(spark, loc), late).collect()}
    assert merged["b@x.com"] == dt.date(2023, 12, 31)
    assert merged["a@x.com"] == dt.date(2024, 1, 1)
    assert merged["z@x.com"] == dt.date(2024, 1, 5)
    assert "e@x.com" not in merged  # only undated lines: not in the dimension
    assert None not in merged


def test_csv_source_keeps_null_vs_empty(spark, scratch):
    loc = local_path(scratch("csv"))
    os.makedirs(loc)
    with open(f"{loc}/lines.csv", "w") as fh:
        fh.write("order_date,sku,order_id,email,quantity,price\n")
        fh.write('2024-01-01,A,1,"",1,2.0\n')
        fh.write("2024-01-01,B,2,,1,3.0\n")
        fh.write("2024-01-02,C,3,a@x.com,2,1.5\n")
    lines = line_items_from_csv(spark, loc)
    assert lines.columns == ["order_id", "email", "order_date", "quantity", "price"]
    emails = sorted((r.order_id, r.email) for r in lines.collect())
    assert emails == [("1", ""), ("2", None), ("3", "a@x.com")]
    out = {r.order_date: r for r in daily_stats(lines).collect()}
    assert out[dt.date(2024, 1, 1)].total_customer_count == 1  # '' is a customer
    assert out[dt.date(2024, 1, 1)].repeat_customer_spend == 3.0  # guest spend


def test_csv_source_rejects_bad_numbers(spark, scratch):
    loc = local_path(scratch("csvbad"))
    os.makedirs(loc)
    with open(f"{loc}/lines.csv", "w") as fh:
        fh.write("order_id,email,order_date,quantity,price\n")
        fh.write("1,a@x.com,2024-01-01,two,2.0\n")
    with pytest.raises(Exception):
        daily_stats(line_items_from_csv(spark, loc)).collect()


@pytest.fixture()
def tiny_skew_thresholds(spark):
    keys = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    }
    old = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def test_hot_join_keys_are_split_across_tasks(spark, tiny_skew_thresholds):
    n = 20000
    rows = (
        [(str(i), None, "2024-01-01", "1", "1.0") for i in range(n)]
        + [(str(n + i), "hot@x.com", "2024-01-02", "1", "1.0") for i in range(n)]
        + [(str(2 * n + i), f"u{i}@x.com", "2024-01-03", "1", "1.0") for i in range(n)]
    )
    lines = text_lines(spark, rows).repartition(8)
    joined = with_first_order(lines)
    got = joined.groupBy(F.col("first_order_date").isNull().alias("guest")).count().collect()
    assert {r.guest: r["count"] for r in got} == {True: n, False: 2 * n}
    df = with_first_order(lines)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "isFinalPlan=true" in plan
    assert "skew=true" in plan
