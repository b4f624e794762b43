from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import SF01
from fixtures import GOLDEN_EXPECTED, GOLDEN_LINES, text_lines

from daybook.operators import (
    daily_stats,
    daily_stats_for_day,
    daily_totals,
    new_customer_daily,
    repeat_customer_daily,
)
from daybook.schema import DAILY_STATS_COLUMNS, DAILY_STATS_SCHEMA
from daybook.sources import line_items_from_tpch


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: r[0])


def test_golden_edge_fixture(spark):
    out = daily_stats(text_lines(spark, GOLDEN_LINES))
    assert tuple(out.columns) == DAILY_STATS_COLUMNS
    assert [(f.name, f.dataType) for f in out.schema] == [
        (f.name, f.dataType) for f in DAILY_STATS_SCHEMA
    ]
    assert _rows(out) == GOLDEN_EXPECTED


@pytest.mark.parametrize("day", [dt.date(2024, 1, d) for d in range(1, 10)])
def test_daily_job_equals_backfill_slice_on_golden(spark, day):
    lines = text_lines(spark, GOLDEN_LINES)
    expected = [r for r in GOLDEN_EXPECTED if r[0] == day]
    assert _rows(daily_stats_for_day(lines, day)) == expected


def test_daily_job_equals_backfill_slice_sf001(spark):
    lines = line_items_from_tpch(spark, SF01)
    full = {r[0]: tuple(r) for r in daily_stats(lines).collect()}
    for day in ["1995-01-01", "1995-11-30", "1998-06-15", "2001-08-01", "2030-01-01"]:
        d = dt.date.fromisoformat(day)
        got = _rows(daily_stats_for_day(lines, day))
        assert got == ([full[d]] if d in full else [])


def test_fixture_days_sf001(spark):
    out = {r[0]: tuple(r[1:]) for r in daily_stats(line_items_from_tpch(spark, SF01)).collect()}
    assert len(out) == 2399
    assert out[dt.date(1995, 11, 30)] == (816246.6, 9, 8, 90694.06666666667, 1, 127212.8, 7, 689033.8)
    assert out[dt.date(2001, 8, 1)] == (211507.5, 2, 1, 105753.75, None, None, 1, 211507.5)
    assert sum(1 for v in out.values() if v[4] is None) == 1854
    assert sum(1 for v in out.values() if v[6] is None) == 35
    assert sum(1 for v in out.values() if v[6] == 0) == 38


def test_late_line_turns_new_into_repeat(spark):
    base = GOLDEN_LINES + [("2001", "f@x.com", "2024-01-09", "1", "1.00")]
    before = {r[0]: r for r in daily_stats(text_lines(spark, base)).collect()}
    assert before[dt.date(2024, 1, 9)]["new_customer_count"] == 1
    late = base + [("2002", "f@x.com", "2024-01-02", "1", "1.00")]
    after = {r[0]: r for r in daily_stats(text_lines(spark, late)).collect()}
    assert after[dt.date(2024, 1, 9)]["new_customer_count"] is None
    assert after[dt.date(2024, 1, 9)]["repeat_customer_count"] == 1
    assert after[dt.date(2024, 1, 2)]["new_customer_count"] == 1


def test_guests_are_never_new(spark):
    # Guests on their "first" day must still be repeat spend (window trap).
    rows = [("1", None, "2024-03-01", "1", "5.0"), ("2", None, "2024-03-02", "1", "6.0")]
    out = _rows(daily_stats(text_lines(spark, rows)))
    assert out == [
        (dt.date(2024, 3, 1), 5.0, 1, 0, 5.0, None, None, 0, 5.0),
        (dt.date(2024, 3, 2), 6.0, 1, 0, 6.0, None, None, 0, 6.0),
    ]


def test_hot_customer_and_hot_guest_group(spark):
    # One customer and the guest group each hold a third of all lines.
    n = 3000
    hot = [(str(i), "hot@x.com", f"2024-02-{1 + i % 28:02d}", "1", "2.0") for i in range(n)]
    guests = [(str(n + i), None, f"2024-02-{1 + i % 28:02d}", "1", "1.0") for i in range(n)]
    others = [(str(2 * n + i), f"u{i}@x.com", f"2024-02-{1 + i % 28:02d}", "2", "1.0") for i in range(n)]
    lines = text_lines(spark, hot + guests + others)
    out = {r[0]: r for r in daily_stats(lines).collect()}
    assert len(out) == 28
    first = out[dt.date(2024, 2, 1)]
    assert first["new_customer_count"] == sum(1 for i in range(n) if i % 28 == 0) + 1
    later = out[dt.date(2024, 2, 2)]
    assert later["repeat_customer_count"] == 1
    total_rev = sum(r["total_product_revenue"] for r in out.values())
    assert total_rev == pytest.approx(n * 2.0 + n * 1.0 + n * 2.0)
    assert sum(r["total_order_count"] for r in out.values()) == 3 * n


def test_invariants_sf001(spark):
    lines = line_items_from_tpch(spark, SF01)
    out = daily_stats(lines)
    c = F.coalesce
    bad = out.where(
        (c("new_customer_count", F.lit(0)) + c("repeat_customer_count", F.lit(0)) != F.col("total_customer_count"))
        | (
            F.abs(
                c("new_customer_spend", F.lit(0.0)) + c("repeat_customer_spend", F.lit(0.0))
                - F.col("total_product_revenue")
            )
            > 1e-6 * F.greatest(F.lit(1.0), F.col("total_product_revenue"))
        )
    )
    assert bad.count() == 0  # I1, I2
    new_total = out.agg(F.sum("new_customer_count")).first()[0]
    customers = lines.where(F.col("email").isNotNull() & F.col("order_date").isNotNull())
    assert new_total == customers.select("email").distinct().count()  # I3
    assert out.groupBy("order_date").count().where("count <> 1").count() == 0  # I4
    earliest = out.orderBy("order_date").first()
    assert earliest["repeat_customer_count"] in (None, 0)  # I6


def test_single_segment_queries_match_backfill(spark):
    lines = text_lines(spark, GOLDEN_LINES)
    totals = _rows(daily_totals(lines))
    assert totals == [r[:5] for r in GOLDEN_EXPECTED]
    assert _rows(new_customer_daily(lines)) == [
        (r[0], r[5], r[6]) for r in GOLDEN_EXPECTED if r[5] is not None
    ]
    assert _rows(repeat_customer_daily(lines)) == [
        (r[0], r[7], r[8]) for r in GOLDEN_EXPECTED if r[7] is not None
    ]


def test_bad_number_raises(spark):
    rows = [("1", "a@x.com", "2024-01-01", "", "1.0")]
    with pytest.raises(Exception):
        daily_stats(text_lines(spark, rows)).collect()


def test_undated_lines_are_excluded_and_counted(spark):
    from daybook.operators.quality import null_counts

    lines = text_lines(spark, GOLDEN_LINES)
    assert all(r[0] is not None for r in daily_stats(lines).collect())
    assert null_counts(lines).first()["null_order_date"] == 1
