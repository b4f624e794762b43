from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from fixtures import GOLDEN_LINES, text_lines

from daybook.functions import week_label
from daybook.operators import enrich_line_items, first_order_by_customer, with_first_order
from daybook.operators.quality import column_profile, date_bounds, sample_head


def test_week_label_fixture(spark):
    days = ["2022-01-01", "2022-12-31", "2023-01-01", "2023-01-02", "2024-01-01"]
    df = spark.createDataFrame([(d,) for d in days], "d string").select(
        F.col("d"), week_label(F.to_date("d")).alias("w")
    )
    assert {r.d: r.w for r in df.collect()} == {
        "2022-01-01": "2022-00",
        "2022-12-31": "2022-52",
        "2023-01-01": "2023-00",
        "2023-01-02": "2023-01",
        "2024-01-01": "2024-01",
    }


def test_week_label_matches_strftime_every_day(spark):
    start = dt.date(1995, 1, 1)
    n = (dt.date(2030, 12, 31) - start).days + 1
    df = spark.range(n).select(F.date_add(F.lit(start), F.col("id").cast("int")).alias("d"))
    got = {r.d: r.w for r in df.select("d", week_label("d").alias("w")).collect()}
    assert len(got) == n
    assert all(w == d.strftime("%Y-%W") for d, w in got.items())


def test_first_order_by_customer_is_case_sensitive_and_keeps_empty(spark):
    lines = text_lines(spark, GOLDEN_LINES)
    got = {r.email: r.first_order_date for r in first_order_by_customer(lines).collect()}
    assert got == {
        "a@x.com": dt.date(2024, 1, 1),
        "b@x.com": dt.date(2024, 1, 1),
        "c@x.com": dt.date(2024, 1, 3),
        "d@x.com": dt.date(2024, 1, 6),
        "B@x.com": dt.date(2024, 1, 7),
        "": dt.date(2024, 1, 8),
        "e@x.com": None,
    }


def test_join_preserves_rows_and_guests_get_null(spark):
    lines = text_lines(spark, GOLDEN_LINES)
    joined = with_first_order(lines)
    assert joined.count() == len(GOLDEN_LINES)
    guests = joined.where(F.col("email").isNull()).select("first_order_date").collect()
    assert len(guests) == 2 and all(r[0] is None for r in guests)


def test_enriched_columns(spark):
    lines = text_lines(spark, GOLDEN_LINES)
    rows = enrich_line_items(lines).where(F.col("order_id") == "1004").collect()
    assert len(rows) == 1
    r = rows[0]
    assert float(r.product_rev) == 30.0
    assert r.week == "2024-01"
    assert r.first_order_date == dt.date(2024, 1, 1)
    assert r.age == 1
    assert r.cutoff_60_days == dt.date(2024, 3, 1)
    assert r.first_order_month == "2024-01"
    assert r.first_order_fl == 0
    guest = enrich_line_items(lines).where(F.col("order_id") == "1005").first()
    assert guest.first_order_fl == 0 and guest.age is None and guest.first_order_month is None


def test_profiles(spark):
    lines = text_lines(spark, GOLDEN_LINES)
    prof = {r.column_name: (r.data_type, r.non_null_count) for r in column_profile(lines).collect()}
    assert prof == {
        "order_id": ("string", 12),
        "email": ("string", 11),
        "order_date": ("date", 12),
        "quantity": ("double", 12),
        "price": ("double", 13),
    }
    b = date_bounds(lines).first()
    assert (b.min_order_date, b.max_order_date) == (dt.date(2024, 1, 1), dt.date(2024, 1, 8))
    head = sample_head(lines, 3).collect()
    assert [r.order_id for r in head] == [None, "1001", "1001"]


def test_to_day_keeps_local_date_part(spark):
    from daybook.functions import to_day

    texts = ["2024-01-01", "2024-01-01 23:30:00", "2024-01-01T23:30:00-05:00", "2024-01-01T00:15:00+09:00", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(to_day("t").alias("d"))
    assert [r.d for r in df.collect()] == [dt.date(2024, 1, 1)] * 4 + [None]


def test_to_day_rejects_garbage(spark):
    import pytest

    from daybook.functions import to_day

    df = spark.createDataFrame([("not a date",)], "t string").select(to_day("t").alias("d"))
    with pytest.raises(Exception):
        df.collect()


def test_line_items_from_catalog_table(spark, scratch):
    import uuid

    from daybook.sources import line_items_from_table

    name = f"li_{uuid.uuid4().hex[:8]}"
    path = scratch("cat") + "/lines.parquet"
    text_lines(spark, GOLDEN_LINES).write.parquet(path)
    spark.sql(f"CREATE TABLE {name} USING parquet LOCATION '{path}'")
    try:
        lines = line_items_from_table(spark, name)
        assert lines.columns == ["order_id", "email", "order_date", "quantity", "price"]
        assert lines.count() == len(GOLDEN_LINES)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_yesterday_uses_session_time_zone(spark):
    from zoneinfo import ZoneInfo

    from daybook.plans import yesterday

    tz = spark.conf.get("spark.sql.session.timeZone")
    expected = dt.datetime.now(ZoneInfo(tz)).date() - dt.timedelta(days=1)
    assert yesterday(spark) in (expected, expected + dt.timedelta(days=1))
