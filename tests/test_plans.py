"""Physical-plan checks: the scale properties the design relies on."""

from __future__ import annotations

import re

from fixtures import GOLDEN_LINES, text_lines
from conftest import SF001

from daybook.operators import daily_stats, daily_stats_for_day, enrich_line_items
from daybook.sources import line_items_from_table, line_items_from_tpch


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_backfill_plan_has_no_expand_or_cartesian(spark):
    plan = _plan(daily_stats(line_items_from_tpch(spark, SF001)))
    assert "Expand" not in plan
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    # Customer figures come from a window over the (day, customer) grain only.
    assert plan.count("Window") == 1


def test_backfill_partial_aggregation_before_every_shuffle(spark):
    lines = line_items_from_tpch(spark, SF001)
    plan = _plan(daily_stats(lines))
    assert "partial_sum" in plan
    assert "partial_count" in plan


def test_scans_are_pruned(spark):
    plan = _plan(daily_stats(line_items_from_tpch(spark, SF001)))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    lineitem = [s for s in schemas if "l_orderkey" in s]
    assert lineitem and all(set(s.split(",")) <= {"l_orderkey:bigint", "l_partkey:bigint", "l_quantity:double"} for s in lineitem)
    assert not any("l_comment" in s or "l_extendedprice" in s for s in schemas)


def test_daily_job_pushes_day_filters_to_scan(spark, scratch):
    path = scratch("src") + "/lines.parquet"
    text_lines(spark, GOLDEN_LINES).write.parquet(path)
    lines = line_items_from_table(spark, path)
    import datetime as dt

    from pyspark.sql import functions as F

    from daybook.operators.per_day import order_grain

    # The day's lines (read once, into the checkpoint) ...
    day_plan = _plan(order_grain(lines.where(F.col("order_date") == dt.date(2024, 1, 2))))
    assert "EqualTo(order_date,2024-01-02)" in " ".join(re.findall(r"PushedFilters: \[([^\]]*)\]", day_plan))
    # ... and the history side of the single-day job.
    plan = _plan(daily_stats_for_day(lines, "2024-01-02"))
    pushed = " ".join(re.findall(r"PushedFilters: \[([^\]]*)\]", plan))
    assert "LessThan(order_date,2024-01-02)" in pushed
    # The single-day job never runs the full-history window.
    assert "Window" not in plan


def test_enriched_join_is_keyed_on_customer_and_day(spark):
    plan = _plan(enrich_line_items(line_items_from_tpch(spark, SF001)))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    # The window runs over distinct (day, customer) pairs, never over lines.
    assert plan.count("Window") == 1
    # Guests go round the join.
    assert "Union" in plan
    join = [ln for ln in plan.splitlines() if "LeftOuter" in ln]
    assert join and "email" in join[0] and "order_date" in join[0]


def test_no_python_in_plans(spark):
    lines = line_items_from_tpch(spark, SF001)
    for df in (daily_stats(lines), daily_stats_for_day(lines, "1995-11-30"), enrich_line_items(lines)):
        plan = _plan(df)
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def _initial(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_daily_job_broadcasts_checked_customer_set(spark, scratch):
    path = scratch("src") + "/lines.parquet"
    text_lines(spark, GOLDEN_LINES).write.parquet(path)
    lines = line_items_from_table(spark, path)
    plan = _initial(daily_stats_for_day(lines, "2024-01-02"))
    semi = [ln for ln in plan.splitlines() if "LeftSemi" in ln]
    assert semi and all("BroadcastHashJoin" in ln for ln in semi)


def test_daily_job_without_broadcast_falls_back_to_shuffle_join(spark, scratch):
    from fixtures import GOLDEN_EXPECTED

    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lines = text_lines(spark, GOLDEN_LINES)
        df = daily_stats_for_day(lines, "2024-01-04")
        assert "LeftSemi" not in _initial(df)
        assert not any("Broadcast" in ln for ln in _initial(df).splitlines() if "email" in ln and "Join" in ln)
        assert [tuple(r) for r in df.collect()] == [r for r in GOLDEN_EXPECTED if str(r[0]) == "2024-01-04"]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_broadcast_limit_parsing(spark):
    from daybook.operators.first_order import broadcast_limit_bytes

    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        for raw, want in [("10485760b", 10485760), ("10m", 10 << 20), ("-1", -1), ("2048", 2048)]:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", raw)
            assert broadcast_limit_bytes(spark) == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_shared_source_backfill_reads_lines_once(spark):
    lines = line_items_from_tpch(spark, SF001)
    df = daily_stats(lines, share_source=True)
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "ReusedExchange" in final
    # One scan of each adapter table (lineitem, orders, part) instead of two.
    assert final.count("FileScan parquet") == 3
    assert "Expand" not in final and "CartesianProduct" not in final


def test_daily_job_explicit_broadcast_cap(spark):
    from fixtures import GOLDEN_EXPECTED

    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lines = text_lines(spark, GOLDEN_LINES)
        df = daily_stats_for_day(lines, "2024-01-04", broadcast_limit_bytes=64 << 20)
        semi = [ln for ln in _initial(df).splitlines() if "LeftSemi" in ln]
        assert semi and all("BroadcastHashJoin" in ln for ln in semi)
        assert [tuple(r) for r in df.collect()] == [r for r in GOLDEN_EXPECTED if str(r[0]) == "2024-01-04"]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
