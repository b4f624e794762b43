"""Edges at which results could go wrong without an error, and plans that must hold at scale."""

from __future__ import annotations

import datetime as dt
import os
import re
import uuid

import pytest
from pyspark.sql import functions as F

from fixtures import GOLDEN_EXPECTED, GOLDEN_LINES, local_path, text_lines

from daybook.operators import daily_stats, daily_stats_for_day, enrich_line_items, with_first_order
from daybook.operators.dimension import covered_through
from daybook.operators.first_order import customer_days, flag_against_seen
from daybook.operators.sink import create_daily_stats_table, drop_daily_stats_table, read_daily_stats, recover_partitions
from daybook.plans import merge_dimension, refresh_dimension, run_backfill, run_daily, yesterday
from daybook.schema import DAILY_STATS_COLUMNS
from daybook.session import is_local, remove_location
from daybook.sources import line_items_from_csv, line_items_from_table, line_items_from_tpch

HEADER = ",".join(DAILY_STATS_COLUMNS)


def _table():
    return f"t_{uuid.uuid4().hex[:10]}"


def _file(folder: str, name: str, text: str) -> str:
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w") as f:
        f.write(text)
    return folder


def test_csv_with_another_column_order_raises(spark, scratch):
    at = local_path(scratch("csv"))
    _file(at, "a.csv", "order_id,email,order_date,quantity,price\n1,a@x.com,2024-01-01,1,2.0\n")
    assert line_items_from_csv(spark, at).count() == 1
    _file(at, "b.csv", "order_id,email,order_date,price,quantity\n2,a@x.com,2024-01-01,7.5,4\n")
    with pytest.raises(Exception, match="(?i)header|schema"):
        line_items_from_csv(spark, at).collect()


def test_csv_line_break_in_a_cell(spark, scratch):
    text = 'order_id,email,order_date,quantity,price,note\n1,a@x.com,2024-01-01,1,2.0,"line1\nline2"\n'
    at = _file(local_path(scratch("csv")), "a.csv", text)
    assert [r.order_id for r in line_items_from_csv(spark, at, multi_line=True).collect()] == ["1"]
    with pytest.raises(Exception):
        line_items_from_csv(spark, at).collect()


def test_csv_short_record_raises(spark, scratch):
    at = _file(local_path(scratch("csv")), "a.csv", "order_id,email,order_date,quantity,price\n1,a@x.com,2024-01-01\n")
    with pytest.raises(Exception):
        line_items_from_csv(spark, at).select("order_id").collect()


def test_nan_is_missing_and_infinity_raises(spark):
    lines = [("1", "a@x.com", "2024-01-01", "NaN", "2.0"), ("2", "a@x.com", "2024-01-01", "1", "3.0")]
    row = daily_stats(text_lines(spark, lines)).first()
    assert (row.total_product_revenue, row.total_order_count) == (3.0, 2)
    only = daily_stats(text_lines(spark, lines[:1])).first()
    assert only.total_product_revenue == 0.0
    with pytest.raises(Exception, match="infinite"):
        daily_stats(text_lines(spark, [("1", "a@x.com", "2024-01-01", "Infinity", "2.0")])).collect()


def test_small_amounts_are_not_lost(spark):
    lines = [(str(i), "a@x.com", "2024-01-01", "1", "0.00004") for i in range(1000)]
    assert daily_stats(text_lines(spark, lines)).first().total_product_revenue == 0.04


@pytest.mark.parametrize("reader", ["folder", "table"])
def test_published_cells_of_older_writers(spark, scratch, reader):
    at = local_path(scratch("old"))
    _file(f"{at}/partition_date=2024-01-01", "a.csv", f"{HEADER}\n2024-01-01,9.0,2.0,1.0,inf,1.0,9.0,,\n")
    table = _table()
    create_daily_stats_table(spark, table, at)
    try:
        recover_partitions(spark, table)
        read = (lambda: read_daily_stats(spark, at)) if reader == "folder" else (lambda: spark.table(table))
        row = read().first()
        assert (row.total_order_count, row.daily_aov, row.repeat_customer_count) == (2, None, None)
        assert row.order_date == row.partition_date == dt.date(2024, 1, 1)
        _file(f"{at}/partition_date=2024-01-01", "b.csv", f"{HEADER}\n2024-01-01,9.0,2.0,1.0,1.0,1.0,junk,,\n")
        spark.catalog.refreshTable(f"{table}_files")
        with pytest.raises(Exception):
            read().collect()
    finally:
        drop_daily_stats_table(spark, table)


def test_backfill_follows_the_table(spark, scratch):
    a, b, table = scratch("a"), scratch("b"), _table()
    lines = text_lines(spark, GOLDEN_LINES)
    create_daily_stats_table(spark, table, a)
    try:
        with pytest.raises(ValueError, match="is at"):
            run_backfill(spark, lines, b, table)
        run_backfill(spark, lines, a + "/", table)
        assert spark.table(table).count() == len(GOLDEN_EXPECTED)
        run_backfill(spark, lines, table=table)
        assert read_daily_stats(spark, a).count() == len(GOLDEN_EXPECTED)
    finally:
        drop_daily_stats_table(spark, table)
    with pytest.raises(ValueError, match="location"):
        run_backfill(spark, lines)


def test_daily_job_refuses_a_stale_or_empty_dimension(spark, scratch):
    at, out, table = scratch("dim"), scratch("out"), _table()
    lines = text_lines(spark, GOLDEN_LINES)
    create_daily_stats_table(spark, table, out)
    try:
        os.makedirs(local_path(at))
        with pytest.raises(ValueError, match="no complete"):
            run_daily(spark, lines, table, "2024-01-04", dimension_location=at)
        refresh_dimension(lines.where("order_date <= '2024-01-02'"), at)
        assert covered_through(spark, at) == dt.date(2024, 1, 2)
        with pytest.raises(ValueError, match="too few"):
            run_daily(spark, lines, table, "2024-01-04", dimension_location=at)
        new = scratch("dim2")
        merge_dimension(spark, lines.where("order_date > '2024-01-02'"), at, new, through=dt.date(2024, 1, 3))
        run_daily(spark, lines, table, "2024-01-04", dimension_location=new)
        assert spark.table(table).count() == 1
    finally:
        drop_daily_stats_table(spark, table)


def test_yesterday_in_an_offset_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "+14:00")
        east = yesterday(spark)
        spark.conf.set("spark.sql.session.timeZone", "-12:00")
        assert east - yesterday(spark) in (dt.timedelta(days=1), dt.timedelta(days=2))
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_local_mode_is_one_process():
    assert is_local("local") and is_local("local[4]")
    assert not is_local("local-cluster[2,1,1024]") and not is_local("yarn") and not is_local("spark://host:7077")


def test_remove_location(spark, scratch):
    at = scratch("gone")
    spark.range(3).write.parquet(at)
    remove_location(spark, at)
    assert not os.path.exists(local_path(at))


def test_partition_column_prunes(spark, scratch):
    at = scratch("lines")
    lines = text_lines(spark, GOLDEN_LINES).where("order_date is not null")
    lines.withColumn("day", F.to_date("order_date")).write.partitionBy("day").parquet(at)
    read = line_items_from_table(spark, at, partition_column="day")
    assert dict(read.dtypes)["order_date"] == "date"
    plan = daily_stats_for_day(read, "2024-01-02")._jdf.queryExecution().executedPlan().toString()
    filters = " ".join(re.findall(r"PartitionFilters: \[([^\]]*)\]", plan))
    assert "day" in filters and "2024-01-02" in filters
    expected = [r for r in GOLDEN_EXPECTED if r[0] == dt.date(2024, 1, 2)]
    assert [tuple(r) for r in daily_stats_for_day(read, "2024-01-02").collect()] == expected


def _final_plan(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def _shuffled_records(df, column: str) -> list[int]:
    """Rows written by the exchanges whose output has ``column`` alone."""
    df.collect()
    found = []

    def walk(node):
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            walk(node.executedPlan())
            return
        if name.endswith("QueryStage"):
            walk(node.plan())
            return
        if name == "Exchange" and [a.name() for a in _items(node.output())] == [column]:
            found.append(node.metrics().apply("shuffleRecordsWritten").value())
        for child in _items(node.children()):
            walk(child)

    def _items(seq):
        return [seq.apply(i) for i in range(seq.size())]

    walk(df._jdf.queryExecution().executedPlan())
    return found


def test_single_day_without_broadcast_sends_a_hot_customer_once_a_task(spark):
    hot, others, tasks = 20_000, 300, 6
    rows = [(str(i), "hot@x.com", "2024-01-01", "1", "1.0") for i in range(hot)]
    rows += [(f"o{i}", f"u{i % others}@x.com", "2024-01-01", "1", "1.0") for i in range(2 * hot)]
    rows += [("t1", "hot@x.com", "2024-01-02", "1", "1.0"), ("t2", "new@x.com", "2024-01-02", "1", "1.0")]
    lines = text_lines(spark, rows).repartition(tasks).checkpoint()
    today = customer_days(lines.where("order_date = '2024-01-02'")).checkpoint()
    df = flag_against_seen(today, lines.where("order_date < '2024-01-02'"), broadcast_limit_bytes=0)
    assert sorted((r.email, r.first_order_fl) for r in df.collect()) == [("hot@x.com", 0), ("new@x.com", 1)]
    plan = _final_plan(df)
    assert "bloom" not in plan.lower() and "LeftSemi" not in plan
    sent = _shuffled_records(df, "email")
    assert sent and max(sent) <= (others + 1) * tasks


def test_limit_of_zero_means_never(spark, monkeypatch):
    import daybook.plans.cli as cli

    seen = {}
    monkeypatch.setattr(cli, "run_daily", lambda *a, **k: seen.update(k))
    monkeypatch.setattr(cli, "line_items_from_table", lambda *a: None)
    cli.main(["daily", "--source", "s", "--table", "t", "--broadcast-limit-mb", "0"])
    assert seen["broadcast_limit_bytes"] == 0
    cli.main(["daily", "--source", "s", "--table", "t"])
    assert seen["broadcast_limit_bytes"] is None


def test_shared_line_source_is_read_once(spark):
    from conftest import SF001

    lines = line_items_from_tpch(spark, SF001)
    shared = enrich_line_items(lines, share_source=True)
    plain = enrich_line_items(lines)
    assert "FileScan" not in _final_plan(shared)  # from the checkpoint
    assert sorted(map(str, shared.collect())) == sorted(map(str, plain.collect()))


def test_guests_do_not_meet_the_join(spark):
    lines = text_lines(spark, GOLDEN_LINES)
    df = with_first_order(lines)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    joined = plan[plan.index("Join LeftOuter"):]
    assert "isnotnull(email" in joined
    assert df.count() == len(GOLDEN_LINES)
