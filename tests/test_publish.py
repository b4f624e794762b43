"""Run profile, publication by version, repair of affected days, catch-up."""

from __future__ import annotations

import datetime as dt
import os
import random
import uuid

import pytest
from pyspark.sql import functions as F

from daybook.operators import daily_stats, publish
from daybook.operators.affected import affected_days
from daybook.operators.run_profile import RunProfile
from daybook.operators.sink import create_daily_stats_table, drop_daily_stats_table, overwrite_day, partition_locations, registered_partitions, table_location
from daybook.plans import refresh_dimension, run_backfill, run_catch_up, run_daily, run_repair
from daybook.schema import DAILY_STATS_COLUMNS, DAILY_STATS_SCHEMA
from fixtures import GOLDEN_EXPECTED, GOLDEN_LINES, local_path, text_lines

D = dt.date


@pytest.fixture()
def table(spark, scratch):
    name = f"t_{uuid.uuid4().hex[:10]}"
    create_daily_stats_table(spark, name, scratch("publish"))
    yield name
    drop_daily_stats_table(spark, name)


def rows_of(df):
    return sorted((tuple(r) for r in df.select(*DAILY_STATS_COLUMNS).collect()), key=lambda r: r[0])


def files_of(spark, table):
    seen = spark.table(f"{table}_files").select("partition_date", F.input_file_name().alias("f")).collect()
    return {r.partition_date: r.f for r in seen}


def random_lines(rng, n):
    day = lambda: D(2024, 1, 1) + dt.timedelta(days=rng.randint(0, 40))
    return [
        (i % 97, rng.choice([None, "", "hot@x"] + [f"c{k}@x" for k in range(25)]), rng.choice([day(), day(), day(), None]), float(rng.randint(1, 5)), 2.5)
        for i in range(n)
    ]


SCHEMA = "order_id long, email string, order_date date, quantity double, price double"


@pytest.mark.parametrize("share", [False, True])
def test_profile_of_a_backfill(spark, scratch, share):
    lines = text_lines(spark, GOLDEN_LINES)
    profile = run_backfill(spark, lines, scratch("p"), share_source=share)
    got = profile.figures()
    assert got["lines"] == {
        "row_count": 13, "null_order_date": 1, "non_null_order_id": 12, "non_null_email": 11, "non_null_order_date": 12,
        "non_null_quantity": 12, "non_null_price": 13, "min_order_date": D(2024, 1, 1), "max_order_date": D(2024, 1, 8),
    }
    assert got["days"]["row_count"] == 8 and [tuple(r) for r in got["days"]["first_rows"]] == GOLDEN_EXPECTED[:3]
    assert profile.written_days() == [r[0] for r in GOLDEN_EXPECTED]
    assert {r.item: r.value for r in profile.frame(spark).collect() if r.scope == "lines"}["min_order_date"] == "2024-01-01"
    assert set(profile.types) == {"order_id", "email", "order_date", "quantity", "price"}


def test_profile_of_no_lines(spark, scratch, table):
    lines = spark.createDataFrame([], SCHEMA)
    got = run_backfill(spark, lines, table=table).figures()
    assert got["lines"]["row_count"] == 0 and got["lines"]["min_order_date"] is None and got["days"]["row_count"] == 0
    profile = run_daily(spark, lines, table, "2024-01-02", profile_history=True)
    assert profile.day == D(2024, 1, 2) and {s: f["row_count"] for s, f in profile.figures().items()} == {"lines": 0, "history": 0, "days": 0}


def test_profile_of_a_daily_run(spark, table):
    lines = text_lines(spark, GOLDEN_LINES)
    got = run_daily(spark, lines, table, "2024-01-04", profile_history=True).figures()
    assert got["lines"]["row_count"] == 1 and got["history"] == {
        "row_count": 8, "null_order_date": 1, "min_order_date": D(2024, 1, 1), "max_order_date": D(2024, 1, 3)
    }
    assert got["days"]["row_count"] == 1
    assert "history" not in run_daily(spark, lines, table, "2024-01-04").figures()


def test_profile_adds_no_scan_and_no_shuffle(spark, scratch):
    at = scratch("lines")
    spark.createDataFrame(random_lines(random.Random(1), 500), SCHEMA).write.parquet(at)
    lines = spark.read.parquet(at)
    for share in (False, True):
        plans = []
        for profile in (None, RunProfile(lines)):
            stats = daily_stats(lines, share, profile)
            stats.collect()
            plans.append(stats._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0])
        for node in ("Scan parquet", "Exchange hashpartitioning", "ReusedExchange"):
            assert plans[0].count(node) == plans[1].count(node), (share, node)
        assert "CollectMetrics" in plans[1] and "CollectMetrics" not in plans[0]


def test_versions_switch_only_changed_days(spark, table):
    lines = text_lines(spark, GOLDEN_LINES)
    early = lines.where(F.col("order_date") <= "2024-01-03")
    assert run_backfill(spark, early, table=table, by_version=True).published == [D(2024, 1, d) for d in (1, 2, 3)]
    first = files_of(spark, table)
    assert rows_of(spark.table(table)) == GOLDEN_EXPECTED[:3]
    assert run_backfill(spark, lines, table=table, by_version=True).published == [D(2024, 1, d) for d in range(4, 9)]
    assert rows_of(spark.table(table)) == GOLDEN_EXPECTED
    second = files_of(spark, table)
    assert all(second[d] == f for d, f in first.items())
    assert run_backfill(spark, lines, table=table, by_version=True).published == []
    assert files_of(spark, table) == second and publish.remove_old_versions(spark, table) == []
    # A plain backfill publishes from the table's own folder again; then no version is in use.
    run_backfill(spark, lines, table=table)
    assert rows_of(spark.table(table)) == GOLDEN_EXPECTED
    assert not any("/_versions/" in f for f in files_of(spark, table).values())
    assert len(publish.remove_old_versions(spark, table)) == 2
    assert rows_of(spark.table(table)) == GOLDEN_EXPECTED


def test_daily_job_into_a_versioned_day(spark, table):
    lines = text_lines(spark, GOLDEN_LINES)
    run_backfill(spark, lines, table=table, by_version=True)
    overwrite_day(spark, table, spark.createDataFrame([], DAILY_STATS_SCHEMA), D(2024, 1, 4))
    assert len(rows_of(spark.table(table))) == 7
    run_daily(spark, lines, table, "2024-01-04")
    assert rows_of(spark.table(table)) == GOLDEN_EXPECTED


@pytest.mark.parametrize("damage", ["count", "spend", "double", "lost", "null", "customers"])
def test_a_failed_audit_changes_nothing(spark, table, damage):
    lines = text_lines(spark, GOLDEN_LINES)
    run_backfill(spark, lines.where(F.col("order_date") <= "2024-01-05"), table=table, by_version=True)
    before, rows, locations = files_of(spark, table), rows_of(spark.table(table)), partition_locations(spark, table)
    stats = daily_stats(lines)
    day = F.col("order_date") == "2024-01-04"
    customers = 5
    if damage == "count":
        stats = stats.withColumn("new_customer_count", F.when(day, 7).otherwise(F.col("new_customer_count")))
    elif damage == "spend":
        stats = stats.withColumn("repeat_customer_spend", F.when(day, 12.01).otherwise(F.col("repeat_customer_spend")))
    elif damage == "double":
        stats = stats.union(stats.where(day))
    elif damage == "null":
        stats = stats.withColumn("total_product_revenue", F.when(~day, F.col("total_product_revenue")))
    elif damage == "customers":
        customers = 6  # a, b, c, d, B and '' have dated lines; so says the fixture's sum of new customers
    profile = RunProfile(lines)
    version = publish.stage(spark, table, stats, profile)
    if damage == "lost":
        for name in os.listdir(local_path(f"{version}/partition_date=2024-01-04")):
            os.truncate(local_path(f"{version}/partition_date=2024-01-04/{name}"), 0)
    if damage == "customers":
        assert publish.switch(spark, table, version, profile, customers) != []
        with pytest.raises(publish.AuditFailed, match="each_customer_is_new_once"):
            publish.publish(spark, table, stats, RunProfile(lines), customers - 1)
        return
    with pytest.raises(publish.AuditFailed, match="2024-01-04"):
        publish.switch(spark, table, version, profile)
    assert files_of(spark, table) == before and rows_of(spark.table(table)) == rows
    assert partition_locations(spark, table) == locations
    assert not os.path.exists(local_path(version))


def test_a_backfill_registers_what_it_wrote(spark, table):
    lines = text_lines(spark, GOLDEN_LINES)
    root = local_path(table_location(spark, table))
    os.makedirs(f"{root}/partition_date=2030-01-01")
    assert run_backfill(spark, lines, table=table).published == [r[0] for r in GOLDEN_EXPECTED]
    assert sorted(r[0] for r in registered_partitions(spark, table).collect()) == [r[0] for r in GOLDEN_EXPECTED]
    assert run_backfill(spark, lines, table=table).published == []


def affected_by_hand(old, late):
    first = {}
    for _, email, day, *_ in old:
        if email is not None and day is not None:
            first[email] = min(day, first.get(email, day))
    days = {day for _, _, day, *_ in late if day is not None}
    for _, email, day, *_ in late:
        if email in first and day is not None and day < first[email]:
            days.add(first[email])
    return days


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_repair_equals_a_full_backfill(spark, scratch, table, seed):
    rng = random.Random(seed)
    lines = random_lines(rng, 200)
    late = random_lines(rng, 6) + [(500, f"c{seed}@x", D(2024, 1, 1), 1.0, 1.0), (501, "new@x", D(2023, 12, 1), 1.0, 1.0), (502, "gone@x", None, 1.0, 1.0)]
    old, new = spark.createDataFrame(lines, SCHEMA), spark.createDataFrame(late, SCHEMA)
    everything = old.unionByName(new)
    run_backfill(spark, old, table=table)
    v1, v2 = scratch("v1"), scratch("v2")
    refresh_dimension(old, v1)
    expected = affected_by_hand(lines, late)
    assert {r[0] for r in affected_days(new, spark.read.parquet(v1)).collect()} == expected
    before = files_of(spark, table)
    assert set(run_repair(spark, everything, new, table, v1, v2).published) == expected
    assert rows_of(spark.table(table)) == rows_of(daily_stats(everything))
    after = files_of(spark, table)
    assert {d for d in after if after[d] != before.get(d)} == expected
    assert run_repair(spark, everything, new, table, v1, v2).published == []  # a rerun finds nothing to do
    assert run_repair(spark, everything, new.limit(0), table, v2, scratch("v3")).published == []


def test_repair_of_undated_lines_publishes_nothing(spark, scratch, table):
    lines = text_lines(spark, GOLDEN_LINES)
    run_backfill(spark, lines, table=table)
    v1 = scratch("v1")
    refresh_dimension(lines, v1)
    assert run_repair(spark, lines, lines.where("order_date is null"), table, v1, scratch("v2")).published == []


def test_catch_up_equals_the_backfill(spark, scratch, table):
    lines = spark.createDataFrame(random_lines(random.Random(9), 300), SCHEMA)
    days = [D(2024, 1, 3), D(2024, 1, 30), D(2024, 1, 4), D(2025, 1, 1)]
    expected = [r for r in rows_of(daily_stats(lines)) if r[0] in days]
    run_catch_up(spark, lines, table, days)
    assert rows_of(spark.table(table)) == expected
    assert sorted(r[0] for r in registered_partitions(spark, table).collect()) == sorted(days)
    dim = scratch("dim")
    refresh_dimension(lines, dim, D(2025, 1, 1))
    assert run_catch_up(spark, lines, table, days, dim).published == []
    fewer = lines.where(F.col("order_date") != D(2024, 1, 4))
    run_catch_up(spark, fewer, table, days, dim)
    assert [r[0] for r in rows_of(spark.table(table))] == [r[0] for r in expected if r[0] != D(2024, 1, 4)]
    refresh_dimension(lines, dim, D(2024, 2, 1))
    with pytest.raises(ValueError, match="too few"):
        run_catch_up(spark, lines, table, days, dim)
    with pytest.raises(ValueError):
        run_catch_up(spark, lines, table, [])


def test_versions_need_a_csv_table(spark, scratch):
    with pytest.raises(ValueError, match="by version"):
        run_backfill(spark, text_lines(spark, GOLDEN_LINES), scratch("x"), by_version=True)


def test_catch_up_scans_the_history_once(spark, scratch):
    from daybook.operators.affected import daily_stats_for_days_from_history

    at = scratch("lines")
    spark.createDataFrame(random_lines(random.Random(1), 500), SCHEMA).write.parquet(at)
    stats = daily_stats_for_days_from_history(spark.read.parquet(at), [D(2024, 1, 3), D(2024, 1, 9), D(2024, 1, 20)])
    plan = stats._jdf.queryExecution().executedPlan().toString()
    assert plan.count("LessThanOrEqual(order_date,2024-01-20)") == 1  # the history
    assert plan.count("In(order_date, [2024-01-03,2024-01-09,2024-01-20])") == 2  # the days' lines and orders
    assert plan.count("FileScan parquet") == 3 and "Cartesian" not in plan and "Expand" not in plan


def test_command_line_prints_the_profile(spark, scratch, table, capsys):
    from daybook.plans.cli import main

    at, late, v1 = scratch("lines"), scratch("late"), scratch("v1")
    lines = text_lines(spark, GOLDEN_LINES)
    lines.write.parquet(at)
    lines.where("order_date = '2024-01-04'").write.parquet(late)
    main(["backfill", "--source", at, "--table", table, "--by-version"])
    assert "lines row_count: 13" in capsys.readouterr().out
    main(["dimension", "--source", at, "--location", v1])
    main(["repair", "--source", at, "--late", late, "--table", table, "--old", v1, "--location", scratch("v2")])
    assert "partitions added or moved: 0" in capsys.readouterr().out
    main(["catch-up", "--source", at, "--table", table, "--dates", "2024-01-01", "2024-01-04"])
    out = capsys.readouterr().out
    assert "days row_count: 2" in out and "email: string" in out
    assert rows_of(spark.table(table)) == GOLDEN_EXPECTED
