"""

``queries()`` maps a name to ``(spark, sf_dir) -> DataFrame``; every query
reads the given parquet tables (through the line-item adapter) in full.
``oracle_sql()`` gives the same result as DuckDB SQL over the pre-registered
views. Column names and types are aligned on both sides.

Sink queries write below the session's ``spark.checkpoint.dir`` (a shared
folder on a cluster) and use a fresh folder and table name per call. Their
results are checkpointed, and table and folder are gone when they return.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.functions import product_revenue, week_label
from daybook.operators import (
    daily_stats,
    daily_stats_for_day,
    daily_totals,
    enrich_line_items,
    first_order_by_customer,
    new_customer_daily,
    repeat_customer_daily,
    with_first_order,
)
from daybook.operators import affected, bucketed_dimension, dimension, publish, quality
from daybook.operators.run_profile import RunProfile
from daybook.operators.sink import (
    drop_daily_stats_table,
    overwrite_day,
    read_daily_stats,
    recover_partitions,
    registered_partitions,
    stored_table,
    with_partition_column,
)
from daybook.plans import (
    create_table,
    merge_into_bucketed_dimension,
    refresh_bucketed_dimension,
    refresh_dimension,
    run_backfill,
    run_catch_up,
    run_daily,
    run_repair,
    run_repair_in_buckets,
)
from daybook.schema import (
    COUNT_COLUMNS,
    DAILY_STATS_COLUMNS,
    DAILY_STATS_SCHEMA,
    ORDER_DATE,
    ORDER_ID,
    PARTITION_DATE,
    PRICE,
    PRODUCT_REV,
    QUANTITY,
)
from daybook.session import checkpoint_dir, remove_location, scratch_location
from daybook.sources import line_items_from_csv, line_items_from_csv_by_header, line_items_from_table, line_items_from_tpch

try:  # the training-data operators are optional
    import corpus_pipeline
    from daybook.llm import queries as llm_queries
except ModuleNotFoundError as missing:
    if missing.name not in ("corpus_pipeline", "daybook.llm", "daybook.llm.queries"):
        raise
    corpus_pipeline = llm_queries = None

FLAGSHIP_SF_DIR = "/root/testdata/sf0.001"

# Fixed value: a day with both new and repeat customers at sf0.01.
SAMPLE_DAY = dt.date(1995, 11, 30)
# Days that the daily job publishes one by one, the last two at either end of the adapter's dates.
PUBLISHED_DAYS = (SAMPLE_DAY, dt.date(1996, 2, 29), dt.date(1995, 1, 1), dt.date(2001, 8, 1))
# Fixed value: every so manieth order has quantities that are not a number.
NAN_EVERY = 97
# Fixed value: where the history is cut to exercise the dimension merge.
MERGE_CUT_DAY = dt.date(1998, 1, 1)
# Fixed value: buckets of the dimension at test size.
DIMENSION_BUCKETS = 16
# Fixed value: the lines of every so manieth order arrive late.
LATE_EVERY = 53
# Days of the month on which a copy of the statistics is damaged, and a day that has none.
MISCOUNTED, DOUBLED, MISSING_DAY = 13, 17, dt.date(1990, 1, 1)


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: full-history daily statistics on sf0.001."""
    return q_daily_stats_backfill(spark, FLAGSHIP_SF_DIR)


# ---------------------------------------------------------------------------
# Spark queries


def _li(spark: SparkSession, sf_dir: str, dirty: bool = False) -> DataFrame:
    return line_items_from_tpch(spark, sf_dir, dirty=dirty)


# The adapter's line items are a three-table join, so statistics over them
# read the source once and share it between branches (see ``daily_stats``).
SHARED = True


def q_line_items(spark, sf_dir):
    return _li(spark, sf_dir)


def q_product_revenue(spark, sf_dir):
    li = _li(spark, sf_dir)
    return li.select(*li.columns, product_revenue(QUANTITY, PRICE).cast("double").alias(PRODUCT_REV))


def q_week_label(spark, sf_dir):
    days = quality.distinct_days(_li(spark, sf_dir))
    return days.select(ORDER_DATE, week_label(ORDER_DATE).alias("week"))


def q_first_order_by_customer(spark, sf_dir):
    return first_order_by_customer(_li(spark, sf_dir))


def q_customer_first_order_join(spark, sf_dir):
    return with_first_order(_li(spark, sf_dir))


def q_line_item_enriched(spark, sf_dir):
    out = enrich_line_items(_li(spark, sf_dir))
    return out.withColumn(PRODUCT_REV, F.col(PRODUCT_REV).cast("double"))


def q_daily_totals(spark, sf_dir):
    return daily_totals(_li(spark, sf_dir), share_source=SHARED)


def q_new_customer_daily(spark, sf_dir):
    return new_customer_daily(_li(spark, sf_dir))


def q_repeat_customer_daily(spark, sf_dir):
    return repeat_customer_daily(_li(spark, sf_dir))


def q_daily_stats_backfill(spark, sf_dir):
    return daily_stats(_li(spark, sf_dir), share_source=SHARED)


def q_daily_stats_for_day(spark, sf_dir):
    return daily_stats_for_day(_li(spark, sf_dir), SAMPLE_DAY)


def q_daily_stats_for_day_shuffle(spark, sf_dir):
    """As ``daily_stats_for_day``, with the day's customers never broadcast."""
    return daily_stats_for_day(_li(spark, sf_dir), SAMPLE_DAY, broadcast_limit_bytes=0)


def q_daily_stats_dirty_numbers(spark, sf_dir):
    """Quantities that are not a number count as missing."""
    li = _li(spark, sf_dir)
    broken = F.when(F.col(ORDER_ID) % NAN_EVERY == 0, F.lit(float("nan"))).otherwise(F.col(QUANTITY))
    return daily_stats(li.withColumn(QUANTITY, broken), share_source=SHARED)


def q_distinct_order_days(spark, sf_dir):
    return quality.distinct_days(_li(spark, sf_dir))


def q_dq_null_counts(spark, sf_dir):
    return quality.null_counts(_li(spark, sf_dir, dirty=True))


def q_dq_date_bounds(spark, sf_dir):
    return quality.date_bounds(_li(spark, sf_dir, dirty=True))


def q_dq_rows_per_day(spark, sf_dir):
    """Rows of each day in the published files, after two backfills."""
    location = scratch_location(spark, "rows")
    for _ in range(2):
        run_backfill(spark, _li(spark, sf_dir), location, share_source=SHARED)
    return _kept(quality.rows_per_day(read_daily_stats(spark, location)), location)


def q_dq_column_profile(spark, sf_dir):
    return quality.column_profile(_li(spark, sf_dir, dirty=True))


def q_sample_head(spark, sf_dir):
    return quality.sample_head(_li(spark, sf_dir), 3)


def _table_name(label: str) -> str:
    return f"daybook_{label}_{uuid.uuid4().hex[:10]}"


def _kept(df: DataFrame, location: str, table: str | None = None) -> DataFrame:
    """The result, checkpointed; its table and folder are removed."""
    spark = df.sparkSession
    checkpoint_dir(spark)
    try:
        return df.checkpoint(eager=True)
    finally:
        if table:
            drop_daily_stats_table(spark, table)
        remove_location(spark, location)


def q_daily_stats_csv_roundtrip(spark, sf_dir):
    """Backfill written as partitioned CSV, read back from the folder."""
    location = scratch_location(spark, "roundtrip")
    run_backfill(spark, _li(spark, sf_dir), location, share_source=SHARED)
    return _kept(read_daily_stats(spark, location), location)


def q_partition_overwrite_idempotent(spark, sf_dir):
    """Backfill twice, empty one day, then the daily job twice for it: same table."""
    location, table = scratch_location(spark, "idempotent"), _table_name("idem")
    li = _li(spark, sf_dir)
    create_table(spark, table, location)
    run_backfill(spark, li, table=table, share_source=SHARED)
    run_backfill(spark, li, table=table, share_source=SHARED)
    overwrite_day(spark, table, spark.createDataFrame([], DAILY_STATS_SCHEMA), SAMPLE_DAY)
    run_daily(spark, li, table, SAMPLE_DAY)
    run_daily(spark, li, table, SAMPLE_DAY)
    return _kept(read_daily_stats(spark, location), location, table)


def q_daily_publish(spark, sf_dir):
    """What the daily job publishes, day by day, into an empty table."""
    location, table = scratch_location(spark, "daily"), _table_name("daily")
    create_table(spark, table, location)
    for day in PUBLISHED_DAYS:
        run_daily(spark, _li(spark, sf_dir), table, day)
    return _kept(spark.table(table), location, table)


def q_registered_partitions_daily(spark, sf_dir):
    """Days that the daily job registered, whether they have lines or not."""
    location, table = scratch_location(spark, "days"), _table_name("days")
    create_table(spark, table, location)
    for day in PUBLISHED_DAYS:
        run_daily(spark, _li(spark, sf_dir), table, day)
    return _kept(registered_partitions(spark, table), location, table)


def q_registered_partitions(spark, sf_dir):
    """Days registered in the catalog after a backfill into a new table."""
    location, table = scratch_location(spark, "partitions"), _table_name("parts")
    create_table(spark, table, location)
    run_backfill(spark, _li(spark, sf_dir), table=table, share_source=SHARED)
    return _kept(registered_partitions(spark, table), location, table)


def q_daily_stats_table_schema(spark, sf_dir):
    """Backfill read back through the table created from the DDL."""
    location, table = scratch_location(spark, "table"), _table_name("table")
    create_table(spark, table, location)
    run_backfill(spark, _li(spark, sf_dir), table=table, share_source=SHARED)
    return _kept(spark.table(table), location, table)


def q_daily_stats_legacy_table(spark, sf_dir):
    """Files of older writers (counts as ``3.0``, no orders as ``inf``) through the table."""
    location, table = scratch_location(spark, "legacy"), _table_name("legacy")
    stats = daily_stats(_li(spark, sf_dir), share_source=SHARED)
    old = {c: F.col(c).cast("double").cast("string") for c in COUNT_COLUMNS}
    old["daily_aov"] = F.when(F.col(ORDER_DATE) == F.lit(SAMPLE_DAY), F.lit("inf")).otherwise(F.col("daily_aov").cast("string"))
    text = stats.withColumns(old).select(*DAILY_STATS_COLUMNS, F.col(ORDER_DATE).alias(PARTITION_DATE))
    text.write.option("header", "true").partitionBy(PARTITION_DATE).csv(location)
    create_table(spark, table, location)
    recover_partitions(spark, table)
    return _kept(spark.table(table), location, table)


def q_first_order_dimension_merge(spark, sf_dir):
    """Dimension built from history before a cut day, persisted, then merged
    with the lines from that day on: equals the full-history first orders."""
    li = _li(spark, sf_dir)
    day = F.col(ORDER_DATE)
    location = scratch_location(spark, "dim")
    old = dimension.build_first_order_dimension(li.where(day < MERGE_CUT_DAY))
    dimension.write_dimension(old, location, MERGE_CUT_DAY - dt.timedelta(days=1))
    old = dimension.read_dimension(spark, location)
    return _kept(dimension.merge_first_order_dimension(old, li.where(day >= MERGE_CUT_DAY)), location)


def q_daily_stats_for_day_dimension(spark, sf_dir):
    """Single-day statistics from a persisted first-order dimension."""
    li = _li(spark, sf_dir)
    location = scratch_location(spark, "dim")
    dimension.write_dimension(dimension.build_first_order_dimension(li), location, SAMPLE_DAY)
    dim = dimension.read_dimension(spark, location)
    return _kept(dimension.daily_stats_for_day_from_dimension(li, dim, SAMPLE_DAY), location)


def q_bucketed_dimension_merge(spark, sf_dir):
    """A dimension in buckets of the history before a cut day, merged in place with the lines from that day on."""
    li, location, table = _li(spark, sf_dir), scratch_location(spark, "buckets"), _table_name("buckets")
    cut = F.col(ORDER_DATE) < MERGE_CUT_DAY
    refresh_bucketed_dimension(spark, li.where(cut), table, location, DIMENSION_BUCKETS)
    merge_into_bucketed_dimension(spark, li.where(~cut), table)
    return _kept(bucketed_dimension.read_bucketed_dimension(spark, table), location, table)


def q_daily_stats_for_day_bucketed(spark, sf_dir):
    """Single-day statistics joined to a dimension in buckets, which is not shuffled."""
    li, location, table = _li(spark, sf_dir), scratch_location(spark, "buckets"), _table_name("buckets")
    refresh_bucketed_dimension(spark, li, table, location, DIMENSION_BUCKETS)
    dim = bucketed_dimension.read_bucketed_dimension(spark, table)
    return _kept(dimension.daily_stats_for_day_from_dimension(li, dim, SAMPLE_DAY, broadcast_limit_bytes=0), location, table)


def q_daily_stats_from_csv_source(spark, sf_dir):
    """Backfill over line items delivered as CSV text (all cells text)."""
    location = scratch_location(spark, "csv-lines")
    _li(spark, sf_dir).write.option("header", "true").csv(location)
    # CSV text cannot prune columns: read it once.
    return _kept(daily_stats(line_items_from_csv(spark, location), share_source=True), location)


def q_line_items_from_mixed_csv(spark, sf_dir):
    """CSV files of two layouts in one folder, each read by its own header."""
    location, li = scratch_location(spark, "mixed-csv"), _li(spark, sf_dir)
    early = F.col(ORDER_DATE) < MERGE_CUT_DAY
    li.where(early).write.option("header", "true").csv(location)
    turned = li.where(~early).select(F.lit("x").alias("note"), *reversed(li.columns))
    turned.write.mode("append").option("header", "true").csv(location)
    return _kept(line_items_from_csv_by_header(spark, location).select(F.col(ORDER_ID).cast("bigint").alias(ORDER_ID), *li.columns[1:]), location)


def q_line_items_from_path(spark, sf_dir):
    """The production reader over a parquet folder whose order dates are text."""
    location = scratch_location(spark, "lines")
    _li(spark, sf_dir).withColumn(ORDER_DATE, F.col(ORDER_DATE).cast("string")).write.parquet(location)
    return _kept(line_items_from_table(spark, location), location)


def q_line_items_from_partitioned_table(spark, sf_dir):
    """The production reader over a catalog table whose partitions are the order days."""
    location, table = scratch_location(spark, "lines"), _table_name("lines")
    rows = _li(spark, sf_dir).withColumn("day", F.col(ORDER_DATE)).repartition("day")
    rows.write.partitionBy("day").option("path", location).saveAsTable(table)
    return _kept(line_items_from_table(spark, table, partition_column="day"), location, table)


def q_run_profile_backfill(spark, sf_dir):
    """What a backfill saw and wrote, counted along the way."""
    location = scratch_location(spark, "profile")
    profile = run_backfill(spark, _li(spark, sf_dir, dirty=True), location, share_source=SHARED)
    return _kept(profile.frame(spark), location)


def q_run_profile_daily(spark, sf_dir):
    """What a daily run saw of its day and of the history, and wrote."""
    location, table = scratch_location(spark, "profile"), _table_name("profile")
    create_table(spark, table, location)
    profile = run_daily(spark, _li(spark, sf_dir, dirty=True), table, SAMPLE_DAY, profile_history=True)
    return _kept(profile.frame(spark), location, table)


def q_publish_by_version(spark, sf_dir):
    """The table while a version is staged, after a damaged version was refused, and after the switch."""
    location, table = scratch_location(spark, "versions"), _table_name("versions")
    li = _li(spark, sf_dir)
    create_table(spark, table, location)
    run_backfill(spark, li.where(F.col(ORDER_DATE) < MERGE_CUT_DAY), table=table, share_source=SHARED, by_version=True)

    def seen(state: str) -> DataFrame:
        return spark.table(table).withColumn("state", F.lit(state)).checkpoint()

    checkpoint_dir(spark)
    profile = RunProfile(li)
    stats = daily_stats(li, SHARED, profile)
    version = publish.stage(spark, table, stats, profile)
    states = [seen("staged")]
    damaged = read_daily_stats(spark, version).drop("partition_date")
    damaged = damaged.withColumn("total_customer_count", F.col("total_customer_count") + F.lit(1))
    try:
        publish.publish(spark, table, damaged, RunProfile(li))
    except publish.AuditFailed:
        states.append(seen("refused"))
    publish.switch(spark, table, version, profile)
    states.append(seen("switched"))
    return _kept(states[0].union(states[1]).union(states[2]), location, table)


def q_publication_audit(spark, sf_dir):
    """What the audit finds in damaged statistics."""
    stats = with_partition_column(daily_stats(_li(spark, sf_dir), share_source=SHARED))
    month_day, more = F.dayofmonth(ORDER_DATE), F.col("total_customer_count") + 1
    damaged = stats.withColumn("total_customer_count", F.when(month_day == MISCOUNTED, more).otherwise(more - 1))
    damaged = damaged.withColumn("_again", F.explode(F.when(month_day == DOUBLED, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    expected = stats.select(ORDER_DATE).union(spark.range(1).select(F.lit(MISSING_DAY)))
    return publish.audit(damaged.drop("_again"), expected)


def _late(order: Column) -> Column:
    return order % LATE_EVERY == 0


def q_affected_days(spark, sf_dir):
    """Days that late lines change, from these lines and the first orders of before."""
    li, late = _li(spark, sf_dir), _late(F.col(ORDER_ID))
    return affected.affected_days(li.where(late), dimension.build_first_order_dimension(li.where(~late)))


def _repaired(spark, sf_dir, label):
    """A table published without the late lines, then repaired; its files before the repair."""
    location, table = scratch_location(spark, label), _table_name(label)
    li, late = _li(spark, sf_dir), _late(F.col(ORDER_ID))
    create_table(spark, table, location)
    run_backfill(spark, li.where(~late), table=table, share_source=SHARED)
    refresh_dimension(li.where(~late), f"{location}-v1")
    files = spark.table(stored_table(spark, table)).select("partition_date", F.input_file_name().alias("file"))
    checkpoint_dir(spark)
    before = files.checkpoint()
    run_repair(spark, li, li.where(late), table, f"{location}-v1", f"{location}-v2")
    for version in ("v1", "v2"):
        remove_location(spark, f"{location}-{version}")
    return location, table, before


def q_repair_late_lines(spark, sf_dir):
    """The table after the days that late lines change were published again: a full backfill's."""
    location, table, _ = _repaired(spark, sf_dir, "repair")
    return _kept(spark.table(table), location, table)


def q_repair_in_buckets(spark, sf_dir):
    """As ``repair_late_lines``, with a dimension in buckets that is merged in place."""
    location, table, dim = scratch_location(spark, "mend"), _table_name("mend"), _table_name("buckets")
    li, late = _li(spark, sf_dir), _late(F.col(ORDER_ID))
    create_table(spark, table, location)
    refresh_bucketed_dimension(spark, li.where(~late), dim, f"{location}-dim", DIMENSION_BUCKETS)
    run_backfill(spark, li.where(~late), table=table, share_source=SHARED, by_version=True)
    run_repair_in_buckets(spark, li, li.where(late), table, dim)
    drop_daily_stats_table(spark, dim)
    remove_location(spark, f"{location}-dim")
    return _kept(spark.table(table), location, table)


def q_repair_rewritten_days(spark, sf_dir):
    """Every day of the repaired table, and whether the repair has rewritten its file."""
    location, table, before = _repaired(spark, sf_dir, "rewritten")
    after = spark.table(stored_table(spark, table)).select("partition_date", F.input_file_name().alias("now"))
    both = after.join(before, "partition_date", "left")
    rewritten = F.coalesce(F.col("file") != F.col("now"), F.lit(True))
    return _kept(both.select(F.col("partition_date").alias(ORDER_DATE), rewritten.alias("rewritten")), location, table)


def q_catch_up_days(spark, sf_dir):
    """Days published together, from one pass over the history and from a dimension."""
    location, table = scratch_location(spark, "catch-up"), _table_name("catchup")
    li = _li(spark, sf_dir)
    create_table(spark, table, location)
    run_catch_up(spark, li, table, PUBLISHED_DAYS[:2])
    refresh_dimension(li, f"{location}-dim", max(PUBLISHED_DAYS))
    run_catch_up(spark, li, table, PUBLISHED_DAYS[2:], f"{location}-dim")
    remove_location(spark, f"{location}-dim")
    return _kept(spark.table(table), location, table)


_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "line_items": q_line_items,
    "product_revenue": q_product_revenue,
    "week_label": q_week_label,
    "first_order_by_customer": q_first_order_by_customer,
    "customer_first_order_join": q_customer_first_order_join,
    "line_item_enriched": q_line_item_enriched,
    "daily_totals": q_daily_totals,
    "new_customer_daily": q_new_customer_daily,
    "repeat_customer_daily": q_repeat_customer_daily,
    "daily_stats_backfill": q_daily_stats_backfill,
    "daily_stats_for_day": q_daily_stats_for_day,
    "daily_stats_for_day_shuffle": q_daily_stats_for_day_shuffle,
    "daily_stats_dirty_numbers": q_daily_stats_dirty_numbers,
    "distinct_order_days": q_distinct_order_days,
    "dq_null_counts": q_dq_null_counts,
    "dq_date_bounds": q_dq_date_bounds,
    "dq_rows_per_day": q_dq_rows_per_day,
    "dq_column_profile": q_dq_column_profile,
    "sample_head": q_sample_head,
    "daily_stats_csv_roundtrip": q_daily_stats_csv_roundtrip,
    "partition_overwrite_idempotent": q_partition_overwrite_idempotent,
    "registered_partitions": q_registered_partitions,
    "daily_stats_table_schema": q_daily_stats_table_schema,
    "first_order_dimension_merge": q_first_order_dimension_merge,
    "daily_stats_for_day_dimension": q_daily_stats_for_day_dimension,
    "bucketed_dimension_merge": q_bucketed_dimension_merge,
    "daily_stats_for_day_bucketed": q_daily_stats_for_day_bucketed,
    "daily_stats_from_csv_source": q_daily_stats_from_csv_source,
    "daily_publish": q_daily_publish,
    "registered_partitions_daily": q_registered_partitions_daily,
    "daily_stats_legacy_table": q_daily_stats_legacy_table,
    "line_items_from_path": q_line_items_from_path,
    "line_items_from_mixed_csv": q_line_items_from_mixed_csv,
    "line_items_from_partitioned_table": q_line_items_from_partitioned_table,
    "run_profile_backfill": q_run_profile_backfill,
    "run_profile_daily": q_run_profile_daily,
    "publish_by_version": q_publish_by_version,
    "publication_audit": q_publication_audit,
    "affected_days": q_affected_days,
    "repair_late_lines": q_repair_late_lines,
    "repair_in_buckets": q_repair_in_buckets,
    "repair_rewritten_days": q_repair_rewritten_days,
    "catch_up_days": q_catch_up_days,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = dict(_QUERIES)
    if llm_queries is not None:
        found |= llm_queries.QUERIES
        found["pipeline"] = corpus_pipeline.run
    return found


# ---------------------------------------------------------------------------
# DuckDB oracles


def _adapter_sql(dirty: bool = False) -> str:
    day = "CAST(o.o_orderdate AS DATE)"
    if dirty:
        day = f"CASE WHEN o.o_orderkey % 101 <> 0 THEN {day} END"
    return f"""
    SELECT o.o_orderkey AS order_id,
           CASE WHEN o.o_custkey % 10 <> 0
                THEN 'c' || CAST(o.o_custkey AS VARCHAR) || '@example.com' END AS email,
           {day} AS order_date,
           l.l_quantity AS quantity,
           p.p_retailprice AS price
    FROM lineitem l
    JOIN orders o ON l.l_orderkey = o.o_orderkey
    JOIN part p ON l.l_partkey = p.p_partkey"""


LI = f"li AS ({_adapter_sql()})"
LI_DIRTY = f"li AS ({_adapter_sql(dirty=True)})"
REV = "CAST(li.quantity * li.price AS DECIMAL(28,8))"
FIRST = "fo AS (SELECT email, MIN(order_date) AS first_order_date FROM li WHERE email IS NOT NULL GROUP BY email)"
FLAGGED = f"""e AS (
    SELECT li.order_id, li.email, li.order_date, {REV} AS rev,
           CASE WHEN li.order_date = fo.first_order_date THEN 1 ELSE 0 END AS fl
    FROM li LEFT JOIN fo ON li.email = fo.email
    WHERE li.order_date IS NOT NULL)"""


def _segment_sql(name: str, flag: int, prefix: str) -> str:
    return f"""{name} AS (
    SELECT order_date, COUNT(DISTINCT email) AS {prefix}_customer_count,
           CAST(COALESCE(SUM(rev), 0) AS DOUBLE) AS {prefix}_customer_spend
    FROM e WHERE fl = {flag} GROUP BY order_date)"""


TOTALS = """tot AS (
    SELECT order_date, COALESCE(SUM(rev), 0) AS rev,
           COUNT(DISTINCT order_id) AS total_order_count,
           COUNT(DISTINCT email) AS total_customer_count
    FROM e GROUP BY order_date)"""

def _backfill_body(lines: str) -> str:
    return f"""WITH {lines}, {FIRST}, {FLAGGED}, {TOTALS},
{_segment_sql('nw', 1, 'new')},
{_segment_sql('rp', 0, 'repeat')},
stats AS (
    SELECT tot.order_date,
           CAST(tot.rev AS DOUBLE) AS total_product_revenue,
           tot.total_order_count,
           tot.total_customer_count,
           CASE WHEN tot.total_order_count > 0
                THEN CAST(tot.rev AS DOUBLE) / tot.total_order_count END AS daily_aov,
           nw.new_customer_count, nw.new_customer_spend,
           rp.repeat_customer_count, rp.repeat_customer_spend
    FROM tot
    LEFT JOIN nw ON tot.order_date = nw.order_date
    LEFT JOIN rp ON tot.order_date = rp.order_date)"""


BACKFILL_BODY = _backfill_body(LI)
LI_NAN = f"li AS (SELECT * REPLACE (CASE WHEN order_id % {NAN_EVERY} <> 0 THEN quantity END AS quantity) FROM ({_adapter_sql()}))"

STATS_COLS = (
    "order_date, total_product_revenue, total_order_count, total_customer_count, daily_aov, "
    "new_customer_count, new_customer_spend, repeat_customer_count, repeat_customer_spend"
)


def _null_counts_sql() -> str:
    cols = ["order_id", "email", "order_date", "quantity", "price"]
    parts = ", ".join(f"COUNT(*) FILTER (WHERE {c} IS NULL) AS null_{c}" for c in cols)
    return f"WITH {LI_DIRTY} SELECT COUNT(*) AS row_count, {parts} FROM li"


# Spark type names of the adapter's line-item columns.
TYPES = [
    ("order_id", "bigint"),
    ("email", "string"),
    ("order_date", "date"),
    ("quantity", "double"),
    ("price", "double"),
]


def _column_profile_sql() -> str:
    union = " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, '{t}' AS data_type, COUNT({c}) AS non_null_count FROM li"
        for c, t in TYPES
    )
    return f"WITH {LI_DIRTY} {union}"


def _figures_sql(scope: str, where: str, columns: bool) -> str:
    """A run's figures of the lines that ``where`` names, as rows (scope, item, value)."""
    items = {"row_count": "COUNT(*)", "null_order_date": "COUNT(*) - COUNT(order_date)"}
    if columns:
        items |= {f"non_null_{c}": f"COUNT({c})" for c, _ in TYPES}
    items |= {"min_order_date": "MIN(order_date)", "max_order_date": "MAX(order_date)"}
    return " UNION ALL ".join(
        f"SELECT '{scope}' AS scope, '{k}' AS item, CAST({v} AS VARCHAR) AS value FROM li WHERE {where}" for k, v in items.items()
    )


def _run_profile_sql(lines: str, history: str | None, days: str) -> str:
    types = " UNION ALL ".join(f"SELECT 'lines' AS scope, 'type_{c}' AS item, '{t}' AS value" for c, t in TYPES)
    parts = [types, _figures_sql("lines", lines, True)]
    if history:
        parts.append(_figures_sql("history", history, False))
    published = {"row_count": "COUNT(DISTINCT order_date)", "min_order_date": "MIN(order_date)", "max_order_date": "MAX(order_date)"}
    parts += [f"SELECT 'days' AS scope, '{k}' AS item, CAST({v} AS VARCHAR) AS value FROM li WHERE {days}" for k, v in published.items()]
    return f"WITH {LI_DIRTY} {' UNION ALL '.join(parts)}"


# Days of late lines, and the first days of customers whom these give an earlier one.
AFFECTED = f"""late AS (SELECT * FROM li WHERE order_id % {LATE_EVERY} = 0),
    was AS (SELECT email, MIN(order_date) AS first_day FROM li WHERE order_id % {LATE_EVERY} <> 0 AND email IS NOT NULL GROUP BY email),
    affected AS (
        SELECT order_date FROM late WHERE order_date IS NOT NULL
        UNION
        SELECT first_day FROM was JOIN late USING (email) WHERE late.order_date < first_day)"""


def oracle_sql() -> dict[str, str]:
    own = _own_oracle_sql()
    return own | llm_queries.ORACLE_SQL if llm_queries is not None else own


def _own_oracle_sql() -> dict[str, str]:
    day = SAMPLE_DAY.isoformat()
    published = ", ".join(f"DATE '{d}'" for d in PUBLISHED_DAYS)
    with_partition = f"SELECT {STATS_COLS}, order_date AS partition_date FROM stats"
    return {
        "line_items": f"WITH {LI} SELECT * FROM li",
        "product_revenue": f"WITH {LI} SELECT li.*, CAST({REV} AS DOUBLE) AS product_rev FROM li",
        "week_label": f"""WITH {LI}
            SELECT DISTINCT order_date, strftime(order_date, '%Y-%W') AS week
            FROM li WHERE order_date IS NOT NULL""",
        "first_order_by_customer": f"WITH {LI}, {FIRST} SELECT * FROM fo",
        "customer_first_order_join": f"""WITH {LI}, {FIRST}
            SELECT li.*, fo.first_order_date FROM li LEFT JOIN fo ON li.email = fo.email""",
        "line_item_enriched": f"""WITH {LI}, {FIRST}
            SELECT li.*,
                   CAST({REV} AS DOUBLE) AS product_rev,
                   strftime(li.order_date, '%Y-%W') AS week,
                   fo.first_order_date,
                   CAST(datediff('day', fo.first_order_date, li.order_date) AS INTEGER) AS age,
                   CAST(fo.first_order_date + 60 AS DATE) AS cutoff_60_days,
                   strftime(fo.first_order_date, '%Y-%m') AS first_order_month,
                   CASE WHEN li.order_date = fo.first_order_date THEN 1 ELSE 0 END AS first_order_fl
            FROM li LEFT JOIN fo ON li.email = fo.email""",
        "daily_totals": f"""WITH {LI}, {FIRST}, {FLAGGED}, {TOTALS}
            SELECT order_date, CAST(rev AS DOUBLE) AS total_product_revenue,
                   total_order_count, total_customer_count,
                   CASE WHEN total_order_count > 0
                        THEN CAST(rev AS DOUBLE) / total_order_count END AS daily_aov
            FROM tot""",
        "new_customer_daily": f"WITH {LI}, {FIRST}, {FLAGGED}, {_segment_sql('nw', 1, 'new')} SELECT * FROM nw",
        "repeat_customer_daily": f"WITH {LI}, {FIRST}, {FLAGGED}, {_segment_sql('rp', 0, 'repeat')} SELECT * FROM rp",
        "daily_stats_backfill": f"{BACKFILL_BODY} SELECT {STATS_COLS} FROM stats",
        "daily_stats_for_day": f"{BACKFILL_BODY} SELECT {STATS_COLS} FROM stats WHERE order_date = DATE '{day}'",
        "distinct_order_days": f"WITH {LI} SELECT DISTINCT order_date FROM li WHERE order_date IS NOT NULL",
        "dq_null_counts": _null_counts_sql(),
        "dq_date_bounds": f"""WITH {LI_DIRTY}
            SELECT MIN(order_date) AS min_order_date, MAX(order_date) AS max_order_date FROM li""",
        "dq_rows_per_day": f"{BACKFILL_BODY} SELECT order_date, COUNT(*) AS row_count FROM stats GROUP BY order_date",
        "dq_column_profile": _column_profile_sql(),
        "sample_head": f"""WITH {LI} SELECT * FROM li
            ORDER BY order_id NULLS FIRST, email NULLS FIRST, order_date NULLS FIRST,
                     quantity NULLS FIRST, price NULLS FIRST
            LIMIT 3""",
        "daily_stats_csv_roundtrip": f"{BACKFILL_BODY} {with_partition}",
        "partition_overwrite_idempotent": f"{BACKFILL_BODY} {with_partition}",
        "registered_partitions": f"""WITH {LI}
            SELECT DISTINCT order_date AS partition_date FROM li WHERE order_date IS NOT NULL""",
        "daily_stats_table_schema": f"{BACKFILL_BODY} {with_partition}",
        "first_order_dimension_merge": f"WITH {LI}, {FIRST} SELECT * FROM fo",
        "bucketed_dimension_merge": f"WITH {LI}, {FIRST} SELECT * FROM fo",
        "daily_stats_for_day_bucketed": f"{BACKFILL_BODY} SELECT {STATS_COLS} FROM stats WHERE order_date = DATE '{day}'",
        "daily_stats_for_day_dimension": f"{BACKFILL_BODY} SELECT {STATS_COLS} FROM stats WHERE order_date = DATE '{day}'",
        "daily_stats_from_csv_source": f"{BACKFILL_BODY} SELECT {STATS_COLS} FROM stats",
        "daily_stats_for_day_shuffle": f"{BACKFILL_BODY} SELECT {STATS_COLS} FROM stats WHERE order_date = DATE '{day}'",
        "daily_stats_dirty_numbers": f"{_backfill_body(LI_NAN)} SELECT {STATS_COLS} FROM stats",
        "daily_publish": f"{BACKFILL_BODY} {with_partition} WHERE order_date IN ({published})",
        "registered_partitions_daily": f"SELECT unnest([{published}]) AS partition_date",
        "daily_stats_legacy_table": f"""{BACKFILL_BODY}
            SELECT * REPLACE (CASE WHEN order_date <> DATE '{day}' THEN daily_aov END AS daily_aov)
            FROM ({with_partition})""",
        "run_profile_backfill": _run_profile_sql("true", None, "order_date IS NOT NULL"),
        "run_profile_daily": _run_profile_sql(
            f"order_date = DATE '{day}'", f"order_date < DATE '{day}' OR order_date IS NULL", f"order_date = DATE '{day}'"
        ),
        "publish_by_version": f"""{BACKFILL_BODY}
            SELECT {STATS_COLS}, order_date AS partition_date, state
            FROM stats, (SELECT unnest(['staged', 'refused', 'switched']) AS state)
            WHERE state = 'switched' OR order_date < DATE '{MERGE_CUT_DAY}'""",
        "publication_audit": f"""{BACKFILL_BODY}
            SELECT 'customers_add_up' AS "check", order_date, CAST(total_customer_count AS VARCHAR) AS found
            FROM stats WHERE day(order_date) = {MISCOUNTED}
            UNION ALL SELECT 'one_row_a_day', order_date, '2' FROM stats WHERE day(order_date) = {DOUBLED}
            UNION ALL SELECT 'one_row_a_day', DATE '{MISSING_DAY}', '0'""",
        "affected_days": f"WITH {LI}, {AFFECTED} SELECT order_date FROM affected",
        "repair_late_lines": f"{BACKFILL_BODY} {with_partition}",
        "repair_in_buckets": f"{BACKFILL_BODY} {with_partition}",
        "repair_rewritten_days": f"""WITH {LI}, {AFFECTED}
            SELECT DISTINCT order_date, order_date IN (SELECT order_date FROM affected) AS rewritten
            FROM li WHERE order_date IS NOT NULL""",
        "catch_up_days": f"{BACKFILL_BODY} {with_partition} WHERE order_date IN ({published})",
        "line_items_from_path": f"WITH {LI} SELECT * FROM li",
        "line_items_from_mixed_csv": f"WITH {LI} SELECT * FROM li",
        "line_items_from_partitioned_table": f"WITH {LI} SELECT * FROM li",
    }


__all__ = ["entry", "oracle_sql", "queries"]
