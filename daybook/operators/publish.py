"""Publication by version: write, audit, then switch partitions in the catalog.

The days are written to a folder of their own below the table's location
(``_versions/<version>/partition_date=...``; folders with a leading underscore
are not data to Spark). The written files are read back and audited against
the invariants of the statistics and the days that the job says it wrote. Only
then do partitions move: a day that is new to the table is added with its
location, a day whose row has changed is pointed at the new folder, and a day
whose row is the same stays where it is. Each of these is one catalog entry, so
a reader of the table sees a day's old row or its new one, never none and never
half a file; a failed audit leaves catalog and published files untouched, and a
run that dies while switching is completed by running it again.

``remove_old_versions`` deletes folders that no partition points into; run it
when readers of older versions are done.

Statements name many partitions at once; nothing lists the table's folder.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.operators.run_profile import RunProfile
from daybook.operators.sink import partition_locations, plain_path, point_days, read_daily_stats, table_location, write_daily_stats
from daybook.schema import DAILY_STATS_COLUMNS, ORDER_DATE, PARTITION_DATE
from daybook.session import remove_location

VERSIONS = "_versions"
VIOLATION_SCHEMA = "check string, order_date date, found string"


class AuditFailed(ValueError):
    """The staged days break an invariant; nothing was published."""


def audit(staged: DataFrame, expected_days: DataFrame, customers: int | None = None) -> DataFrame:
    """Violations (check, order_date, found) of staged days; no rows where all is well.

    ``expected_days`` holds the days to be found, ``customers`` the number of
    known customers with a dated line where it is known: over the whole history
    every one of them is new once.
    """
    nothing = F.lit(0)
    customer_sum = F.coalesce("new_customer_count", nothing) + F.coalesce("repeat_customer_count", nothing)
    spend_sum = F.coalesce("new_customer_spend", F.lit(0.0)) + F.coalesce("repeat_customer_spend", F.lit(0.0))
    revenue, orders = F.col("total_product_revenue"), F.col("total_order_count")
    slack = F.greatest(F.abs(revenue), F.lit(1.0)) * 1e-9
    counts = [F.col(c) for c in ("total_order_count", "total_customer_count", "new_customer_count", "repeat_customer_count")]
    checks: dict[str, tuple[Column, Column]] = {
        "customers_add_up": (customer_sum == F.col("total_customer_count"), customer_sum),
        "spend_adds_up": (F.abs(spend_sum - revenue) <= slack, spend_sum),
        "day_is_partition": (F.col(ORDER_DATE) == F.col(PARTITION_DATE), F.col(PARTITION_DATE)),
        "counts_not_negative": (F.least(*counts) >= 0, F.least(*counts)),
        "average_is_ratio": (
            F.when(orders == 0, F.col("daily_aov").isNull()).otherwise(F.abs(F.col("daily_aov") * orders - revenue) <= slack),
            F.col("daily_aov"),
        ),
    }
    broken = F.filter(
        F.array(
            *(
                # A null where a value belongs breaks the check too.
                F.when(~F.coalesce(holds, F.lit(False)), F.struct(F.lit(name).alias("check"), found.cast("string").alias("found")))
                for name, (holds, found) in checks.items()
            )
        ),
        lambda x: x.isNotNull(),
    )
    out = staged.select(F.coalesce(ORDER_DATE, PARTITION_DATE).alias(ORDER_DATE), F.explode(broken).alias("_x"))
    out = out.select("_x.check", ORDER_DATE, "_x.found")
    counted = staged.groupBy(F.col(PARTITION_DATE).alias(ORDER_DATE)).agg(F.count("*").alias("n"))
    expected = expected_days.select(F.col(expected_days.columns[0]).alias(ORDER_DATE)).distinct().withColumn("_wanted", F.lit(1))
    rows = expected.join(counted, ORDER_DATE, "full").select(
        ORDER_DATE, F.coalesce("n", nothing).alias("n"), F.coalesce("_wanted", nothing).alias("_wanted")
    )
    wrong = rows.where(F.col("n") != F.col("_wanted"))
    out = out.unionByName(wrong.select(F.lit("one_row_a_day").alias("check"), ORDER_DATE, F.col("n").cast("string").alias("found")))
    if customers is not None:
        total = staged.agg(F.coalesce(F.sum("new_customer_count"), nothing).alias("n")).where(F.col("n") != customers)
        out = out.unionByName(
            total.select(F.lit("each_customer_is_new_once").alias("check"), F.lit(None).cast("date").alias(ORDER_DATE), F.col("n").cast("string").alias("found"))
        )
    return out


def stage(spark: SparkSession, table: str, stats: DataFrame, profile: RunProfile, writers: int | None = None) -> str:
    """Writes the days of ``stats`` to a new version's folder, whose location it returns."""
    version = f"{table_location(spark, table).rstrip('/')}/{VERSIONS}/{uuid.uuid4().hex}"
    write_daily_stats(stats, version, "csv", writers, profile)
    return version


def switch(spark: SparkSession, table: str, version: str, profile: RunProfile, customers: int | None = None) -> list[dt.date]:
    """Audits a staged version and moves the partitions of days that are new or have changed.

    Returns these days. Raises ``AuditFailed`` and removes the version's
    folder if the audit finds anything.
    """
    written = profile.written_days()
    if not written:
        return []
    staged = read_daily_stats(spark, version)
    expected = spark.createDataFrame([(d,) for d in written], f"{ORDER_DATE} date")
    found = audit(staged, expected, customers).orderBy("check", ORDER_DATE).limit(20).collect()
    if found:
        remove_location(spark, version)
        raise AuditFailed("; ".join(f"{r.check} {r.order_date}: {r.found}" for r in found))
    published = spark.table(table).where(F.col(PARTITION_DATE).isin(written))
    columns = [*DAILY_STATS_COLUMNS, PARTITION_DATE]
    changed = staged.select(*columns).exceptAll(published.select(*columns)).select(PARTITION_DATE)
    days = sorted(r[0] for r in changed.distinct().collect())  # calendar days
    if not days:
        remove_location(spark, version)
        return []
    return point_days(spark, table, version, days)


def publish(
    spark: SparkSession, table: str, stats: DataFrame, profile: RunProfile, customers: int | None = None, writers: int | None = None
) -> list[dt.date]:
    """Stages, audits and switches; returns the days that were published anew."""
    return switch(spark, table, stage(spark, table, stats, profile, writers), profile, customers)


def remove_old_versions(spark: SparkSession, table: str) -> list[str]:
    """Deletes the versions that no partition points into; returns their names."""
    root = f"{table_location(spark, table).rstrip('/')}/{VERSIONS}"
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(path):
        return []
    used = {plain_path(at).split(f"/{VERSIONS}/")[1].split("/")[0] for at in partition_locations(spark, table).values() if f"/{VERSIONS}/" in at}
    old = sorted({s.getPath().getName() for s in files.listStatus(path)} - used)
    for name in old:
        remove_location(spark, f"{root}/{name}")
    return old
