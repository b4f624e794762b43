"""The published table: date-partitioned CSV with a header line.

Layout: ``<location>/partition_date=YYYY-MM-DD/part-*.csv``, the nine
statistics columns in file order, one header line, NULL written as an empty
field. ``partition_date`` always equals ``order_date``.

Writes are idempotent per day:

* the backfill is one job with dynamic partition overwrite, so only the days
  present in the result are replaced and every other day is left alone;
* the daily job uses a static ``INSERT OVERWRITE ... PARTITION``, which also
  clears the day when its result is empty (dynamic overwrite would leave
  stale rows there).

A CSV table is a pair: ``<name>_files``, the partitioned table over the
folder with every cell as text, and the view ``<name>`` that casts it, so that
files of older writers read the same through the catalog as through
``read_daily_stats`` and a damaged cell raises instead of turning into NULL.
Other formats keep the types and are one table.

Partitions are registered with ``ADD IF NOT EXISTS`` (reruns are no-ops): one,
or after a bulk write those of the written days that the catalog lacks
(``point_days``). ``recover_partitions`` adds what a folder listing finds.
"""

from __future__ import annotations

import datetime as dt
import re
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.operators.run_profile import RunProfile
from daybook.schema import (
    DAILY_STATS_COLUMNS,
    DAILY_STATS_TEXT_SCHEMA,
    ORDER_DATE,
    PARTITION_DATE,
    daily_stats_cast,
    daily_stats_ddl_columns,
)

#: Partitions that one statement names.
BATCH = 500
_IDENT = re.compile(r"^[A-Za-z_][A-Za-z0-9_]*(\.[A-Za-z_][A-Za-z0-9_]*)?$")


def check_ident(name: str) -> str:
    if not _IDENT.match(name):
        raise ValueError(f"not a plain table identifier: {name!r}")
    return name


def _day_literal(day: str | dt.date) -> str:
    if isinstance(day, dt.datetime):
        day = day.date()
    return (day if isinstance(day, dt.date) else dt.date.fromisoformat(str(day))).isoformat()


def quote(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def with_partition_column(stats: DataFrame) -> DataFrame:
    return stats.select(*DAILY_STATS_COLUMNS, F.col(ORDER_DATE).alias(PARTITION_DATE))


def write_daily_stats(
    stats: DataFrame,
    location: str,
    fmt: str = "csv",
    writers: int | None = None,
    profile: RunProfile | None = None,
) -> None:
    """Write every day of ``stats`` to its own partition (backfill sink).

    One job replaces exactly the days present in ``stats``. The statistics
    have one row per day, so the repartition on the day key is a shuffle of
    at most a few thousand rows; it puts each day in exactly one task, hence
    one file per day. The number of tasks is pinned to ``writers``, by default
    the cluster's task slots (give it where executors arrive only later): left
    to AQE, a result this small is coalesced into a single task, which would
    then create every day's folder and file one after another. A range (not
    hash) partitioning is used so the exchange is not dropped as redundant
    with the day-keyed aggregate below it, and each writer gets a contiguous
    run of days. ``profile`` counts the days behind that exchange, as the job
    that samples its ranges would be counted too.
    """
    slots = writers or max(stats.sparkSession.sparkContext.defaultParallelism, 1)
    days = with_partition_column(stats).repartitionByRange(slots, PARTITION_DATE)
    writer = (
        (profile.days(days) if profile else days)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(PARTITION_DATE)
        .format(fmt)
    )
    if fmt == "csv":
        writer = writer.option("header", "true")
    writer.save(location)


def read_daily_stats(spark: SparkSession, location: str) -> DataFrame:
    """Read the published CSV from its folder.

    Cells are cast strictly: counts written as ``3.0`` read as 3, an infinite
    amount as NULL, and anything else that is no number or date raises, as
    does a line with too few or too many cells. A header-only file reads as
    zero rows.
    """
    raw = (
        spark.read.schema(DAILY_STATS_TEXT_SCHEMA)
        .option("header", "true")
        .option("mode", "FAILFAST")
        .option("columnPruning", "false")
        .option("basePath", location)
        .csv(location)
    )
    return raw.select(*(F.expr(daily_stats_cast(c)).alias(c) for c in DAILY_STATS_COLUMNS), F.col(PARTITION_DATE))


def stored_table(spark: SparkSession, name: str) -> str:
    """The table that holds ``name``'s partitions: ``name_files`` behind a view, else ``name``."""
    files = f"{check_ident(name)}_files"
    return files if spark.catalog.tableExists(files) else name


def table_location(spark: SparkSession, name: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {stored_table(spark, name)}").where("col_name = 'Location'")
    return rows.first()["data_type"]


def create_daily_stats_table(
    spark: SparkSession, name: str, location: str, fmt: str = "csv"
) -> None:
    """Create the partitioned table over ``location`` if it does not exist.

    An existing table is never altered. The table sees the days whose
    partitions are registered (see ``register_partition`` /
    ``recover_partitions``). For CSV ``name`` is the view over ``name_files``.
    """
    if spark.catalog.tableExists(check_ident(name)):
        return
    is_text = fmt == "csv"
    files = f"{name}_files" if is_text else name
    options = " OPTIONS (header 'true', mode 'FAILFAST', columnPruning 'false')" if is_text else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {files} ({daily_stats_ddl_columns(is_text)}) "
        f"USING {fmt}{options} PARTITIONED BY ({PARTITION_DATE}) LOCATION {quote(location)}"
    )
    if is_text:
        typed = ", ".join(f"{daily_stats_cast(c)} AS {c}" for c in DAILY_STATS_COLUMNS)
        spark.sql(f"CREATE VIEW IF NOT EXISTS {name} AS SELECT {typed}, {PARTITION_DATE} FROM {files}")


def drop_daily_stats_table(spark: SparkSession, name: str) -> None:
    """Drop the table, and the view if there is one; published files stay."""
    files = f"{check_ident(name)}_files"
    if spark.catalog.tableExists(files):
        spark.sql(f"DROP VIEW IF EXISTS {name}")
        spark.sql(f"DROP TABLE IF EXISTS {files}")
    else:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def _day_folder(root: str, day: dt.date) -> str:
    return f"{root.rstrip('/')}/{PARTITION_DATE}={day.isoformat()}"


def catalog_partitions(spark: SparkSession, table: str, column: str) -> dict[str, str]:
    """Values of a table's partition column and the folders they point at: one catalog call."""
    state = spark._jsparkSession.sessionState()
    ident = state.sqlParser().parseTableIdentifier(table)
    listed = state.catalog().listPartitions(ident, spark._jvm.scala.Option.empty())
    parts = [listed.apply(i) for i in range(listed.size())]
    return {part.spec().apply(column): part.location().toString() for part in parts}


def partition_locations(spark: SparkSession, table: str) -> dict[dt.date, str]:
    """Registered days and the folders they point at, a row for each day."""
    found = catalog_partitions(spark, stored_table(spark, table), PARTITION_DATE)
    return {dt.date.fromisoformat(day[:10]): at for day, at in found.items()}


def point_days(spark: SparkSession, table: str, root: str, days: Iterable[dt.date]) -> list[dt.date]:
    """Lets each day's partition point into ``root``; returns the days that did not yet."""
    target, known = stored_table(spark, table), partition_locations(spark, table)
    wanted = {d: _day_folder(root, d) for d in days}
    new = sorted(d for d in wanted if d not in known)
    for at in range(0, len(new), BATCH):
        parts = " ".join(f"PARTITION ({PARTITION_DATE} = DATE '{d}') LOCATION {quote(wanted[d])}" for d in new[at : at + BATCH])
        spark.sql(f"ALTER TABLE {target} ADD IF NOT EXISTS {parts}")
    moved = sorted(d for d in wanted if d in known and plain_path(known[d]) != plain_path(wanted[d]))
    for d in moved:
        spark.sql(f"ALTER TABLE {target} PARTITION ({PARTITION_DATE} = DATE '{d}') SET LOCATION {quote(wanted[d])}")
    return sorted([*new, *moved])


def plain_path(location: str) -> str:
    """A location without its scheme, as the catalog may or may not add one."""
    scheme, mark, rest = location.partition(":/")
    return "/" + (rest if mark and "/" not in scheme else location).strip("/")


def overwrite_day(
    spark: SparkSession, table: str, stats: DataFrame, day: str | dt.date, profile: RunProfile | None = None
) -> None:
    """Replace one day's partition of ``table`` with that day's rows of ``stats``.

    A static partition spec is used on purpose: with zero rows the partition
    is emptied and stays registered, instead of keeping stale rows. A day that
    was published by version is written to the table's own folder again.
    """
    lit = _day_literal(day)
    date, root = dt.date.fromisoformat(lit), table_location(spark, table)
    at = partition_locations(spark, table).get(date)
    if at and plain_path(at) != plain_path(_day_folder(root, date)):
        point_days(spark, table, root, [date])
    view = f"_daybook_day_{lit.replace('-', '_')}_{uuid.uuid4().hex[:8]}"
    target = stored_table(spark, table)
    kinds = dict(spark.table(target).dtypes)
    rows = stats.where(F.col(ORDER_DATE) == F.lit(dt.date.fromisoformat(lit)))
    rows = profile.days(rows) if profile else rows
    rows.select(*(F.col(c).cast(kinds[c]).alias(c) for c in DAILY_STATS_COLUMNS)).createOrReplaceTempView(view)
    try:
        spark.sql(
            f"INSERT OVERWRITE TABLE {target} "
            f"PARTITION ({PARTITION_DATE} = DATE '{lit}') "
            f"SELECT {', '.join(DAILY_STATS_COLUMNS)} FROM {view}"
        )
    finally:
        spark.catalog.dropTempView(view)


def register_partition(spark: SparkSession, table: str, day: str | dt.date) -> None:
    """Register one day's partition; a no-op when it is already registered."""
    spark.sql(
        f"ALTER TABLE {stored_table(spark, table)} ADD IF NOT EXISTS "
        f"PARTITION ({PARTITION_DATE} = DATE '{_day_literal(day)}')"
    )


def recover_partitions(spark: SparkSession, table: str) -> None:
    """Register every partition folder found under the table location."""
    spark.catalog.recoverPartitions(stored_table(spark, table))


def registered_partitions(spark: SparkSession, table: str) -> DataFrame:
    """Registered days of ``table`` as a one-column DATE frame.

    Catalog metadata lives on the driver by nature; this is one row per day.
    """
    listing = spark.sql(f"SHOW PARTITIONS {stored_table(spark, table)}")
    day = F.regexp_extract(F.col("partition"), rf"{PARTITION_DATE}=([0-9-]+)", 1)
    return listing.select(F.to_date(day).alias(PARTITION_DATE))
