"""User-level jobs: backfill, daily run, table creation.

Each job is a handful of DataFrame / SQL calls; Spark does the work. The
only driver-side steps are the write commit and the catalog statements.

Late data: the daily job never revisits an earlier day. A line that arrives
with an older date can turn a later "new" customer into a repeat one;
``run_repair`` publishes exactly the days that such lines change, given the
first-order dimension of before, and ``run_backfill`` all days.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from daybook.operators.affected import affected_days, daily_stats_for_days, daily_stats_for_days_from_history
from daybook.operators.per_day import daily_stats, daily_stats_for_day
from daybook.operators.bucketed_dimension import (
    build_bucketed_dimension,
    merge_bucketed_dimension,
    read_bucketed_dimension,
    table_covered_through,
)
from daybook.operators.publish import publish
from daybook.operators.dimension import (
    build_first_order_dimension,
    covered_through,
    daily_stats_for_day_from_dimension,
    last_day,
    merge_first_order_dimension,
    read_dimension,
    write_dimension,
)
from daybook.operators.run_profile import RunProfile
from daybook.operators.sink import (
    create_daily_stats_table,
    overwrite_day,
    point_days,
    register_partition,
    table_location,
    write_daily_stats,
)
from daybook.schema import DAILY_STATS_SCHEMA


def yesterday(spark: SparkSession) -> dt.date:
    """The day before today in the session time zone, read once per run."""
    return spark.sql("SELECT date_sub(current_date(), 1)").first()[0]


def create_table(spark: SparkSession, name: str, location: str, fmt: str = "csv") -> None:
    """Create the partitioned statistics table if absent."""
    create_daily_stats_table(spark, name, location, fmt)


def run_backfill(
    spark: SparkSession,
    lines: DataFrame,
    location: str | None = None,
    table: str | None = None,
    fmt: str = "csv",
    share_source: bool = False,
    writers: int | None = None,
    by_version: bool = False,
) -> RunProfile:
    """Recompute every day from full history and publish it.

    One job, one dynamic-overwrite write: days absent from the result are
    untouched, days present are replaced. With ``table`` the days that the job
    wrote and the table does not have yet are then registered; no folder is
    listed. ``by_version`` publishes through a staged version instead (see
    ``operators.publish``): audited, and switched day by day. ``share_source`` is passed to
    ``daily_stats`` (set it when ``lines`` is itself a join or text files),
    ``writers`` to ``write_daily_stats``.

    Returns the run's profile, which is counted along the way.

    Where there is a table its location is where the days go; a different
    ``location`` raises, as the table would not see them.
    """
    if table:
        where = table_location(spark, table)
        if location and not _same_folder(spark, where, location):
            raise ValueError(f"{table} is at {where}, not at {location}")
        location = where
    if not location:
        raise ValueError("a backfill needs a location or a table")
    if by_version and (not table or fmt != "csv"):
        raise ValueError("publication by version needs a CSV table")
    profile = RunProfile(lines)
    stats = daily_stats(lines, share_source, profile)
    if by_version:
        profile.published = publish(spark, table, stats, profile, writers=writers)
        return profile
    write_daily_stats(stats, location, fmt, writers, profile)
    if table:
        profile.published = point_days(spark, table, location, profile.written_days())
    return profile


def _same_folder(spark: SparkSession, a: str, b: str) -> bool:
    """Whether two locations are one after the file system has completed them."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()

    def full(location: str) -> str:
        path = jvm.org.apache.hadoop.fs.Path(location)
        return path.getFileSystem(conf).makeQualified(path).toString().rstrip("/")

    return full(a) == full(b)


def run_daily(
    spark: SparkSession,
    lines: DataFrame,
    table: str,
    as_of_date: str | dt.date | None = None,
    dimension_location: str | None = None,
    broadcast_limit_bytes: int | None = None,
    profile_history: bool = False,
    dimension_table: str | None = None,
) -> RunProfile:
    """Publish one day (default: yesterday) into ``table``; returns the run's profile, with the ``day``.

    First-order dates still use the whole history: through a semi-join of
    earlier lines on the day's customers, or, with ``dimension_location``,
    or ``dimension_table`` (one in buckets, which is joined without being
    shuffled), through the persisted first-order dimension, which is refused unless it
    covers every line dated before the day (see ``refresh_dimension``). The day's partition is
    replaced even when the day has no lines, and registered if new.
    ``broadcast_limit_bytes`` caps the broadcast of the day's customers (the
    session's broadcast threshold by default). ``profile_history`` counts the
    scanned history too (see ``RunProfile``).
    """
    day = as_of_date or yesterday(spark)
    if isinstance(day, str):
        day = dt.date.fromisoformat(day)
    profile = RunProfile(lines, day, with_history=profile_history)
    dim = _dimension(spark, dimension_location, dimension_table, day - dt.timedelta(days=1))
    if dim is not None:
        stats = daily_stats_for_day_from_dimension(lines, dim, day, broadcast_limit_bytes, profile)
    else:
        stats = daily_stats_for_day(lines, day, broadcast_limit_bytes, profile)
    overwrite_day(spark, table, stats, day, profile)
    register_partition(spark, table, day)
    return profile


def _dimension(spark: SparkSession, location: str | None, table: str | None, needed: dt.date) -> DataFrame | None:
    """First orders from a folder or from a table in buckets; raises if they do not reach the needed day."""
    if location and table:
        raise ValueError("a dimension is a folder or a table, not both")
    if not location and not table:
        return None
    through = covered_through(spark, location) if location else table_covered_through(spark, table)
    if through < needed:
        raise ValueError(f"the dimension covers lines through {through}, too few: {needed} is needed")
    return read_dimension(spark, location) if location else read_bucketed_dimension(spark, table)


def run_catch_up(
    spark: SparkSession,
    lines: DataFrame,
    table: str,
    days: Sequence[dt.date],
    dimension_location: str | None = None,
    dimension_table: str | None = None,
) -> RunProfile:
    """Publish several days, for example those that daily runs have missed.

    First orders of all the days come from one pass over the history, or from a
    dimension that covers the lines before the last day. Days without lines
    are emptied, as by the daily job.
    """
    days = sorted(set(days))
    if not days:
        raise ValueError("no days to publish")
    profile = RunProfile(lines)
    dim = _dimension(spark, dimension_location, dimension_table, days[-1])
    if dim is not None:
        stats = daily_stats_for_days(lines, days, dim, profile)
    else:
        stats = daily_stats_for_days_from_history(lines, days, profile)
    profile.published = publish(spark, table, stats, profile)
    nothing = spark.createDataFrame([], DAILY_STATS_SCHEMA)
    for day in sorted(set(days) - set(profile.written_days())):
        overwrite_day(spark, table, nothing, day)
        register_partition(spark, table, day)
    return profile


def run_repair(
    spark: SparkSession,
    lines: DataFrame,
    late_lines: DataFrame,
    table: str,
    old_dimension: str,
    new_dimension: str,
) -> RunProfile:
    """Publish the days that late lines change, and no others.

    ``lines`` holds the late lines already; ``old_dimension`` is the version
    of before. A new version is written to ``new_dimension`` first. The days
    follow from the late lines and the old version (``affected_days``); they
    are computed from their lines and the new version, and published by
    version. Afterwards the table equals a full backfill; other days keep
    their files. Run again after a failure with the same arguments.
    """
    merge_dimension(spark, late_lines, old_dimension, new_dimension)
    affected = affected_days(late_lines, read_dimension(spark, old_dimension))
    days = sorted(r[0] for r in affected.collect())  # calendar days
    profile = RunProfile(lines)
    profile.published = []
    if days:
        stats = daily_stats_for_days(lines, days, read_dimension(spark, new_dimension), profile)
        profile.published = publish(spark, table, stats, profile)
    return profile


def run_repair_in_buckets(
    spark: SparkSession, lines: DataFrame, late_lines: DataFrame, table: str, dimension_table: str, through: dt.date | None = None
) -> RunProfile:
    """As ``run_repair``, with a dimension in buckets that is merged in place.

    The days are found and published by the dimension as it is and the late
    lines beside it, and only then are the late lines folded in: a run that
    dies at any point is completed by running it again, since the days whose
    old first orders a merge has replaced were published before.
    """
    dimension = read_bucketed_dimension(spark, dimension_table)
    days = sorted(r[0] for r in affected_days(late_lines, dimension).collect())  # calendar days
    profile = RunProfile(lines)
    profile.published = []
    if days:
        stats = daily_stats_for_days(lines, days, dimension, profile, late_lines)
        profile.published = publish(spark, table, stats, profile)
    merge_into_bucketed_dimension(spark, late_lines, dimension_table, through)
    return profile


def refresh_dimension(lines: DataFrame, location: str, through: dt.date | None = None) -> None:
    """Rebuild the first-order dimension from full history into a new folder.

    Run it with the backfill (the repair path for late lines); point the
    daily job at the newest folder. ``through`` is the day up to which
    ``lines`` is complete, by default its last day; give it where the last
    days may have no lines.
    """
    through = through or last_day(lines)
    if through is None:
        raise ValueError("no dated lines: give the day through which there are none")
    write_dimension(build_first_order_dimension(lines), location, through)


def merge_dimension(
    spark: SparkSession,
    new_lines: DataFrame,
    old_location: str,
    new_location: str,
    through: dt.date | None = None,
) -> None:
    """Write a new dimension version: ``old`` folded with ``new_lines``.

    Typically ``new_lines`` are the lines loaded since the previous version
    (late lines included); the result covers both, through the later of the
    old version's day and ``through`` (by default the new lines' last day).
    """
    days = [covered_through(spark, old_location), through or last_day(new_lines)]
    merged = merge_first_order_dimension(read_dimension(spark, old_location), new_lines)
    write_dimension(merged, new_location, max(d for d in days if d))


def refresh_bucketed_dimension(
    spark: SparkSession, lines: DataFrame, table: str, location: str, buckets: int, through: dt.date | None = None
) -> None:
    """As ``refresh_dimension``, into a table in buckets (created if absent, else replaced bucket by bucket)."""
    through = through or last_day(lines)
    if through is None:
        raise ValueError("no dated lines: give the day through which there are none")
    build_bucketed_dimension(spark, lines, table, location, buckets, through)


def merge_into_bucketed_dimension(
    spark: SparkSession, new_lines: DataFrame, table: str, through: dt.date | None = None
) -> list[int]:
    """As ``merge_dimension``, in place: rewrites the buckets of new or earlier customers, and returns them."""
    return merge_bucketed_dimension(spark, table, new_lines, through or last_day(new_lines))
