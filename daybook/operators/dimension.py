"""Persisted first-order dimension: (email, first_order_date).

The single-day job needs, for the day's customers, whether any of their lines
is dated earlier. Without state that means scanning the ``email`` and
``order_date`` columns of the whole history every day. This dimension keeps
the answer at customer grain instead, so the daily job scans a table the size
of the customer base rather than of all lines.

Contract: the dimension must include every line dated before the day being
computed (later lines do no harm: the test is ``first_order_date < day``).
``merge_first_order_dimension`` folds new lines in with ``least`` semantics
(union + ``min`` per email), so late lines are handled when they pass through
a merge. ``build_first_order_dimension`` rebuilds it from full history, as
part of a backfill.

Storage is plain parquet written to a new folder per version; readers are
pointed at a version only after its write committed, and a retried write of
the same version simply replaces that folder. Each version states the day
through which it covers the lines, in the subfolder ``_covers``, written
last; a version without it, or one that does not reach the day before the
day to compute, is refused.
"""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.operators.per_day import (
    as_date,
    assemble,
    customers_of_day,
    day_orders,
    orders_of_day,
    segment_totals,
)
from daybook.operators.first_order import flag_against_seen
from daybook.operators.run_profile import RunProfile
from daybook.schema import EMAIL, FIRST_ORDER_DATE, ORDER_DATE

DIMENSION_SCHEMA = f"{EMAIL} STRING, {FIRST_ORDER_DATE} DATE"


def build_first_order_dimension(lines: DataFrame) -> DataFrame:
    """(email, first_order_date) over dated lines of known customers."""
    return (
        lines.where(F.col(EMAIL).isNotNull() & F.col(ORDER_DATE).isNotNull())
        .groupBy(EMAIL)
        .agg(F.min(ORDER_DATE).alias(FIRST_ORDER_DATE))
    )


def merge_first_order_dimension(dimension: DataFrame, new_lines: DataFrame) -> DataFrame:
    """Fold ``new_lines`` into ``dimension``: earliest date per email wins.

    The new lines are pre-aggregated to one row per email before the union,
    so the shuffle carries at most one row per customer from each side.
    """
    fresh = build_first_order_dimension(new_lines)
    return (
        dimension.select(EMAIL, FIRST_ORDER_DATE)
        .unionByName(fresh)
        .groupBy(EMAIL)
        .agg(F.min(FIRST_ORDER_DATE).alias(FIRST_ORDER_DATE))
    )


def write_dimension(dimension: DataFrame, location: str, covered_through: dt.date) -> None:
    """Write one dimension version (idempotent: a rerun replaces the folder)."""
    spark = dimension.sparkSession
    dimension.write.mode("overwrite").parquet(location)
    day = F.lit(covered_through).cast("date").alias("covered_through")
    spark.range(1).select(day).coalesce(1).write.mode("overwrite").parquet(f"{location}/_covers")


def covered_through(spark: SparkSession, location: str) -> dt.date:
    """The last day whose lines the version covers; raises if it does not say."""
    try:
        row = spark.read.schema("covered_through DATE").parquet(f"{location}/_covers").first()
    except AnalysisException as missing:
        raise ValueError(f"no complete first-order dimension at {location}") from missing
    if row is None or row[0] is None:
        raise ValueError(f"no complete first-order dimension at {location}")
    return row[0]


def last_day(lines: DataFrame) -> dt.date | None:
    return lines.agg(F.max(ORDER_DATE)).first()[0]


def read_dimension(spark: SparkSession, location: str) -> DataFrame:
    return spark.read.schema(DIMENSION_SCHEMA).parquet(location)


def daily_stats_for_day_from_dimension(
    lines: DataFrame,
    dimension: DataFrame,
    day,
    broadcast_limit_bytes: int | None = None,
    profile: RunProfile | None = None,
) -> DataFrame:
    """Single-day statistics using the dimension instead of the line history.

    Equal to ``daily_stats_for_day(lines, day)`` whenever ``dimension``
    covers every line dated before ``day``. Only the day's lines and the
    dimension rows with an earlier first order are read.
    """
    d0 = as_date(day)
    todays = day_orders(lines.where(F.col(ORDER_DATE) == d0), profile)
    earlier = dimension.where(F.col(FIRST_ORDER_DATE) < d0).select(EMAIL)
    flagged = flag_against_seen(customers_of_day(todays), earlier, broadcast_limit_bytes)
    return assemble(segment_totals(flagged), orders_of_day(todays))
