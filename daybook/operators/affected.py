"""Which days late lines change, and the statistics of a set of days.

A line that arrives late changes its own day. It can also move its customer's
first order to an earlier day: then the old first day changes too, since the
customer was new there and is a repeat customer now. No other day changes: the
customer has no lines between the two days, and later lines were repeat before
and are repeat after. So the set follows from the late lines and the first
orders as they were, without the history.

A set of days is one row for each calendar day, so it goes to the driver and
into the plan as literals, which prune partitions and reach the scan.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.functions import first_order_flag
from daybook.operators.first_order import DAY_REVENUE, customer_days
from daybook.operators.per_day import assemble, orders_per_day, segment_totals
from daybook.operators.run_profile import RunProfile
from daybook.schema import EMAIL, FIRST_ORDER_DATE, FIRST_ORDER_FL, ORDER_DATE


def affected_days(late_lines: DataFrame, old_first_orders: DataFrame) -> DataFrame:
    """Days (``order_date``, distinct) whose statistics the late lines can change.

    ``old_first_orders`` has (email, first_order_date) from before the late
    lines. Late lines are reduced to (day, customer) first, so that a customer
    with very many of them is a row a day.
    """
    dated = late_lines.where(F.col(ORDER_DATE).isNotNull()).select(ORDER_DATE, EMAIL).distinct()
    earliest = dated.where(F.col(EMAIL).isNotNull()).groupBy(EMAIL).agg(F.min(ORDER_DATE).alias("_earliest"))
    moved = earliest.join(old_first_orders.select(EMAIL, FIRST_ORDER_DATE), EMAIL).where(F.col("_earliest") < F.col(FIRST_ORDER_DATE))
    old_days = moved.select(F.col(FIRST_ORDER_DATE).alias(ORDER_DATE))
    return dated.select(ORDER_DATE).union(old_days).distinct()


def _of_days(lines: DataFrame, days: Sequence[dt.date]) -> DataFrame:
    return lines.where(F.col(ORDER_DATE).isin([F.lit(d) for d in days]))


def daily_stats_for_days(
    lines: DataFrame,
    days: Sequence[dt.date],
    first_orders: DataFrame,
    profile: RunProfile | None = None,
    later_lines: DataFrame | None = None,
) -> DataFrame:
    """Statistics of the given days, equal to their rows of ``daily_stats(lines)``.

    ``first_orders`` (email, first_order_date) must cover the lines up to the
    last of the days. Only the days' lines are read. They are joined to the
    dimension at (day, customer) grain: a customer has a row a day at most.
    ``later_lines`` are lines that ``first_orders`` does not cover yet; their
    first orders are joined on the same key, so a dimension in buckets stays where it is.
    """
    todays = _of_days(lines, days)
    grain = profile.grain(todays, [ORDER_DATE, EMAIL], DAY_REVENUE) if profile else customer_days(todays)
    known = first_orders.where(F.col(EMAIL).isNotNull()).select(EMAIL, FIRST_ORDER_DATE)
    dated = grain.join(known, EMAIL, "left")
    if later_lines is not None:
        later = later_lines.where(F.col(EMAIL).isNotNull()).groupBy(EMAIL).agg(F.min(ORDER_DATE).alias("_later"))
        dated = dated.join(later, EMAIL, "left").withColumn(FIRST_ORDER_DATE, F.least(FIRST_ORDER_DATE, "_later")).drop("_later")
    flagged = dated.withColumn(FIRST_ORDER_FL, first_order_flag(ORDER_DATE, FIRST_ORDER_DATE))
    return assemble(segment_totals(flagged.drop(FIRST_ORDER_DATE)), orders_per_day(todays))


def daily_stats_for_days_from_history(lines: DataFrame, days: Sequence[dt.date], profile: RunProfile | None = None) -> DataFrame:
    """Statistics of the given days without a dimension: the history is scanned once for all of them.

    First orders come from the lines up to the last day; they are reduced to
    (email, first day) before the join, so a customer is one row a task.
    """
    upto = lines.where(F.col(EMAIL).isNotNull() & (F.col(ORDER_DATE) <= F.lit(max(days))))
    first = upto.groupBy(EMAIL).agg(F.min(ORDER_DATE).alias(FIRST_ORDER_DATE))
    return daily_stats_for_days(lines, days, first, profile)
