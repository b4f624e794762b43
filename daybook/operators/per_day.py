"""Per-day sales statistics.

Semantics kept from the reference pipeline:

* revenue sums skip nulls and an all-null day sums to 0.0;
* orders and customers are distinct non-null values per day (``''`` is a
  customer, emails are compared verbatim);
* a line is "new" when its day is the customer's first order day over the
  whole history (so two orders on that day are both new); guest lines are
  never new, so their spend is repeat spend while they are not counted as
  customers;
* a segment with no line that day is NULL; a repeat segment holding only
  guest lines has a customer count of 0;
* average order value is revenue / orders, NULL when there are no orders.

Plan shape. The reference runs three aggregations and two joins. Here the
customer figures come from one aggregate over the (day, customer) grain,
where every customer count is a plain ``count`` (each row is already one
distinct customer), so Catalyst needs no ``Expand`` for them. The only real
distinct count, orders per day, is a separate aggregate over the same lines
that Catalyst prunes to (order_date, order_id); its first shuffle is keyed on
(day, order) so a very busy day spreads over many tasks. The two day-level
results are joined on ``order_date``; both are at most one row per calendar
day, and AQE broadcasts or co-partitions them from their real sizes.

Revenue is summed exactly (``revenue_sum``), as DECIMAL with eight decimals, and published as
DOUBLE, so the result does not depend on the order rows are added in. A NaN
quantity or price is a missing number.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.functions import revenue_sum, safe_ratio
from daybook.operators.first_order import (
    DAY_REVENUE,
    customer_days,
    flag_against_prior,
    flag_first_days,
)
from daybook.operators.run_profile import RunProfile
from daybook.schema import (
    DAILY_STATS_COLUMNS,
    EMAIL,
    FIRST_ORDER_FL,
    ORDER_DATE,
    ORDER_ID,
    PRICE,
    QUANTITY,
)
from daybook.session import checkpoint_dir

_REVENUE = "_revenue"


def _zero_if_null(c: Column) -> Column:
    return F.coalesce(c, F.lit(0))


def _segment(flag: int) -> tuple[Column, Column]:
    """(customer count, spend) of the lines whose flag equals ``flag``."""
    fl = F.col(FIRST_ORDER_FL)
    present = F.count_if(fl == flag) > 0
    count = F.when(present, F.count(F.when(fl == flag, F.col(EMAIL))))
    spend = F.when(present, _zero_if_null(F.sum(F.when(fl == flag, F.col(DAY_REVENUE)))))
    return count, spend


def segment_totals(flagged_days: DataFrame) -> DataFrame:
    """Day-level revenue and customer figures from flagged ``customer_days``."""
    new_count, new_spend = _segment(1)
    rep_count, rep_spend = _segment(0)
    return flagged_days.groupBy(ORDER_DATE).agg(
        _zero_if_null(F.sum(DAY_REVENUE)).alias(_REVENUE),
        F.count(EMAIL).alias("total_customer_count"),
        new_count.alias("new_customer_count"),
        new_spend.alias("new_customer_spend"),
        rep_count.alias("repeat_customer_count"),
        rep_spend.alias("repeat_customer_spend"),
    )


def orders_per_day(lines: DataFrame) -> DataFrame:
    """(order_date, total_order_count): distinct non-null order ids per day."""
    return (
        lines.where(F.col(ORDER_DATE).isNotNull())
        .groupBy(ORDER_DATE)
        .agg(F.count_distinct(ORDER_ID).alias("total_order_count"))
    )


def assemble(segments: DataFrame, orders: DataFrame) -> DataFrame:
    total = F.col(_REVENUE).cast("double")
    joined = segments.join(orders, on=ORDER_DATE, how="left")
    out = {
        "order_date": F.col(ORDER_DATE),
        "total_product_revenue": total,
        "total_order_count": F.col("total_order_count"),
        "total_customer_count": F.col("total_customer_count"),
        "daily_aov": safe_ratio(total, "total_order_count"),
        "new_customer_count": F.col("new_customer_count"),
        "new_customer_spend": F.col("new_customer_spend").cast("double"),
        "repeat_customer_count": F.col("repeat_customer_count"),
        "repeat_customer_spend": F.col("repeat_customer_spend").cast("double"),
    }
    return joined.select(*[out[name].alias(name) for name in DAILY_STATS_COLUMNS])


def daily_stats(lines: DataFrame, share_source: bool = False, profile: RunProfile | None = None) -> DataFrame:
    """Full-history statistics: one row per day that has a dated line.

    ``share_source=False`` (default) builds the customer branch and the
    order-count branch each from ``lines``; for a parquet line table the
    second read is a pruned scan of ``order_date`` and ``order_id``, cheaper
    than any shuffle. ``share_source=True`` reads ``lines`` once: both
    branches start from one aggregate at (day, customer, order) grain whose
    shuffle Spark reuses, at the price of one more shuffle of order-grain
    rows. Use it when producing ``lines`` is expensive (a join, text files).
    ``profile`` counts the lines on their way through the aggregate.
    """
    if not share_source:
        days = profile.grain(lines, [ORDER_DATE, EMAIL], DAY_REVENUE) if profile else customer_days(lines)
        flagged = flag_first_days(days)
        return assemble(segment_totals(flagged), orders_per_day(lines))
    orders_grain = order_grain(lines, profile)
    days = orders_grain.groupBy(ORDER_DATE, EMAIL).agg(F.sum(_ORDER_REVENUE).alias(DAY_REVENUE))
    segments = segment_totals(flag_first_days(days)).drop(_REVENUE)
    # Revenue is taken from this branch so that both branches read every
    # column of ``orders_grain``: the two aggregates then stay identical and
    # their exchange is reused instead of recomputing ``lines``.
    per_order = orders_grain.groupBy(ORDER_DATE, ORDER_ID).agg(F.sum(_ORDER_REVENUE).alias(_ORDER_REVENUE))
    orders = per_order.groupBy(ORDER_DATE).agg(
        F.count(ORDER_ID).alias("total_order_count"),
        _zero_if_null(F.sum(_ORDER_REVENUE)).alias(_REVENUE),
    )
    return assemble(segments, orders)


_ORDER_REVENUE = "order_revenue"


def order_grain(lines: DataFrame, profile: RunProfile | None = None) -> DataFrame:
    """Dated lines reduced to one row per (day, customer, order) with revenue."""
    if profile:
        return profile.grain(lines, [ORDER_DATE, EMAIL, ORDER_ID], _ORDER_REVENUE)
    return (
        lines.where(F.col(ORDER_DATE).isNotNull())
        .groupBy(ORDER_DATE, EMAIL, ORDER_ID)
        .agg(revenue_sum(QUANTITY, PRICE).alias(_ORDER_REVENUE))
    )


def as_date(day: str | dt.date | Column) -> Column:
    if isinstance(day, Column):
        return day.cast("date")
    if isinstance(day, dt.datetime):
        day = day.date()
    return F.lit(day if isinstance(day, dt.date) else dt.date.fromisoformat(str(day)))


def daily_stats_for_day(
    lines: DataFrame,
    day: str | dt.date | Column,
    broadcast_limit_bytes: int | None = None,
    profile: RunProfile | None = None,
) -> DataFrame:
    """Statistics of a single day, equal to that day's row of ``daily_stats``.

    The day's lines are read once, reduced to (customer, order) grain and
    checkpointed (see ``day_orders``); customer and order figures both come
    from that. History is consulted through a semi-join on the day's
    customers (see ``flag_against_prior``), so the job does not reshuffle the
    full history every day. ``profile`` counts the day's lines and the history.
    """
    d0 = as_date(day)
    todays = day_orders(lines.where(F.col(ORDER_DATE) == d0), profile)
    earlier = profile.history(lines, d0) if profile else lines
    flagged = flag_against_prior(customers_of_day(todays), earlier, d0, broadcast_limit_bytes)
    return assemble(segment_totals(flagged), orders_of_day(todays))


def day_orders(todays_lines: DataFrame, profile: RunProfile | None = None) -> DataFrame:
    """One day's lines at (day, customer, order) grain, checkpointed.

    One day of orders: small next to the history. Materialising it reads the
    day's lines once for both the customer and the order figures, and lets
    the broadcast decision for the history semi-join use the real size of the
    day's customer set. A reliable checkpoint in the shared folder survives
    the loss of executors.
    """
    checkpoint_dir(todays_lines.sparkSession)
    return order_grain(todays_lines, profile).checkpoint(eager=True)


def customers_of_day(todays: DataFrame) -> DataFrame:
    """``customer_days`` rows from ``day_orders`` output."""
    return todays.groupBy(ORDER_DATE, EMAIL).agg(F.sum(_ORDER_REVENUE).alias(DAY_REVENUE))


def orders_of_day(todays: DataFrame) -> DataFrame:
    """``orders_per_day`` from ``day_orders`` output."""
    return todays.groupBy(ORDER_DATE).agg(F.count_distinct(ORDER_ID).alias("total_order_count"))


def daily_totals(lines: DataFrame, share_source: bool = False) -> DataFrame:
    """order_date, total_product_revenue, total_order_count,
    total_customer_count, daily_aov.

    A projection of ``daily_stats``: Catalyst prunes the segment aggregates
    and the first-order window, which these columns do not need.
    """
    return daily_stats(lines, share_source).select(
        ORDER_DATE, "total_product_revenue", "total_order_count", "total_customer_count", "daily_aov"
    )


def _segment_daily(lines: DataFrame, flag: int, prefix: str) -> DataFrame:
    flagged = flag_first_days(customer_days(lines)).where(F.col(FIRST_ORDER_FL) == flag)
    return flagged.groupBy(ORDER_DATE).agg(
        F.count(EMAIL).alias(f"{prefix}_customer_count"),
        _zero_if_null(F.sum(DAY_REVENUE)).cast("double").alias(f"{prefix}_customer_spend"),
    )


def new_customer_daily(lines: DataFrame) -> DataFrame:
    """Days with at least one first-order line: count and spend of new customers."""
    return _segment_daily(lines, 1, "new")


def repeat_customer_daily(lines: DataFrame) -> DataFrame:
    """Days with at least one repeat or guest line: repeat count and spend."""
    return _segment_daily(lines, 0, "repeat")
