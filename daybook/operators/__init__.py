"""DataFrame -> DataFrame operators of the statistics pipeline."""

from daybook.operators.per_day import (
    daily_stats,
    daily_stats_for_day,
    daily_totals,
    new_customer_daily,
    orders_per_day,
    repeat_customer_daily,
)
from daybook.operators.first_order import (
    customer_days,
    enrich_line_items,
    first_order_by_customer,
    flag_first_days,
    with_first_order,
)

__all__ = [
    "customer_days",
    "daily_stats",
    "daily_stats_for_day",
    "daily_totals",
    "enrich_line_items",
    "first_order_by_customer",
    "flag_first_days",
    "new_customer_daily",
    "orders_per_day",
    "repeat_customer_daily",
    "with_first_order",
]
