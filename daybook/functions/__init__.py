"""Column expressions (all JVM-side built-ins; no Python UDFs)."""

from daybook.functions.columns import (
    acquisition_month,
    customer_age,
    cutoff_60_days,
    finite,
    first_order_flag,
    product_revenue,
    revenue,
    revenue_sum,
    safe_ratio,
    to_day,
    week_label,
)

__all__ = [
    "acquisition_month",
    "customer_age",
    "cutoff_60_days",
    "finite",
    "first_order_flag",
    "product_revenue",
    "revenue",
    "revenue_sum",
    "safe_ratio",
    "to_day",
    "week_label",
]
