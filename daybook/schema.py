"""Schemas and column names shared by every stage.

The output layout is positional (the published CSV has no self-describing
types), so the order of ``DAILY_STATS_COLUMNS`` is part of the contract.
"""

from __future__ import annotations

from pyspark.sql import types as T

# The five line-item columns the statistics read.
ORDER_ID = "order_id"
EMAIL = "email"
ORDER_DATE = "order_date"
QUANTITY = "quantity"
PRICE = "price"
LINE_ITEM_COLUMNS = (ORDER_ID, EMAIL, ORDER_DATE, QUANTITY, PRICE)

# Derived line-item columns (the cutoff is spelled correctly here).
PRODUCT_REV = "product_rev"
WEEK = "week"
FIRST_ORDER_DATE = "first_order_date"
AGE = "age"
CUTOFF_60_DAYS = "cutoff_60_days"
FIRST_ORDER_MONTH = "first_order_month"
FIRST_ORDER_FL = "first_order_fl"

PARTITION_DATE = "partition_date"

# Published daily statistics, in file order.
DAILY_STATS_COLUMNS = (
    "order_date",
    "total_product_revenue",
    "total_order_count",
    "total_customer_count",
    "daily_aov",
    "new_customer_count",
    "new_customer_spend",
    "repeat_customer_count",
    "repeat_customer_spend",
)

DAILY_STATS_SCHEMA = T.StructType(
    [
        T.StructField("order_date", T.DateType(), True),
        T.StructField("total_product_revenue", T.DoubleType(), True),
        T.StructField("total_order_count", T.LongType(), True),
        T.StructField("total_customer_count", T.LongType(), True),
        T.StructField("daily_aov", T.DoubleType(), True),
        T.StructField("new_customer_count", T.LongType(), True),
        T.StructField("new_customer_spend", T.DoubleType(), True),
        T.StructField("repeat_customer_count", T.LongType(), True),
        T.StructField("repeat_customer_spend", T.DoubleType(), True),
    ]
)

COUNT_COLUMNS = tuple(
    f.name for f in DAILY_STATS_SCHEMA.fields if isinstance(f.dataType, T.LongType)
)

# CSV cells are stored and read as text and cast strictly afterwards. Older
# writers left counts as "3.0" (a BIGINT column would silently read NULL) and
# an undefined average as "inf"; a cell that is no number raises.
DAILY_STATS_TEXT_SCHEMA = T.StructType(
    [T.StructField(f.name, T.StringType(), True) for f in DAILY_STATS_SCHEMA.fields]
    + [T.StructField(PARTITION_DATE, T.DateType(), True)]
)

# Money is summed exactly and published as DOUBLE.
MONEY = T.DecimalType(28, 8)


def daily_stats_ddl_columns(text: bool = False) -> str:
    """Column list for ``CREATE TABLE``, partition column last."""
    cols = [
        f"{f.name} {'STRING' if text else f.dataType.simpleString().upper()}" for f in DAILY_STATS_SCHEMA.fields
    ]
    cols.append(f"{PARTITION_DATE} DATE")
    return ", ".join(cols)


def daily_stats_cast(name: str) -> str:
    """SQL that types a text cell of column ``name``; infinite amounts are undefined, so NULL."""
    if name in COUNT_COLUMNS:
        return f"CAST(CAST({name} AS DOUBLE) AS BIGINT)"
    if name == ORDER_DATE:
        return f"CAST({name} AS DATE)"
    return f"CASE WHEN abs(CAST({name} AS DOUBLE)) < DOUBLE('Infinity') THEN CAST({name} AS DOUBLE) END"
