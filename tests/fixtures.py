"""Small hand-written inputs for edge cases (tests only, never registered)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import types as T

TEXT_LINES_SCHEMA = T.StructType(
    [T.StructField(c, T.StringType(), True) for c in ("order_id", "email", "order_date", "quantity", "price")]
)

# (order_id, email, order_date, quantity, price); None = NULL, '' = empty string.
GOLDEN_LINES = [
    ("1001", "a@x.com", "2024-01-01", "2", "10.00"),
    ("1001", "a@x.com", "2024-01-01", "1", "5.50"),
    ("1002", "b@x.com", "2024-01-01", "1", "30.00"),
    ("1003", "a@x.com", "2024-01-01", "1", "4.50"),
    ("1004", "a@x.com", "2024-01-02", "3", "10.00"),
    ("1005", None, "2024-01-02", "1", "7.25"),
    ("1006", "c@x.com", "2024-01-03", None, "10.00"),
    ("1007", "b@x.com", "2024-01-04", "1", "12.00"),
    ("1008", None, "2024-01-05", "2", "3.00"),
    (None, "d@x.com", "2024-01-06", "1", "9.00"),
    ("1009", "B@x.com", "2024-01-07", "1", "1.00"),
    ("1010", "", "2024-01-08", "1", "2.00"),
    ("1011", "e@x.com", None, "1", "8.00"),
]

D = dt.date
# order_date, revenue, orders, customers, aov, new_c, new_spend, rep_c, rep_spend
GOLDEN_EXPECTED = [
    (D(2024, 1, 1), 60.0, 3, 2, 20.0, 2, 60.0, None, None),
    (D(2024, 1, 2), 37.25, 2, 1, 18.625, None, None, 1, 37.25),
    (D(2024, 1, 3), 0.0, 1, 1, 0.0, 1, 0.0, None, None),
    (D(2024, 1, 4), 12.0, 1, 1, 12.0, None, None, 1, 12.0),
    (D(2024, 1, 5), 6.0, 1, 0, 6.0, None, None, 0, 6.0),
    (D(2024, 1, 6), 9.0, 0, 1, None, 1, 9.0, None, None),
    (D(2024, 1, 7), 1.0, 1, 1, 1.0, 1, 1.0, None, None),
    (D(2024, 1, 8), 2.0, 1, 1, 2.0, 1, 2.0, None, None),
]


def text_lines(spark, rows):
    from daybook.sources import normalise_line_items

    return normalise_line_items(spark.createDataFrame(rows, TEXT_LINES_SCHEMA))


def local_path(location: str) -> str:
    """Strip a ``file:`` scheme so a location can be used as a plain path."""
    if location.startswith("file://"):
        return location[len("file://"):]
    if location.startswith("file:"):
        return location[len("file:"):]
    return location
