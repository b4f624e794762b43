"""Data-quality profiles of line items and of the published statistics.

The reference only logs these figures; here each one is a small DataFrame so
it can be checked, stored or alerted on. All of them are single-pass
aggregates (partial aggregation on every task, one tiny final merge).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.schema import ORDER_DATE


def null_counts(lines: DataFrame) -> DataFrame:
    """One row: ``row_count`` and ``null_<column>`` for every column."""
    return lines.agg(
        F.count(F.lit(1)).alias("row_count"),
        *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in lines.columns],
    )


def date_bounds(lines: DataFrame) -> DataFrame:
    """One row: earliest and latest ``order_date`` (nulls ignored)."""
    return lines.agg(
        F.min(ORDER_DATE).alias("min_order_date"),
        F.max(ORDER_DATE).alias("max_order_date"),
    )


def rows_per_day(stats: DataFrame) -> DataFrame:
    """Rows per ``order_date`` of a statistics frame (1 everywhere when healthy)."""
    return stats.groupBy(ORDER_DATE).agg(F.count(F.lit(1)).alias("row_count"))


def distinct_days(df: DataFrame) -> DataFrame:
    """The dated days present, one row each."""
    return df.where(F.col(ORDER_DATE).isNotNull()).select(ORDER_DATE).distinct()


def column_profile(df: DataFrame) -> DataFrame:
    """Per column: name, Spark type and non-null count (like ``DataFrame.info``).

    One aggregate pass computes every count; ``stack`` turns the single wide
    row into one row per column.
    """
    counts = df.agg(*[F.count(F.col(c)).alias(f"_n{i}") for i, c in enumerate(df.columns)])
    pieces = []
    for i, field in enumerate(df.schema.fields):
        name = field.name.replace("'", "\\'")
        pieces.append(f"'{name}', '{field.dataType.simpleString()}', _n{i}")
    stacked = f"stack({len(pieces)}, {', '.join(pieces)}) as (column_name, data_type, non_null_count)"
    return counts.selectExpr(stacked)


def sample_head(df: DataFrame, n: int = 3) -> DataFrame:
    """First ``n`` rows under a total order of all columns (deterministic).

    Spark plans ``orderBy(...).limit(n)`` as a per-task top-n followed by a
    merge of n rows per task, never a full sort.
    """
    return df.orderBy(*[F.col(c).asc_nulls_first() for c in df.columns]).limit(n)
