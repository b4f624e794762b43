"""First order date per customer and the line-level enrichment.

A customer is an exact, non-null ``email`` value. Guest lines (null email)
never have a first order date: they are never "new".

Everything here is keyed so that no single task has to hold an unbounded
group, even when one customer or the guest group holds a third of all lines:

* ``first_order_by_customer`` - partial + final aggregate by email; a heavy
  customer ships one row per map task.
* ``customer_days`` / ``flag_first_days`` - lines reduced to one row per
  (day, customer), then a ``min`` window per email. A window partition holds
  at most one row per calendar day of that customer's history, however many
  lines they have. Guests share the null window partition, bounded the same
  way, and are forced to flag 0.
* ``with_first_order`` (line grain) - lines are joined to the (day, customer)
  pairs on (email, day), not on email alone, so a heavy customer's lines spread over
  all their days instead of one task; guests go round the join. Both join
  inputs are plain shuffles, which is the shape AQE's skew-join rule needs to
  split any remaining oversized (day, customer) partition. (A join to the
  email aggregate would reuse the aggregate's exchange and AQE could not
  split it.)
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daybook.functions import (
    acquisition_month,
    customer_age,
    cutoff_60_days,
    first_order_flag,
    product_revenue,
    revenue_sum,
    week_label,
)
from daybook.schema import (
    AGE,
    CUTOFF_60_DAYS,
    EMAIL,
    FIRST_ORDER_DATE,
    FIRST_ORDER_FL,
    FIRST_ORDER_MONTH,
    ORDER_DATE,
    PRICE,
    PRODUCT_REV,
    QUANTITY,
    WEEK,
)
from daybook.session import checkpoint_dir

# Name of the per (day, customer) revenue column of ``customer_days``.
DAY_REVENUE = "day_revenue"


def first_order_by_customer(lines: DataFrame) -> DataFrame:
    """(email, first_order_date): earliest order day over the whole history.

    Null emails are not customers and get no row. Undated lines are ignored
    by ``min``; a customer whose lines are all undated keeps a NULL date.
    """
    return (
        lines.where(F.col(EMAIL).isNotNull())
        .groupBy(EMAIL)
        .agg(F.min(ORDER_DATE).alias(FIRST_ORDER_DATE))
    )


def with_first_order(lines: DataFrame, share_source: bool = False) -> DataFrame:
    """Lines with their customer's ``first_order_date`` (NULL for guests).

    The right side holds one row per distinct (day, customer) pair of the
    lines, undated ones included, with the customer's earliest day from a
    ``min`` window per email. Each line with an email matches exactly one
    pair (the day is compared null-safely, so an undated line still gets its
    customer's date). Guest lines can match nothing and go round the join.
    Row count is preserved.

    ``lines`` feeds three branches. With ``share_source`` they are produced
    once and checkpointed in the shared folder; set it when producing them is
    expensive (a join, text files). A parquet table is scanned again instead.
    """
    if share_source:
        checkpoint_dir(lines.sparkSession)
        lines = lines.checkpoint()
    email, day = F.col(EMAIL), F.col(ORDER_DATE)
    known = lines.where(email.isNotNull())
    keyed = known.select(EMAIL, ORDER_DATE).distinct().select(
        email.alias("_k_email"),
        day.alias("_k_day"),
        F.min(ORDER_DATE).over(Window.partitionBy(EMAIL)).alias(FIRST_ORDER_DATE),
    )
    cond = (email == F.col("_k_email")) & day.eqNullSafe(F.col("_k_day"))
    dated = known.join(keyed, on=cond, how="left").select(*lines.columns, FIRST_ORDER_DATE)
    guests = lines.where(email.isNull()).withColumn(FIRST_ORDER_DATE, F.lit(None).cast("date"))
    return dated.unionByName(guests)


def enrich_line_items(lines: DataFrame, share_source: bool = False) -> DataFrame:
    """Line items with every derived column of the reference pipeline.

    Adds ``product_rev`` (exact decimal), ``week`` (``YYYY-WW``),
    ``first_order_date``, ``age`` (days since first order), ``cutoff_60_days``,
    ``first_order_month`` (``YYYY-MM``) and ``first_order_fl`` (0/1).
    ``share_source`` as in ``with_first_order``.
    """
    joined = with_first_order(lines, share_source)
    od, fd = F.col(ORDER_DATE), F.col(FIRST_ORDER_DATE)
    return joined.select(
        *lines.columns,
        product_revenue(QUANTITY, PRICE).alias(PRODUCT_REV),
        week_label(od).alias(WEEK),
        fd.alias(FIRST_ORDER_DATE),
        customer_age(od, fd).alias(AGE),
        cutoff_60_days(fd).alias(CUTOFF_60_DAYS),
        acquisition_month(fd).alias(FIRST_ORDER_MONTH),
        first_order_flag(od, fd).alias(FIRST_ORDER_FL),
    )


def customer_days(lines: DataFrame) -> DataFrame:
    """One row per (order_date, email) with the exact revenue of those lines.

    Undated lines are dropped (they belong to no day). Guests form one row
    per day with a null email. ``day_revenue`` is NULL when every line of the group has a null revenue; the row itself
    still records presence.
    Map-side partial aggregation shrinks lines to (day, customer) pairs
    before the shuffle, so a heavy customer costs one row per day per task.
    """
    return (
        lines.where(F.col(ORDER_DATE).isNotNull())
        .groupBy(ORDER_DATE, EMAIL)
        .agg(revenue_sum(QUANTITY, PRICE).alias(DAY_REVENUE))
    )


def flag_first_days(days: DataFrame) -> DataFrame:
    """Add ``first_order_fl`` to ``customer_days`` output using full history."""
    email = F.col(EMAIL)
    first = F.when(email.isNotNull(), F.min(ORDER_DATE).over(Window.partitionBy(EMAIL)))
    return days.withColumn(FIRST_ORDER_FL, first_order_flag(ORDER_DATE, first))


# Bytes that a customer key takes in a broadcast hash relation beside its text:
# the row's header and word-aligned fields, the hash table's slot and pointer.
_KEY_ROW_OVERHEAD = 96


def broadcast_limit_bytes(spark) -> int:
    """The session's broadcast threshold in bytes (-1 when disabled)."""
    raw = spark.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760b")
    raw = raw.strip().lower()
    units = {"b": 1, "k": 1 << 10, "kb": 1 << 10, "m": 1 << 20, "mb": 1 << 20, "g": 1 << 30, "gb": 1 << 30}
    for suffix in sorted(units, key=len, reverse=True):
        if raw.endswith(suffix) and raw[: -len(suffix)].strip().lstrip("-").isdigit():
            return int(raw[: -len(suffix)]) * units[suffix]
    return int(raw)


def customer_keys_fit_broadcast(keys: DataFrame, limit: int | None = None) -> bool:
    """Measure a one-column email frame and compare it with the threshold.

    One small aggregate job (row count and total key length); callers use it
    on data that is already materialised (checkpointed), so it rereads only
    that data.
    """
    if limit is None:
        limit = broadcast_limit_bytes(keys.sparkSession)
    if limit <= 0:
        return False
    row = keys.agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.octet_length(EMAIL)), F.lit(0)).alias("text_bytes")
    ).first()
    return row["n"] * _KEY_ROW_OVERHEAD + row["text_bytes"] <= limit


def flag_against_seen(
    days: DataFrame, earlier: DataFrame, broadcast_limit_bytes: int | None = None
) -> DataFrame:
    """Flag one day's ``customer_days`` rows given customers seen earlier.

    ``earlier`` holds an ``email`` column of customers with a line before the
    day (duplicates allowed). Its distinct emails are left-joined to the day's
    rows. The distinct comes before any shuffle join: a map task sends one row
    for each customer it meets, however many lines a hot customer has.

    If the day's customers fit the session's broadcast threshold by measured
    size, ``earlier`` is first semi-joined to them where it is scanned, and
    only matching customers reach the distinct. ``days`` should be derived
    from materialised data (see ``day_orders``) so the size check does not
    recompute the day's lines. ``broadcast_limit_bytes`` overrides the
    threshold for this join; 0 means never.
    """
    email = F.col(EMAIL)
    todays = days.where(email.isNotNull()).select(EMAIL)
    seen = earlier.where(email.isNotNull()).select(EMAIL)
    if customer_keys_fit_broadcast(todays, broadcast_limit_bytes):
        seen = seen.join(F.broadcast(todays), on=EMAIL, how="left_semi")
    seen = seen.distinct().withColumn("_seen_before", F.lit(True))
    flagged = days.join(seen, on=EMAIL, how="left")
    fl = F.when(email.isNotNull() & F.col("_seen_before").isNull(), F.lit(1)).otherwise(F.lit(0))
    return flagged.select(*days.columns, fl.alias(FIRST_ORDER_FL))


def flag_against_prior(
    days: DataFrame, lines: DataFrame, day, broadcast_limit_bytes: int | None = None
) -> DataFrame:
    """Flag one day's ``customer_days`` rows without a full-history shuffle.

    A customer is new on ``day`` exactly when no line of theirs is dated
    earlier. History is filtered to earlier days (pushed to the scan) and
    checked against the day's customers with ``flag_against_seen``.
    """
    return flag_against_seen(days, lines.where(F.col(ORDER_DATE) < day), broadcast_limit_bytes)
