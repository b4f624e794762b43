"""Scalar column functions used by the enrichment and statistics stages.

Each takes and returns a ``Column`` so Catalyst can fold them into the
surrounding whole-stage-codegen span.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from daybook.schema import MONEY

ColumnOrName = Column | str

# Sums of money that can be added once more without losing a decimal.
_SUM = "decimal(37,8)"


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_day(c: ColumnOrName) -> Column:
    """Calendar day of a date, timestamp or ISO date/timestamp text.

    Null stays null; text that is not a date raises under ANSI mode.
    """
    return F.to_date(_col(c))


def week_label(day: ColumnOrName) -> Column:
    """``YYYY-WW`` with Monday-first weeks numbered from 00 (strftime ``%W``).

    Days before the first Monday of the year are week 00. This is not the
    ISO week, and Spark has no pattern letter for it, so it is computed from
    the day of the year and the weekday (0 = Monday).
    """
    d = _col(day)
    week = F.floor((F.dayofyear(d) + F.lit(6) - F.weekday(d)) / F.lit(7)).cast("int")
    return F.when(
        d.isNotNull(),
        F.concat(F.date_format(d, "yyyy"), F.lit("-"), F.lpad(week.cast("string"), 2, "0")),
    )


def finite(c: ColumnOrName) -> Column:
    """A DOUBLE with NaN as NULL (a missing number); infinity raises.

    Text that is not a number raises in the cast, as an empty string does.
    """
    x = _col(c).cast("double")
    broken = F.raise_error(F.lit("infinite quantity or price in a line item"))
    return F.when(F.isnan(x), F.lit(None)).when(F.abs(x) == float("inf"), broken).otherwise(x)


def revenue(quantity: ColumnOrName, price: ColumnOrName) -> Column:
    """Line revenue = quantity x price as DECIMAL(28,8).

    A null or NaN in either gives null; a product beyond any double raises, as
    infinity does. Eight decimals hold what a line of a
    shop can cost, fractions of a cent included; sums of decimals are exact
    and do not depend on the order of the rows.
    """
    return finite(finite(quantity) * finite(price)).cast(MONEY)


# Bits of the lower part of a sum in two long numbers. A line's part is below
# 2**24 either way (1e14 units are below 2**47), so that a long holds the sums
# of 2**39 lines; beyond that Spark's check of long sums raises.
_LOW_BITS = 24
# Lines below this amount are summed as long numbers of hundred-millionths.
_PLAIN_LIMIT = 1e6
_UNITS = 1e8


def revenue_sum(quantity: ColumnOrName, price: ColumnOrName) -> Column:
    """The aggregate ``sum(revenue(quantity, price))``, digit for digit, mostly without decimals.

    Decimals of this width are objects to every line that is added. A line's
    revenue is instead taken as a whole number of hundred-millionths, whose
    upper and lower bits are summed as two long numbers; they become one
    decimal where the group is complete. That number is the decimal's own
    rounding wherever the line is below a million and its product lies within
    0.4 units of a whole number: product, scaling and the shortest text of a
    double are together less than 0.02 units off there. Other lines (tiny
    fractions of a cent, very large amounts) are summed as decimals beside it.
    A group without revenue is NULL.
    """
    product = finite(quantity) * finite(price)
    scaled = product * F.lit(_UNITS)
    whole = F.rint(scaled)
    plain = (F.abs(product) < F.lit(_PLAIN_LIMIT)) & (F.abs(scaled - whole) < F.lit(0.4))
    units = F.when(plain, whole.cast("bigint"))
    upper = F.sum(F.shiftright(units, _LOW_BITS))
    lower = F.sum(units.bitwiseAND(F.lit((1 << _LOW_BITS) - 1)))
    rest = F.sum(F.when(~plain, finite(product).cast(MONEY))).cast(_SUM)
    together = upper.cast("decimal(19,0)") * F.lit(1 << _LOW_BITS).cast("decimal(8,0)") + lower.cast("decimal(19,0)")
    # 29 digits times a hundred-millionth keep all eight decimals.
    money = (together.cast("decimal(29,0)") * F.lit("0.00000001").cast("decimal(8,8)")).cast(_SUM)
    return F.coalesce(money + rest, money, rest).cast("decimal(38,8)")


def product_revenue(quantity: ColumnOrName, price: ColumnOrName) -> Column:
    """Line revenue as the enrichment publishes it."""
    return revenue(quantity, price)


def customer_age(order_day: ColumnOrName, first_day: ColumnOrName) -> Column:
    """Whole days between the customer's first order and this one."""
    return F.datediff(_col(order_day), _col(first_day))


def cutoff_60_days(first_day: ColumnOrName) -> Column:
    return F.date_add(_col(first_day), 60)


def acquisition_month(first_day: ColumnOrName) -> Column:
    return F.date_format(_col(first_day), "yyyy-MM")


def first_order_flag(order_day: ColumnOrName, first_day: ColumnOrName) -> Column:
    """1 when the line is on the customer's first order day, else 0.

    Day granular: every order on the first day is new. A null on either side
    (guest lines, undated lines) gives 0.
    """
    return F.coalesce((_col(order_day) == _col(first_day)).cast("int"), F.lit(0))


def safe_ratio(numerator: ColumnOrName, denominator: ColumnOrName) -> Column:
    """numerator / denominator, NULL instead of inf/NaN when dividing by 0."""
    return F.try_divide(_col(numerator).cast("double"), _col(denominator))
