"""Money summed in two long numbers equals the sum of decimals, digit for digit."""

from __future__ import annotations

import math
from decimal import ROUND_HALF_UP, Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from daybook.functions import revenue, revenue_sum
from daybook.operators.first_order import customer_days
from daybook.sources import line_items_from_tpch
from tests.conftest import SF01

UNIT = Decimal("0.00000001")
SCHEMA = "g int, quantity double, price double"

prices = st.one_of(
    st.decimals("-2000", "2000", places=2).map(float),
    st.decimals("-20", "20", places=9).map(float),  # ties between two units
    st.floats(-1e7, 1e7, allow_nan=False),
    st.floats(-1e-6, 1e-6, allow_nan=False),
    st.sampled_from([0.0, -0.0, 999999.99999999, 1e6, 1e6 + 1e-9, -1e6, 1e12 + 0.01, -9e14, 1e15, 5e-9, 1.5e-8, math.nan, None]),
)
quantities = st.one_of(st.integers(-3, 60).map(float), st.sampled_from([0.1, 0.3, 1e-3, 1e3, math.nan, None]))


def by_hand(rows):
    """Exact sums by group from Python's decimals; the shortest text of each product, rounded half up."""
    out = {}
    for g, q, p in rows:
        out.setdefault(g, None)
        if q is None or p is None or math.isnan(q) or math.isnan(p):
            continue
        amount = Decimal(repr(q * p)).quantize(UNIT, rounding=ROUND_HALF_UP)
        out[g] = amount + (out[g] or 0)
    return out


def both(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).groupBy("g")
    found = df.agg(revenue_sum("quantity", "price").alias("s"), F.sum(revenue("quantity", "price")).alias("d"))
    assert dict(found.dtypes)["s"] == dict(found.dtypes)["d"] == "decimal(38,8)"
    return {r.g: r.s for r in found.collect()}, {r.g: r.d for r in found.collect()}


@settings(max_examples=25, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(0, 3), quantities, prices), min_size=1, max_size=60))
def test_equals_decimals_and_python(spark, rows):
    limbs, decimals = both(spark, rows)
    assert limbs == decimals == by_hand(rows)


def test_many_ties_and_noisy_products(spark):
    rows = [(i % 7, float(i % 50 + 1), i * 0.005 + (i % 3) * 5e-9) for i in range(20_000)]
    rows += [(7, 1.0, 999_999.99999999)] * 3 + [(8, -1.0, 999_999.99999999), (8, 1.0, 1e-8)] + [(9, None, 1.0)]
    limbs, decimals = both(spark, rows)
    assert limbs == decimals == by_hand(rows)
    assert limbs[9] is None


def test_infinity_and_products_out_of_range_raise(spark):
    for rows in ([(1, math.inf, 1.0)], [(1, 1e200, 1e200)], [(1, 1e12, 1e12)]):
        with pytest.raises(Exception):
            both(spark, rows)


def test_lines_are_added_as_long_numbers(spark):
    lines = line_items_from_tpch(spark, SF01)
    days = customer_days(lines)
    plan = days._jdf.queryExecution().executedPlan().toString()
    partial = next(x for x in plan.splitlines() if "partial_sum" in x)
    assert "shiftright" in partial and "16777215" in partial
    plain = lines.groupBy("order_date", "email").agg(F.sum(revenue("quantity", "price")).alias("day_revenue"))
    assert days.exceptAll(plain).count() == 0 and days.count() == plain.count()
