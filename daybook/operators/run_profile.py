"""Figures of a publishing job that ride on the job itself.

Counts are taken where the job aggregates lines anyway: a few long counters in
the aggregate to (day, customer) or (day, customer, order), summed up by
``DataFrame.observe`` over that grain, and over the published days. No line is
read again, and no plan gets another scan or shuffle. Two costs: the aggregate
also takes undated lines, which are counted and then dropped, and without a
shared source its scan also reads ``order_id``.

Observations are accumulators: what is recomputed after the loss of an executor
can count twice. They describe a run; what was published is counted from
its files (see ``publish``).

Defined results: an input without lines has counts of 0 and null bounds, also
where Spark has optimised its plan away.
"""

from __future__ import annotations

import datetime as dt
import uuid
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from daybook.functions import revenue_sum
from daybook.schema import DAILY_STATS_COLUMNS, EMAIL, LINE_ITEM_COLUMNS, ORDER_DATE, ORDER_ID, PRICE, QUANTITY

_LINES, _ORDERS, _QUANTITIES, _PRICES = "_lines", "_order_ids", "_quantities", "_prices"
LISTS = ("first_rows", "listed")
FRAME_SCHEMA = "scope string, item string, value string"


class RunProfile:
    """What a job saw and wrote; complete once the job has run.

    ``published`` has the days whose partitions the job has added or moved.

    ``with_history`` also counts the lines that a single-day job scans before
    its day. Off by default: it keeps a join that produces the lines from
    being reduced to the day's customers before it runs. A day without known
    customers scans no history and counts none.
    """

    def __init__(self, lines: DataFrame, day: dt.date | None = None, first: int = 3, with_history: bool = False):
        self.day, self.first, self.with_history = day, first, with_history
        self.published: list[dt.date] | None = None
        self.types = {c: t for c, t in lines.dtypes if c in LINE_ITEM_COLUMNS}
        self._seen: dict[str, tuple[Observation, list[str]]] = {}

    def _watch(self, scope: str, rows: DataFrame, figures: dict[str, Column]) -> DataFrame:
        seen = Observation(f"{scope}-{uuid.uuid4().hex}")
        self._seen[scope] = seen, list(figures)
        return rows.observe(seen, *(c.alias(name) for name, c in figures.items()))

    def grain(self, lines: DataFrame, keys: list[str], revenue_name: str) -> DataFrame:
        """Dated lines at the grain of ``keys`` with their revenue; all lines are counted on the way."""
        has_order = ORDER_ID in keys
        counts = [F.count(F.lit(1)).alias(_LINES), F.count(QUANTITY).alias(_QUANTITIES), F.count(PRICE).alias(_PRICES)]
        if not has_order:
            counts.append(F.count(ORDER_ID).alias(_ORDERS))
        rows = lines.groupBy(*keys).agg(revenue_sum(QUANTITY, PRICE).alias(revenue_name), *counts)

        def lines_where(condition: Column | None = None, counter: str = _LINES) -> Column:
            counted = F.col(counter) if condition is None else F.when(condition, F.col(counter))
            return F.coalesce(F.sum(counted), F.lit(0))

        day, order = F.col(ORDER_DATE), F.col(ORDER_ID)
        watched = self._watch(
            "lines",
            rows,
            {
                "row_count": lines_where(),
                f"null_{ORDER_DATE}": lines_where(day.isNull()),
                f"non_null_{ORDER_ID}": lines_where(order.isNotNull()) if has_order else lines_where(counter=_ORDERS),
                f"non_null_{EMAIL}": lines_where(F.col(EMAIL).isNotNull()),
                f"non_null_{ORDER_DATE}": lines_where(day.isNotNull()),
                f"non_null_{QUANTITY}": lines_where(counter=_QUANTITIES),
                f"non_null_{PRICE}": lines_where(counter=_PRICES),
                "min_order_date": F.min(day),
                "max_order_date": F.max(day),
            },
        )
        return watched.where(day.isNotNull()).select(*keys, revenue_name)

    def history(self, lines: DataFrame, day: Column) -> DataFrame:
        """Lines dated before ``day``; they and undated ones are counted where they are scanned."""
        at = F.col(ORDER_DATE)
        if not self.with_history:
            return lines.where(at < day)
        rows = lines.where((at < day) | at.isNull())
        watched = self._watch(
            "history",
            rows,
            {
                "row_count": F.count(F.lit(1)),
                f"null_{ORDER_DATE}": F.count(F.lit(1)) - F.count(at),
                "min_order_date": F.min(at),
                "max_order_date": F.max(at),
            },
        )
        return watched.where(at.isNotNull())

    def days(self, stats: DataFrame) -> DataFrame:
        """The days to publish, counted; put it right before the write."""
        head = F.slice(F.sort_array(F.collect_list(F.struct(*DAILY_STATS_COLUMNS))), 1, self.first)
        figures = {"row_count": F.count(F.lit(1)), "min_order_date": F.min(ORDER_DATE), "max_order_date": F.max(ORDER_DATE)}
        # One row for each calendar day: small enough to be listed in one place.
        listed = F.sort_array(F.collect_set(ORDER_DATE))
        return self._watch("days", stats, figures | {"first_rows": head, "listed": listed})

    def written_days(self) -> list[dt.date]:
        """The days that the job wrote, in order."""
        return list(self.figures()["days"]["listed"])

    def figures(self) -> dict[str, dict[str, Any]]:
        """Scope (lines, history, days) to its figures; call it after the job."""
        return {scope: _taken(seen, names) for scope, (seen, names) in self._seen.items()}

    def frame(self, spark: SparkSession) -> DataFrame:
        """The profile as rows (scope, item, value), values as text; lists are left to ``figures``."""
        rows = [("lines", f"type_{c}", t) for c, t in self.types.items()]
        for scope, figures in self.figures().items():
            rows += [(scope, k, None if v is None else str(v)) for k, v in figures.items() if k not in LISTS]
        return spark.createDataFrame(rows, FRAME_SCHEMA)


def _taken(seen: Observation, names: list[str]) -> dict[str, Any]:
    """The observation's row; of a plan that was optimised away, what it is without rows."""
    found = seen._jo.getRowOrEmpty()
    if found.isDefined() and found.get().schema() is not None:
        return seen.get
    empty = {n: [] for n in LISTS} | {n: None for n in ("min_order_date", "max_order_date")}
    return {n: empty.get(n, 0) for n in names}
