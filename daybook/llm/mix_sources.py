"""Mixing sources to target weights by systematic sampling.

The mix is as large as its input and is shared by the sources' weights. No
target passes ``limit`` times its source's size; what is above is shared again
by weight among the others until none is above. Ordered by what it could take
for each unit of weight, a source stops at its limit exactly if it does once
all sources before it have, so prefix sums over the sources settle all targets.

A document's expected copies are its source's target over its source's size.
Within a source, documents stand in order of size; expected copies are summed
up to each document, one random offset is added, and a document is emitted
once for each whole number that its stretch of the sum crosses: ``limit``
times at most. In order of size the documents that get a copy more are spread
over all sizes, so the words taken miss the target by little more than the
longest document.

Expected copies are whole multiples of 1 / ``UNIT`` and summed as decimals, so
neither the order of additions nor the number of tasks changes a result. The
offset is a hash of the seed and the source. Reruns agree.

Shape: equal rows are counted first, and runs of more than ``RUN`` cut, so
that no row stands for many. Sums run over ranges of rows, not over sources: a
source with a third of all rows is summed in as many tasks as it fills, and
the tasks' totals, one row for each task and source, are summed up in between.

Defined results: null sources are one source, last in order, apart from ``''``;
null and negative sizes count as 0; a source without any size has target 0
and no copies; repeated rows each get copies of their own (they are
interchangeable); an empty table gives no rows; a null key sorts first; input
columns named ``source_size``, ``target`` or ``copies`` are replaced.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daybook.session import remove_location, scratch_location

UNIT = 10**12
RUN = 4096
ADDED = ("source_size", "target", "copies")


def _stored(rows: DataFrame, at: str) -> DataFrame:
    rows.write.parquet(at)
    return rows.sparkSession.read.schema(rows.schema).parquet(at)


def _exact(c: Column) -> Column:
    return c.cast("decimal(38,0)")


def sums_before(rows: DataFrame, values: Sequence[str], order: Sequence[Column], at: str, within: Sequence[str] = ()) -> DataFrame:
    """``rows`` with ``before_<value>``: the sum over the rows that come earlier.

    ``within`` names columns without nulls whose groups are summed apart.
    The rows are laid out by ranges of (``within``, ``order``) below ``at``.
    """
    laid = rows.repartitionByRange(*(F.col(c) for c in within), *order).withColumn("_at", F.spark_partition_id())
    laid = _stored(laid, at)
    totals = laid.groupBy("_at", *within).agg(*(_exact(F.sum(v)).alias(f"_sum_{v}") for v in values))
    earlier = Window.partitionBy(*within).orderBy("_at")  # one row for each range that the group touches
    starts = totals.select(
        "_at", *within, *((_exact(F.sum(f"_sum_{v}").over(earlier)) - F.col(f"_sum_{v}")).alias(f"_start_{v}") for v in values)
    )
    inside = Window.partitionBy("_at", *within).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    own = laid.withColumns({f"_own_{v}": _exact(F.sum(v).over(inside)) - F.col(v) for v in values})
    joined = own.join(starts, ["_at", *within])
    return joined.select(
        *(F.col(f"`{c}`") for c in rows.columns),
        *(_exact(F.col(f"_start_{v}") + F.col(f"_own_{v}")).alias(f"before_{v}") for v in values),
    )


def source_targets(sources: DataFrame, weights: Sequence[int], limit: int, at: str) -> DataFrame:
    """From (_k, _source, _total) to these and ``target`` and ``_rate``, expected copies in units."""
    counted = sources.withColumn("_one", _exact(F.lit(1)))
    ranked = sums_before(counted, ["_one"], [F.col("_source").asc_nulls_last()], f"{at}/ranks")
    weight = F.element_at(F.array(*(F.lit(w) for w in weights)), (F.col("before__one") % len(weights)).cast("int") + 1)
    common = math.lcm(*weights)
    weighed = ranked.select("_k", "_source", "_total", _exact(weight).alias("_w"), F.col("before__one").alias("_rank"))
    until = [_exact(F.col("_total") * (F.lit(common) / F.col("_w")).cast("int")), F.col("_rank")]
    filled = sums_before(weighed, ["_total", "_w"], until, f"{at}/levels")
    whole = filled.agg(F.sum("_total"), F.sum("_w")).first()
    total, heavy = (F.lit(str(x or 0)).cast("decimal(38,0)") for x in whole)
    room = F.col("_total") * limit * (heavy - F.col("before__w"))
    capped = filled.withColumn("_capped", room <= F.col("_w") * (total - F.col("before__total") * limit))
    rest = capped.agg(F.sum(F.when(F.col("_capped"), F.col("_total"))), F.sum(F.when(~F.col("_capped"), F.col("_w")))).first()
    left = _exact(total - F.lit(str(rest[0] or 0)).cast("decimal(38,0)") * limit)
    shared = _exact(F.col("_w") * left)
    among = F.lit(str(rest[1] or 1)).cast("decimal(38,0)")
    target = F.when(F.col("_capped"), (F.col("_total") * limit).cast("double")).otherwise(
        shared.cast("double") / among.cast("double")
    )
    units = capped.withColumns({"_up": _exact(shared * UNIT), "_down": _exact(among * F.col("_total"))})
    rate = F.when(F.col("_total") == 0, F.lit(0).cast("long")).when(
        F.col("_capped"), F.lit(limit * UNIT).cast("long")
    ).otherwise(F.expr("_up div _down"))
    return units.select("_k", "_source", "_total", target.alias("target"), rate.alias("_rate"))


def mix(
    rows: DataFrame,
    source: str = "source",
    size: str = "size",
    key: str = "doc_id",
    weights: Sequence[int] = (5, 2, 1),
    limit: int = 3,
    seed: str = "mix",
) -> DataFrame:
    """``rows`` with their source's ``source_size`` and ``target`` and their own ``copies``.

    ``weights`` repeat over the sources in code point order. Equal rows are
    counted, so narrow the input to what the result needs.
    """
    spark = rows.sparkSession
    at = scratch_location(spark, "mix")
    columns = [F.col(f"`{c}`") for c in rows.columns]
    named = rows.select(
        F.struct(*columns).alias("_row"),
        F.coalesce(F.concat(F.lit("s"), F.col(source).cast("string")), F.lit("n")).alias("_k"),
        F.col(source).cast("string").alias("_source"),
        F.greatest(F.coalesce(F.col(size).cast("long"), F.lit(0)), F.lit(0)).alias("_size"),
    )
    runs = named.groupBy("_row", "_k", "_source", "_size").agg(F.count("*").alias("_all"))
    cut = runs.withColumn("_cut", F.explode(F.expr(f"sequence(0L, (_all - 1) div {RUN}L)")))
    cut = cut.withColumn("_n", F.least(F.lit(RUN), F.col("_all") - F.col("_cut") * RUN)).drop("_all")
    cut = _stored(cut, f"{at}/runs")
    sources = cut.groupBy("_k", "_source").agg(_exact(F.sum(F.col("_size") * F.col("_n"))).alias("_total"))
    targets = _stored(source_targets(sources, weights, limit, at), f"{at}/targets")

    rated = cut.join(targets.drop("_source"), "_k").withColumn("_expected", _exact(F.col("_rate") * F.col("_n")))
    order = [F.col("_size"), F.col(f"_row.`{key}`"), F.xxhash64("_row"), F.col("_cut")]
    summed = sums_before(rated, ["_expected"], order, f"{at}/rows", ["_k"])
    for part in ("runs", "ranks", "levels"):
        remove_location(spark, f"{at}/{part}")
    drawn = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), "_k")), 1, 8), 16, 10)
    summed = summed.withColumn("_drawn", _exact(_exact(drawn) * F.lit(UNIT)))  # the offset, times 2**32
    each = summed.withColumn("_offset", F.expr(f"_drawn div {1 << 32}L")).withColumn(
        "_i", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1))
    )
    begin = F.col("_offset") + F.col("before__expected") + F.col("_rate") * F.col("_i")
    each = each.withColumns({"_begin": _exact(begin), "_end": _exact(begin + F.col("_rate"))})
    return each.select(
        *(F.col(f"_row.`{c}`") for c in rows.columns if c not in ADDED),
        F.col("_total").cast("long").alias("source_size"),
        "target",
        F.expr(f"(_end div {UNIT}L) - (_begin div {UNIT}L)").alias("copies"),
    )


def emitted(mixed: DataFrame, copies: str = "copies") -> DataFrame:
    """The mix itself: each row as often as it has copies."""
    again = mixed.where(F.col(copies) > 0).withColumn("_again", F.explode(F.sequence(F.lit(1).cast("long"), F.col(copies).cast("long"))))
    return again.drop("_again", copies)
