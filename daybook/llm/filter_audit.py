"""Filter interaction audit: what each filter of every order of filters does.

Every filter has a relation of failing ids, stored as a table. From these:

* a filter's removals after a prefix are its failing ids left-anti joined to
  the prefix's relations. The relations are walked one after another; at each,
  every row also goes on with the prefix longer by that filter, and those rows
  are anti-joined to it. So one join for each filter serves all prefixes of all
  orders, as a prefix counts as a set: what filters remove together does not
  depend on their order;
* survivors of a prefix are the rows less the removals of its steps;
* redundancies are the filter's failing ids less its removals;
* label losses are the removals of ids that left-semi joins found in the labels.

Ids name rows by content (key, part, text digest), so equal rows share an id
and are counted, and null keys need no care in joins. A copy of an earlier
text is a failing id too: the anti join of all rows and, for each text, its
smallest key, on text and key; a text with a third of all rows is met once by
each task and never gathered.

Shape: whole texts are read once; ids go to the shared folder. All joins of
the walk are on the id, which is unique in each relation, so each relation is
shuffled once and no key is hot. A failing row becomes 16 rows at most for
five filters. Only counts by (part, filter, prefix) leave the executors.

Defined results: null texts are empty; null parts are the empty string; a null
key is never a copy and has no copies; of equal keys with equal text neither is
the smaller; a key counts as labelled if any of its label rows says so; an
empty table gives no rows; filters that nothing fails have zeros.
"""

from __future__ import annotations

from collections.abc import Mapping
from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from daybook.session import checkpoint_dir, remove_location, scratch_location

#: The name under which a filter asks for rows whose text stands under a smaller key.
COPY = "copy"
WORD = r"[^\x20\x09-\x0D]+"


def _stored(rows: DataFrame, at: str) -> DataFrame:
    rows.write.parquet(at)
    return rows.sparkSession.read.schema(rows.schema).parquet(at)


def _marked(rows: DataFrame, labels: DataFrame, on: str, name: str) -> DataFrame:
    """``rows`` with ``name``: 1 where a semi join finds the key in ``labels``."""
    found = rows.join(labels, on, "left_semi").withColumn(name, F.lit(1))
    return found.unionByName(rows.join(labels, on, "left_anti").withColumn(name, F.lit(0)))


def failing_ids(
    docs: DataFrame, filters: Mapping[str, Column | str], labels: Mapping[str, DataFrame], key: str, text: str, part: str, at: str
) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Rows of each part (part, _n), and for each filter its failing ids with the labels' columns.

    A filter is a condition over ``text`` (as column ``_text``), or ``COPY``.
    """
    named = docs.select(
        F.col(key).alias("_key"),
        F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        F.coalesce(F.col(text), F.lit("")).alias("_text"),
    )
    digest = F.unhex(F.sha2("_text", 256))
    own = F.coalesce(F.concat(F.lit("k"), F.col("_key").cast("string")), F.lit("n"))
    fails = {f"_f{i}": F.lit(False) if isinstance(c, str) else c for i, c in enumerate(filters.values())}
    rows = named.select("_key", "part", digest.alias("_digest"), *(c.alias(n) for n, c in fails.items()))
    rows = rows.groupBy(*rows.columns).agg(F.count("*").alias("_n"))
    sized = F.concat_ws(":", F.length(own).cast("string"), own, F.length("part").cast("string"), "part", F.hex("_digest"))
    rows = _stored(rows.withColumn("_id", F.unhex(F.md5(sized))), f"{at}/rows")

    firsts = rows.where(F.col("_key").isNotNull()).groupBy("_digest").agg(F.min("_key").alias("_key"))
    copies = rows.where(F.col("_key").isNotNull()).join(firsts, ["_digest", "_key"], "left_anti")
    tables = {}
    for i, (name, condition) in enumerate(filters.items()):
        failing = copies if isinstance(condition, str) else rows.where(f"_f{i}")
        failing = failing.select("_id", "_key", "part", "_n")
        for label, keys in labels.items():
            failing = _marked(failing, keys.select(F.col(keys.columns[0]).alias("_key")), "_key", label)
        tables[name] = _stored(failing.drop("_key"), f"{at}/fails-{i}")
    return rows.groupBy("part").agg(F.sum("_n").alias("_n")), tables


def removals(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(_f, _prefix, ...): what is left of filter ``_f``'s failing ids after the filters in ``_prefix`` (bits)."""
    state = None
    for i, table in enumerate(tables.values()):
        rows = table.withColumns({"_f": F.lit(i), "_prefix": F.lit(0)})
        state = rows if state is None else state.unionByName(rows)
    for i, table in enumerate(tables.values()):
        bit = 1 << i
        both = F.when(F.col("_f") == i, F.array("_prefix")).otherwise(F.array("_prefix", F.col("_prefix") + bit))
        state = state.withColumn("_prefix", F.explode(both)).alias("s")
        after = F.col("s._prefix").bitwiseAND(bit) != 0
        state = state.join(table.select("_id").alias("t"), (F.col("s._id") == F.col("t._id")) & after, "left_anti")
    return state


def _orders(spark: SparkSession, names: list[str]) -> DataFrame:
    """Every order's steps: filter_order, step, _f and the bits of the filters before it."""
    rows = []
    for order in permutations(range(len(names))):
        for step, f in enumerate(order, 1):
            rows.append(("".join(names[g] for g in order), step, f, sum(1 << g for g in order[: step - 1])))
    return spark.createDataFrame(rows, "filter_order string, step int, _f int, _prefix int")


def audit(
    docs: DataFrame,
    filters: Mapping[str, Column | str],
    good: DataFrame,
    toxic: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    part: str = "source",
) -> DataFrame:
    """One row for each part, order of the filters and step.

    ``good`` and ``toxic`` hold keys in their first column. The orders are all
    permutations, so keep the filters few; they do not grow with the data.
    """
    spark = docs.sparkSession
    checkpoint_dir(spark)
    names = list(filters)
    at = scratch_location(spark, "audit")
    totals, tables = failing_ids(docs, filters, {"_good": good, "_toxic": toxic}, key, text, part, at)
    counted = removals(tables).groupBy("part", "_f", "_prefix").agg(
        F.sum("_n").alias("removed"),
        F.sum(F.col("_n") * F.col("_good")).alias("good_lost"),
        F.sum(F.col("_n") * F.col("_toxic")).alias("toxic_lost"),
    )
    pairs = [(f, s) for f in range(len(names)) for s in range(1 << len(names)) if not s >> f & 1]
    grid = totals.withColumn(
        "_pair", F.explode(F.array(*(F.struct(F.lit(f).alias("_f"), F.lit(s).alias("_prefix")) for f, s in pairs)))
    ).select("part", "_n", "_pair._f", "_pair._prefix")
    cells = grid.join(counted, ["part", "_f", "_prefix"], "left").fillna(0, ["removed", "good_lost", "toxic_lost"])
    # So many orders have the filters of the prefix first, then this one.
    ways = [factorial(n) * factorial(len(names) - 1 - n) for n in range(len(names))]
    weight = F.element_at(F.array(*(F.lit(w) for w in ways)), F.bit_count("_prefix") + 1)
    own = Window.partitionBy("part", "_f")
    after_all = F.bit_count("_prefix") == len(names) - 1
    cells = cells.withColumns(
        {
            "_failing": F.max(F.when(F.col("_prefix") == 0, F.col("removed"))).over(own),
            "unique_fails": F.max(F.when(after_all, F.col("removed"))).over(own),
            "shapley": F.sum(F.col("removed") * weight).over(own),
        }
    )
    # The counts of one prefix hold for all orders that start with it.
    steps = cells.join(F.broadcast(_orders(spark, names)), ["_f", "_prefix"])
    so_far = Window.partitionBy("part", "filter_order").orderBy("step")
    out = steps.select(
        "part",
        "filter_order",
        "step",
        (F.col("_n") - F.sum("removed").over(so_far)).alias("kept"),
        "removed",
        (F.col("_failing") - F.col("removed")).alias("redundant"),
        "unique_fails",
        "good_lost",
        "toxic_lost",
        "shapley",
    )
    try:
        return out.checkpoint()
    finally:
        remove_location(spark, at)
