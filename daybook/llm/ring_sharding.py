"""Sharding by a consistent-hash ring with virtual nodes and bounded loads.

Every shard stands at ``vnodes`` places of a ring of 2**16 cells; a key
belongs to the next place clockwise, its home arc. No shard takes more than
its share: ``n // shards`` rows, one more for the first ``n % shards``. What
does not fit at home continues clockwise to the next shard with room. As the
shares add up to ``n``, all shards end full, so counts differ by one at most,
and only the rows above a full shard's share leave their home.

The rows themselves are never gathered: equal keys are counted first, each
arc is cut into ``parts`` by a hash, and ranks come from counts of
(arc, part) plus a window inside a part. The placing of overflow works on
the arcs' counts alone, ``shards * vnodes`` numbers whatever the input.

Defined results: repeated rows each get a slot of their own (they are
interchangeable); a null key counts as a key and is spread by the other
columns; an empty table gives no rows; with fewer rows than shards, some
shards are empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

CELL_BITS = 16
#: Rows that one array gives out where a row is repeated.
PIECE = 1 << 16


def ring_arcs(spark, shards: int, vnodes: int) -> DataFrame:
    """Places in clockwise order: arc number, shard, and the cells that belong to it."""
    places = (
        spark.range(shards)
        .select(F.col("id").cast("int").alias("shard"))
        .withColumn("_v", F.explode(F.sequence(F.lit(0), F.lit(vnodes - 1))))
        .withColumn("_h", F.xxhash64(F.lit("ring"), "shard", "_v"))
        .withColumn("_cell", F.shiftrightunsigned("_h", 64 - CELL_BITS).cast("int"))
        .groupBy("_cell")
        .agg(F.min_by("shard", F.struct("_h", "shard")).alias("shard"))
    )
    clockwise = Window.orderBy("_cell")
    last = F.lit((1 << CELL_BITS) - 1)
    placed = places.select(
        (F.row_number().over(clockwise) - 1).alias("arc"),
        "shard",
        "_cell",
        F.lag("_cell", 1, -1).over(clockwise).alias("_before"),
        F.max("_cell").over(Window.partitionBy()).alias("_end"),
    )
    own = F.sequence(F.col("_before") + 1, F.col("_cell"))
    wrapped = F.when((F.col("arc") == 0) & (F.col("_end") < last), F.sequence(F.col("_end") + 1, last))
    return placed.select("arc", "shard", F.concat(own, F.coalesce(wrapped, F.array().cast("array<int>"))).alias("cells"))


# Walks the arcs that overflow; each hands its surplus to the shards in the
# order in which they come clockwise, as far as they have room.
_PLACE = """aggregate(
  over,
  named_struct('free', free, 'out', cast(array() as array<struct<arc:int,shard:int,n:bigint>>)),
  (st, a) -> aggregate(
    a.walk,
    named_struct('rem', a.n, 'free', st.free, 'out', st.out),
    (s, w) -> if(s.rem > 0 and s.free[w] > 0,
      named_struct(
        'rem', s.rem - least(s.rem, s.free[w]),
        'free', transform(s.free, (x, i) -> if(i = w, x - least(s.rem, s.free[w]), x)),
        'out', concat(s.out, array(named_struct('arc', a.arc, 'shard', w, 'n', least(s.rem, s.free[w]))))),
      s),
    s -> named_struct('free', s.free, 'out', s.out)),
  st -> st.out)"""

# For each arc that overflows: its surplus, and the shards by distance clockwise.
_WALKS = """transform(
  filter(arcs, a -> a.n > a.home),
  a -> named_struct('arc', a.arc, 'n', a.n - a.home, 'walk', transform(
    array_sort(transform(stands, s -> named_struct(
      'far', coalesce(array_min(filter(s.at, x -> x > a.arc)), array_min(s.at) + size(arcs)), 'shard', s.shard))),
    s -> s.shard)))"""


def ring_segments(arcs: DataFrame, shards: int) -> DataFrame:
    """From (arc, shard, n) to runs of ranks: arc, start, end, shard, first slot.

    ``arcs`` has one row for each place of the ring, those without rows too.
    """
    per_shard = Window.partitionBy("shard").orderBy("arc")
    whole = Window.partitionBy()
    homes = (
        arcs.withColumn("_total", F.sum("n").over(whole))
        .withColumn("_share", F.expr(f"_total div {shards}") + (F.col("shard") < F.col("_total") % shards).cast("long"))
        .withColumn("_before", F.sum("n").over(per_shard) - F.col("n"))
        .withColumn("home", F.greatest(F.lit(0).cast("long"), F.least("n", F.col("_share") - F.col("_before"))))
    )
    by_shard = homes.groupBy("shard").agg(
        (F.max("_share") - F.sum("home")).alias("_free"),
        F.sort_array(F.collect_list("arc")).alias("at"),
        F.collect_list(F.struct("arc", "shard", "n", "home")).alias("_arcs"),
    )
    # One row: as long as the ring has places, however many rows there are.
    ring = by_shard.agg(
        F.sort_array(F.flatten(F.collect_list("_arcs"))).alias("arcs"),
        F.collect_list(F.struct("shard", "at")).alias("stands"),
        F.map_from_entries(F.collect_list(F.struct("shard", "_free"))).alias("_room"),
    )
    free = F.transform(
        F.sequence(F.lit(0), F.lit(shards - 1)), lambda s: F.coalesce(F.element_at("_room", s), F.lit(0).cast("long"))
    )
    placed = ring.withColumn("free", free).withColumn("over", F.expr(_WALKS)).withColumn("placed", F.expr(_PLACE))
    at_home = F.expr("transform(arcs, a -> named_struct('arc', a.arc, 'shard', a.shard, 'n', a.home))")
    runs = (
        placed.select(F.posexplode(F.concat(at_home, F.col("placed"))).alias("_i", "_s"))
        .select("_i", "_s.arc", "_s.shard", "_s.n")
        .where(F.col("n") > 0)
    )
    in_arc = Window.partitionBy("arc").orderBy("_i")
    in_shard = Window.partitionBy("shard").orderBy("_i")
    return runs.select(
        "arc",
        "shard",
        (F.sum("n").over(in_arc) - F.col("n")).alias("_start"),
        F.sum("n").over(in_arc).alias("_end"),
        (F.sum("n").over(in_shard) - F.col("n")).alias("_slot"),
    )


def shard_rows(rows: DataFrame, key: str, shards: int, vnodes: int = 64, parts: int = 64) -> DataFrame:
    """``rows`` with ``home_shard``, ``shard`` and ``slot`` (gapless from 0 in each shard).

    Equal rows are counted before anything else, so narrow the input to what
    the result needs. Broadcast: 2**16 cells, at most
    ``shards * (vnodes + 1)`` runs and ``shards * vnodes * parts`` starts.
    """
    spark = rows.sparkSession
    columns = [c for c in rows.columns if c not in ("home_shard", "shard", "slot")]
    ring = ring_arcs(spark, shards, vnodes)
    cells = ring.select("arc", F.col("shard").alias("home_shard"), F.explode("cells").alias("_cell"))
    spread = F.xxhash64(F.lit("part"), *(F.col(f"`{c}`") for c in columns))
    hashed = F.when(F.col(key).isNull(), spread).otherwise(F.xxhash64(F.lit("key"), F.col(key)))
    counted = (
        rows.groupBy(*(F.col(f"`{c}`") for c in columns))
        .agg(F.count("*").alias("_n"))
        .withColumn("_cell", F.shiftrightunsigned(hashed, 64 - CELL_BITS).cast("int"))
        .withColumn("_spread", spread)
        .withColumn("_part", F.pmod("_spread", F.lit(parts)).cast("int"))
        .join(F.broadcast(cells), "_cell")
    )
    per_part = counted.groupBy("arc", "_part").agg(F.sum("_n").alias("n"))
    part_starts = per_part.select(
        "arc", "_part", (F.sum("n").over(Window.partitionBy("arc").orderBy("_part")) - F.col("n")).alias("_first")
    )
    arc_counts = ring.select("arc", "shard").join(
        per_part.groupBy("arc").agg(F.sum("n").alias("n")), "arc", "left"
    )
    runs = ring_segments(arc_counts.fillna(0, ["n"]), shards).withColumnRenamed("arc", "_arc")
    inside = Window.partitionBy("arc", "_part").orderBy("_spread", *(F.col(f"`{c}`") for c in columns))
    ranked = counted.join(F.broadcast(part_starts), ["arc", "_part"]).withColumn(
        "_to", F.col("_first") + F.sum("_n").over(inside)
    )
    ranked = ranked.withColumn("_from", F.col("_to") - F.col("_n"))
    placed = ranked.join(
        F.broadcast(runs),
        (F.col("arc") == F.col("_arc")) & (F.col("_from") < F.col("_end")) & (F.col("_to") > F.col("_start")),
    )
    # In two steps, so that no array is as long as a row is repeated.
    first, last = F.greatest("_from", "_start"), F.least("_to", "_end") - 1
    pieces = placed.withColumns(
        {"_last": last, "_piece": F.explode(F.sequence(first, last, F.lit(PIECE).cast("long")))}
    )
    ranks = F.sequence(F.col("_piece"), F.least(F.col("_piece") + (PIECE - 1), F.col("_last")))
    return pieces.select(
        *(F.col(f"`{c}`") for c in columns), "home_shard", "shard", "_slot", "_start", F.explode(ranks).alias("_rank")
    ).select(
        *(F.col(f"`{c}`") for c in columns),
        "home_shard",
        "shard",
        (F.col("_slot") + F.col("_rank") - F.col("_start")).alias("slot"),
    )
