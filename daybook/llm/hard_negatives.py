"""Hard-negative mining by best-first search of STR-packed R-trees.

For an anchor, its ``positives`` best rows of the same label come first; for
each of them, the ``negatives`` best rows of other labels whose score lies in a
window below the positive's score.

The forest: vectors are cut into slabs by the coordinate that varies most and
each slab into tiles by the next one (range partitioning), about ``group``
vectors a tile. A task packs each of its tiles by sort-tile-recursive over more
coordinates into leaf pages and boxes of boxes (``Forest``). A box bounds the
inner product with a query from both sides, coordinate by coordinate. The queue
hands out the box with the greatest upper bound; a box is left aside if its
interval misses all windows or lies strictly below the k-th best of each; pages
that remain are verified by exact products.

Between tiles the same bounds are taken over at most ``BOXES`` boxes of whole
tiles, the only thing that is broadcast: an anchor is sent to a tile only if
some window asks for it. It searches its own tile first, which gives the score
that other tiles have to reach. Anchors travel as rows next to the tiles' rows
and are searched as they stream by; nothing but a tile is held in memory, and
no vectors reach the driver.

Components are floor(scale * x), held at +-1e300. Products below 2**52 are exact in floating
point, larger ones are taken in whole numbers and held at +-(2**63 - 1).

Defined results: rows without id, label or vector, or with a null or
non-finite component, take no part; missing components of shorter vectors are
0, so an empty vector scores 0; an anchor meets every row but its own, also
those that share its id, and anchors that share an id each return rows; ties
go to the smaller id; an anchor without positives, and a positive without
negatives, return no row; an empty table gives no rows.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daybook.session import checkpoint_dir, remove_location, scratch_location

BOXES = 4096
PAGE = 64
FANOUT = 16
MARGIN = 1e-9
FAR = (1 << 63) - 1
LARGEST = 1e300
#: (name, type) of what goes to a task: a tile's rows (kind 0), then the anchors that search it (kind 1).
_STREAM = (
    "tile int, kind int, row bigint, id bigint, label bigint, v array<double>, "
    "tags array<int>, scores array<bigint>, beat bigint"
)
_FOUND = "anchor bigint, tag int, row bigint, id bigint, score bigint"


def pack(vectors: np.ndarray, page: int = PAGE) -> np.ndarray:
    """Sort-tile-recursive order: slabs by one coordinate, each cut again by the next."""
    pages = max(1, -(-len(vectors) // page))
    turns = max(1, min(vectors.shape[1], math.ceil(math.log2(pages) / 2))) if vectors.shape[1] else 0
    with np.errstate(over="ignore", invalid="ignore"):
        axes = np.argsort(-vectors.var(0), kind="stable")[:turns]

    def tile(rows: np.ndarray, left: list[int]) -> list[np.ndarray]:
        if not left or len(rows) <= page:
            return [rows]
        rows = rows[np.argsort(vectors[rows, left[0]], kind="stable")]
        slabs = math.ceil((len(rows) / page) ** (1 / len(left)))
        width = page * math.ceil(len(rows) / page / slabs)
        return [t for at in range(0, len(rows), width) for t in tile(rows[at : at + width], left[1:])]

    return np.concatenate(tile(np.arange(len(vectors)), axes.tolist())) if len(vectors) else np.zeros(0, int)


def interval(low: np.ndarray, high: np.ndarray, query: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest inner product of ``query`` with a point of each box, loosened for rounding."""
    up, down = np.maximum(query, 0), np.minimum(query, 0)
    with np.errstate(over="ignore", invalid="ignore"):
        slack = MARGIN * (np.maximum(np.abs(low), np.abs(high)) @ np.abs(query))
        least, most = low @ up + high @ down - slack, high @ up + low @ down + slack
    # Beyond doubles nothing is known of a box.
    return np.where(np.isnan(least), -np.inf, least), np.where(np.isnan(most), np.inf, most)


class Forest:
    """A packed R-tree over one tile."""

    def __init__(self, rows, ids, labels, vectors, page: int = PAGE, fanout: int = FANOUT):
        order = pack(vectors, page)
        self.rows, self.ids, self.labels, self.vectors = rows[order], ids[order], labels[order], vectors[order]
        self.starts = np.arange(0, len(order), page)
        self.page, self.fanout = page, fanout
        with np.errstate(over="ignore"):
            self.longest = float(np.sqrt((vectors * vectors).sum(1).max())) if len(order) else 0.0
        self.levels = []
        if len(order):
            boxes = np.minimum.reduceat(self.vectors, self.starts), np.maximum.reduceat(self.vectors, self.starts)
            while True:
                self.levels.append(boxes)
                if len(boxes[0]) <= fanout:
                    break
                at = np.arange(0, len(boxes[0]), fanout)
                boxes = np.minimum.reduceat(boxes[0], at), np.maximum.reduceat(boxes[1], at)
        self.opened = 0

    def _scores(self, begin: int, query: np.ndarray, exact: bool) -> np.ndarray:
        page = self.vectors[begin : begin + self.page]
        if exact:
            return (page @ query).astype(np.int64)
        whole = [int(x) for x in query]
        sums = (sum(a * int(b) for a, b in zip(whole, row, strict=True)) for row in page)
        return np.array([max(-FAR, min(FAR, s)) for s in sums], np.int64)

    def search(self, query, row: int, label: int, same: bool, windows: list[tuple[int, int]], k: int, beat: int | None):
        """For each window (least and greatest score): the k best (-score, id, row), best first."""
        best: list[list[tuple[int, int, int]]] = [[] for _ in windows]
        if not self.levels or not windows:
            return best
        need = [max(low, -FAR if beat is None else beat) for low, _ in windows]
        highs = np.array([float(h) for _, h in windows])
        needs = np.array([float(n) for n in need])
        with np.errstate(over="ignore"):
            exact = float(np.sqrt(query @ query)) * self.longest < 2**52
        heap: list[tuple[float, int, int]] = []

        def offer(level: int, begin: int, end: int) -> None:
            low, high = (b[begin:end] for b in self.levels[level])
            least, most = interval(low, high, query)
            wanted = ((most[:, None] >= needs) & (least[:, None] <= highs)).any(1)
            for i in np.flatnonzero(wanted).tolist():
                heapq.heappush(heap, (-float(most[i]), level, begin + i))

        offer(len(self.levels) - 1, 0, len(self.levels[-1][0]))
        while heap:
            most, level, at = heapq.heappop(heap)
            if -most < needs.min():
                break  # strictly below the k-th best of every window
            if level:
                offer(level - 1, at * self.fanout, (at + 1) * self.fanout)
                continue
            self.opened += 1
            begin = at * self.page
            scores = self._scores(begin, query, exact)
            page = slice(begin, begin + self.page)
            allowed = ((self.labels[page] == label) == same) & (self.rows[page] != row)
            for w, (_, high) in enumerate(windows):
                hits = np.flatnonzero(allowed & (scores >= need[w]) & (scores <= high))
                if not len(hits):
                    continue
                new = zip((-scores[hits]).tolist(), self.ids[page][hits].tolist(), self.rows[page][hits].tolist(), strict=True)
                best[w] = heapq.nsmallest(k, [*best[w], *new])
                if len(best[w]) == k:
                    need[w] = max(need[w], -best[w][-1][0])
                    needs[w] = float(need[w])
        return best


def _matrix(lists: pa.Array, width: int) -> np.ndarray:
    sizes = np.diff(lists.offsets.to_numpy())
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(sizes), width))
    out[np.arange(width) < sizes[:, None]] = flat
    return out


def _searcher(width: int, k: int, same: bool, share: tuple[int, int]):
    """Runs over (tile, kind, row): keeps a tile's rows, then lets each anchor search them."""
    lower, upper = share

    def asked(r: dict) -> tuple[list, list]:
        if r["tags"] is None:
            return [0], [(-FAR, FAR)]
        # lower * positive <= 100 * negative <= upper * positive
        return r["tags"], [(-(-lower * s // 100), upper * s // 100) for s in r["scores"]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        tile, forest = None, None
        out: list[tuple] = []
        for batch in batches:
            tiles, kinds = batch.column("tile").to_numpy(), batch.column("kind").to_numpy()
            cuts = np.flatnonzero((np.diff(tiles) != 0) | (np.diff(kinds) != 0)) + 1
            edges = [0, *cuts.tolist(), len(tiles)]
            for begin, end in zip(edges, edges[1:], strict=False):
                if begin == end:
                    continue
                part = batch.slice(begin, end - begin)
                if tiles[begin] != tile:
                    tile, held, forest = tiles[begin], [], None
                rows, ids, labels = (part.column(c).to_numpy() for c in ("row", "id", "label"))
                vectors = _matrix(part.column("v"), width)
                if kinds[begin] == 0:
                    held.append((rows, ids, labels, vectors))
                    continue
                if forest is None:
                    none = np.zeros(0, np.int64)
                    forest = Forest(*map(np.concatenate, zip(*held, strict=True))) if held else Forest(none, none, none, vectors[:0])
                    held = []
                for i, r in enumerate(part.select(["tags", "scores", "beat"]).to_pylist()):
                    tags, windows = asked(r)
                    found = forest.search(vectors[i], int(rows[i]), int(labels[i]), same, windows, k, r["beat"])
                    out.extend((int(rows[i]), t, row, id_, -s) for t, best in zip(tags, found, strict=True) for s, id_, row in best)
                    if len(out) > 50_000:
                        yield packed(out)
                        out = []
        yield packed(out)

    def packed(out: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*out, strict=True)) or [()] * 5
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["anchor", "tag", "row", "id", "score"]
        )

    return run


def _probe(tiles: DataFrame, probes: DataFrame, width: int, k: int, same: bool, share: tuple[int, int]) -> DataFrame:
    """What each probe finds in its tile: ``_FOUND`` rows, k for each anchor, tag and tile at most."""
    nothing = {"tags": "array<int>", "scores": "array<bigint>", "beat": "bigint"}

    def as_stream(rows: DataFrame, kind: int) -> DataFrame:
        rows = rows.withColumn("kind", F.lit(kind))
        rows = rows.withColumns({c: F.lit(None).cast(t) for c, t in nothing.items() if c not in rows.columns})
        return rows.select(*(f.split()[0] for f in _STREAM.split(", ")))

    both = as_stream(tiles, 0).unionByName(as_stream(probes, 1))
    dealt = both.repartition("tile").sortWithinPartitions("tile", "kind", "row")
    return dealt.mapInArrow(_searcher(width, k, same, share), _FOUND)


def _worth(anchors: DataFrame, boxes, width: int, share: tuple[int, int], skip_own: bool) -> DataFrame:
    """``anchors`` once for each tile whose box can hold something they ask for, with its ``tile``."""
    lower, upper = share
    schema = anchors.drop("tile").schema
    kept = anchors.sparkSession.sparkContext.broadcast(boxes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low, high, first, last = kept.value
        for batch in batches:
            vectors = _matrix(batch.column("v"), width)
            home = batch.column("tile").to_numpy()
            for i, r in enumerate(batch.select(["scores", "beat"]).to_pylist()):
                least, most = interval(low, high, vectors[i])
                if r["scores"] is None:
                    hit = most >= (-FAR if r["beat"] is None else r["beat"])
                else:
                    hit = np.zeros(len(low), bool)
                    for s in r["scores"]:
                        hit |= (most >= -(-lower * s // 100)) & (least <= upper * s // 100)
                tiles = [t for b in np.flatnonzero(hit) for t in range(first[b], last[b] + 1) if not (skip_own and t == home[i])]
                # A slice for each tile would copy the vector: take() repeats the row once, a batch at a time.
                for at in range(0, len(tiles), 1000):
                    some = tiles[at : at + 1000]
                    again = batch.take(pa.array([i] * len(some)))
                    yield pa.RecordBatch.from_arrays(
                        [*(again.column(f.name) for f in schema), pa.array(some, pa.int32())], [*(f.name for f in schema), "tile"]
                    )

    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema)
    return anchors.mapInArrow(run, f"{columns}, tile int")


def whole_vectors(vectors: DataFrame, is_anchor: Column, vec_id: str, embedding: str, label: str, scale: int) -> DataFrame:
    """(id, label, v, anchor) of the rows that take part; v holds whole numbers as doubles."""
    x = F.transform(F.col(embedding), lambda c: c.cast("double"))
    good = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return vectors.where(F.col(vec_id).isNotNull() & F.col(label).isNotNull() & F.col(embedding).isNotNull() & good).select(
        F.col(vec_id).cast("long").alias("id"),
        F.col(label).cast("long").alias("label"),
        # floor() of a double is a bigint; these stay doubles, whatever their size
        F.transform(x, lambda c: F.when(F.abs(c) < 2**40, F.floor(c * scale).cast("double")).otherwise(
            F.greatest(F.least(c * scale, F.lit(LARGEST)), F.lit(-LARGEST))
        )).alias("v"),
        F.coalesce(is_anchor, F.lit(False)).alias("anchor"),
    )


def _tiles(rows: DataFrame, at: str, group: int) -> tuple[DataFrame, int]:
    """The rows laid out by tile, with ``tile`` and ``row``; and the longest vector's width."""
    n, width = rows.agg(F.count("*"), F.max(F.size("v"))).first()
    width = width or 0
    coordinate = [F.coalesce(F.get("v", F.lit(i)), F.lit(0.0)) for i in range(width)]
    spread = rows.agg(*(F.var_pop(c) for c in coordinate)).first() if n and width else ()
    axes = sorted(range(width), key=lambda i: (-(spread[i] or 0), i))[:2]
    parts = max(1, -(-n // group))
    order: list[Column] = []
    if axes and parts > 1:
        slabs = math.ceil(math.sqrt(parts))
        marks = [i / slabs for i in range(1, slabs)]
        cuts = rows.agg(F.percentile_approx(coordinate[axes[0]], marks)).first()[0]
        cuts = F.array(*(F.lit(float(c)) for c in cuts))
        order = [F.size(F.filter(cuts, lambda c: c < coordinate[axes[0]])), coordinate[axes[-1]]]
    # Equal vectors, however many, are spread by id and label.
    laid = rows.repartitionByRange(parts, *order, F.col("id"), F.col("label"))
    laid = laid.withColumns({"tile": F.spark_partition_id(), "row": F.monotonically_increasing_id()})
    laid.write.parquet(at)
    return rows.sparkSession.read.schema(laid.schema).parquet(at), width


def _boxes(tiles: DataFrame, width: int):
    """Boxes over runs of whole tiles, ``BOXES`` at most: low, high, first and last tile."""
    last = tiles.agg(F.max("tile")).first()[0]
    if last is None:
        return np.zeros((0, width)), np.zeros((0, width)), [], []
    run = -(-(last + 1) // BOXES)
    part = [F.coalesce(F.get("v", F.lit(i)), F.lit(0.0)) for i in range(width)]
    rows = tiles.groupBy(F.expr(f"tile div {run}").alias("box")).agg(
        F.min("tile").alias("first"),
        F.max("tile").alias("last"),
        F.array(*(F.min(c) for c in part)).cast("array<double>").alias("low"),
        F.array(*(F.max(c) for c in part)).cast("array<double>").alias("high"),
    ).collect()
    shape = (len(rows), width)
    low, high = (np.array([r[c] for r in rows], float).reshape(shape) for c in ("low", "high"))
    return low, high, [r["first"] for r in rows], [r["last"] for r in rows]


def mine(
    vectors: DataFrame,
    is_anchor: Column,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    label: str = "label",
    positives: int = 5,
    negatives: int = 5,
    share: tuple[int, int] = (80, 100),
    scale: int = 256,
    group: int = 32768,
) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank``, ``negative_id`` and both scores.

    ``share`` is the window in hundredths of the positive's score, ``group``
    the vectors that a task holds at once.
    """
    spark = vectors.sparkSession
    checkpoint_dir(spark)
    at = scratch_location(spark, "negatives")

    def stored(rows: DataFrame, name: str) -> DataFrame:
        rows.write.parquet(f"{at}/{name}")
        return spark.read.schema(rows.schema).parquet(f"{at}/{name}")

    try:
        tiles, width = _tiles(whole_vectors(vectors, is_anchor, vec_id, embedding, label, scale), f"{at}/tiles", group)
        boxes = _boxes(tiles, width)
        anchors = tiles.where("anchor").drop("anchor")
        rank = Window.partitionBy("anchor", "tag").orderBy(F.desc("score"), "id", "row")

        own = stored(_probe(tiles, anchors, width, positives, True, share), "own")
        reached = own.groupBy("anchor").agg(F.when(F.count("*") == positives, F.min("score")).alias("beat"))
        known = anchors.join(reached.withColumnRenamed("anchor", "row"), "row", "left")
        known = known.withColumn("scores", F.lit(None).cast("array<bigint>"))
        others = _probe(tiles, _worth(known, boxes, width, share, True), width, positives, True, share)
        near = own.unionByName(others).withColumn("tag", F.row_number().over(rank)).where(F.col("tag") <= positives)
        near = stored(near.select("anchor", "tag", "id", "score"), "positives")

        asked = near.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("tag", "score"))).alias("p"))
        asked = asked.select(F.col("anchor").alias("row"), F.col("p.tag").alias("tags"), F.col("p.score").alias("scores"))
        windows = anchors.join(asked, "row").withColumn("beat", F.lit(None).cast("bigint"))
        found = _probe(tiles, _worth(windows, boxes, width, share, False), width, negatives, False, share)
        found = found.withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= negatives)
        pairs = near.select("anchor", "tag", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
        out = found.join(pairs, ["anchor", "tag"]).join(anchors.select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id")), "anchor")
        return out.select(
            "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
        ).checkpoint()
    finally:
        remove_location(spark, at)
