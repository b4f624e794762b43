"""Exact top-k inner products by norm-bucketed retrieval.

Candidates are dealt out by length (longest first), and a task cuts its part
into buckets of ``bucket`` vectors of like length. For a query and a bucket,
the score to beat divided by both lengths is the local cosine threshold:

* above 1: no vector of the bucket can win;
* from ``coordinate_from`` on: coordinate pruning. A vector at least that
  close to the query lies within a known distance of it in each coordinate;
  the query's ``focus`` largest coordinates are checked;
* below: length pruning. Vectors shorter than the score to beat divided by
  the query's length cannot win.

What remains is verified by integer products. The score to beat starts from
the best among the ``seeds`` longest vectors and rises in each task. Every
bound is loosened by a margin for rounding, so results are exact.

Vectors are laid out in tiles of about ``tile`` rows, ordered by length. Queries
travel as rows next to the tiles' rows, each to the tiles whose longest vector
can reach its score to beat, and are searched in blocks of ``block`` rows as they
stream by. A task holds one tile; each tile returns k rows for a query at most,
and a window ranks them. On the driver are the ``seeds`` vectors and the longest
lengths of at most ``RUNS`` runs of tiles, whatever the number of queries.

Components are floor(scale * x), held at +-1e150. Products below 2**52 are exact
in floating point; larger ones are taken in whole numbers and held at
+-(2**63 - 1).

Defined results: vectors that are null, empty, or hold a null or non-finite
component take no part, nor do null ids; missing components of shorter vectors
count as 0; a query meets every row but its own, also those that share its id,
and each row of a repeated query id is searched; ties go to the smaller id.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daybook.session import checkpoint_dir, remove_location, scratch_location

MARGIN = 1e-9
FAR = (1 << 63) - 1
LARGEST = 1e150
RUNS = 4096
_STREAM = "tile int, kind int, row bigint, id bigint, v array<double>, square double, beat double"


def whole_numbers(vectors: DataFrame, vec_id: str, embedding: str, scale: int, is_query: Column) -> DataFrame:
    """``id``, ``v`` (floor of scale times each component, as doubles), ``square`` and ``query`` of vectors that take part."""
    x = F.transform(F.col(embedding), lambda c: c.cast("double"))
    good = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    usable = vectors.where(F.col(vec_id).isNotNull() & (F.size(embedding) > 0) & good)
    # floor() of a double is a bigint; larger ones are whole already.
    numbers = F.transform(
        x,
        lambda c: F.when(F.abs(c) < 2**40, F.floor(c * scale).cast("double")).otherwise(
            F.greatest(F.least(c * scale, F.lit(LARGEST)), F.lit(-LARGEST))
        ),
    )
    square = F.aggregate("v", F.lit(0.0), lambda s, c: s + c * c)
    columns = F.col(vec_id).cast("long").alias("id"), numbers.alias("v"), F.coalesce(is_query, F.lit(False)).alias("query")
    return usable.select(*columns).withColumn("square", square)


def _matrix(lists: pa.Array, width: int) -> np.ndarray:
    sizes = np.diff(lists.offsets.to_numpy())
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    if len(sizes) and (sizes == width).all():
        return flat.reshape(-1, width)
    out = np.zeros((len(sizes), width))
    out[np.arange(width) < sizes[:, None]] = flat
    return out


def _products(a: np.ndarray, b: np.ndarray, largest: float) -> np.ndarray:
    """Exact products; in floating point where every partial sum is below 2**53, else held at +-``FAR``."""
    if largest < 2**52:
        return (a.astype(np.float64) @ b.astype(np.float64)).astype(np.int64)
    whole = [np.array([int(v) for v in x.ravel()], object).reshape(x.shape) for x in (a, b)]
    exact = whole[0] @ whole[1]
    return np.array([max(-FAR, min(FAR, v)) for v in exact.ravel()], np.int64).reshape(exact.shape)


class Search:
    """Top k of a block of queries over buckets, longest vectors first."""

    def __init__(self, rows, vectors, k: int, to_beat, coordinate_from: float, focus: int):
        self.rows, self.vectors, self.k = rows, vectors, k
        self.lengths = np.sqrt((vectors.astype(np.float64) ** 2).sum(1))
        self.to_beat = to_beat.astype(np.float64)
        self.coordinate_from, self.focus = coordinate_from, min(focus, vectors.shape[1])
        self.best: list[list[tuple[int, int]]] = [[] for _ in rows]
        self.counts = {"bucket": 0, "coordinate": 0, "length": 0, "verified": 0}

    def bucket(self, ids: np.ndarray, vectors: np.ndarray, squares: np.ndarray, rows: np.ndarray | None = None) -> None:
        """``rows`` names the vectors' rows, by which a query knows its own; by default their ids do."""
        order = np.argsort(-squares, kind="stable")
        rows = (ids if rows is None else rows)[order]
        ids, vectors, lengths = ids[order], vectors[order], np.sqrt(squares[order])
        longest = lengths[0]
        unit = vectors / np.maximum(lengths, 1e-300)[:, None]
        for q in range(len(self.rows)):
            own, length, beat = self.vectors[q], self.lengths[q], self.to_beat[q]
            scale = length * longest
            if scale > 0 and beat > scale * (1 + MARGIN):
                self.counts["bucket"] += 1
                continue
            local = beat / scale if scale > 0 else 0.0
            if scale > 0 and local >= max(0.0, self.coordinate_from):
                self.counts["coordinate"] += 1
                chosen = self._near(unit, own / length, local - MARGIN)
            else:
                self.counts["length"] += 1
                floor = beat / length * (1 - MARGIN) if length > 0 and beat > 0 else 0.0
                chosen = np.arange(np.searchsorted(-lengths, -floor, "right"))
            chosen = chosen[rows[chosen] != self.rows[q]]
            if len(chosen):
                self.counts["verified"] += len(chosen)
                scores = _products(vectors[chosen], own, scale)
                self._merge(q, scores, ids[chosen])

    def _near(self, unit: np.ndarray, query: np.ndarray, cosine: float) -> np.ndarray:
        chosen = None
        for f in np.argsort(-np.abs(query))[: self.focus]:
            spread = np.sqrt(max(0.0, (1 - cosine * cosine) * (1 - query[f] * query[f]))) + MARGIN
            # At a cosine of t the coordinate is within spread of t * query[f]; t runs from cosine to 1.
            low, high = min(cosine * query[f], query[f]) - spread, max(cosine * query[f], query[f]) + spread
            column = unit[:, f] if chosen is None else unit[chosen, f]
            inside = np.flatnonzero((column >= low) & (column <= high))
            chosen = inside if chosen is None else chosen[inside]
        return chosen

    def _merge(self, q: int, scores: np.ndarray, ids: np.ndarray) -> None:
        if len(scores) > self.k:
            worst = np.partition(scores, len(scores) - self.k)[len(scores) - self.k]
            kept = scores >= worst
            scores, ids = scores[kept], ids[kept]
        merged = sorted([*self.best[q], *zip((-scores).tolist(), ids.tolist(), strict=True)])[: self.k]
        self.best[q] = merged
        if len(merged) == self.k:
            self.to_beat[q] = max(self.to_beat[q], -merged[-1][0])


def _seeded(rows, vectors, seed_rows, seed_vectors, seed_squares, k: int) -> np.ndarray:
    """For each query, a score that k candidates reach; the least possible without that many."""
    lengths = np.sqrt((vectors.astype(np.float64) ** 2).sum(1))
    lowest = -lengths * np.sqrt(max(seed_squares, default=0.0)) - 1
    if len(seed_rows) <= k:
        return lowest
    out = lowest.copy()
    largest = float(lengths.max(initial=0.0) * np.sqrt(max(seed_squares)))
    for at in range(0, len(rows), 256):
        scores = _products(vectors[at : at + 256], seed_vectors.T, largest).astype(np.float64)
        scores[rows[at : at + 256, None] == seed_rows] = -np.inf
        kth = np.partition(scores, len(seed_rows) - k, axis=1)[:, len(seed_rows) - k]
        out[at : at + 256] = np.where(np.isfinite(kth), kth, lowest[at : at + 256])
    # A score beyond 2**53 may round up; what is to be beaten may not.
    return np.where(np.abs(out) < 2**52, out, out - np.abs(out) * 1e-12)


def _asked(queries: DataFrame, seeds, runs, width: int, k: int) -> DataFrame:
    """``queries`` with the score to beat, once for each tile that can reach it."""
    spark = queries.sparkSession
    shipped = spark.sparkContext.broadcast((seeds, runs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (seed_rows, seed_vectors, seed_squares), runs = shipped.value
        longest = np.sqrt(np.array([r[0] for r in runs]))
        for batch in batches:
            vectors = _matrix(batch.column("v"), width)
            beat = _seeded(batch.column("row").to_numpy(), vectors, seed_rows, seed_vectors, seed_squares, k)
            reach = np.sqrt((vectors**2).sum(1))[:, None] * longest * (1 + 2 * MARGIN)
            for first, last, hit in zip([r[1] for r in runs], [r[2] for r in runs], (beat[:, None] <= reach).T, strict=True):
                if not hit.any():
                    continue
                some = batch.take(pa.array(np.flatnonzero(hit)))
                for tile in range(first, last + 1):
                    columns = [some.column(c) for c in ("row", "id", "v", "square")]
                    ends = pa.array(np.full(some.num_rows, tile, np.int32)), pa.array(np.ones(some.num_rows, np.int32))
                    yield pa.RecordBatch.from_arrays([*ends, *columns, pa.array(beat[hit])], [f.split()[0] for f in _STREAM.split(", ")])

    return queries.select("row", "id", "v", "square").mapInArrow(run, _STREAM)


def top_products(
    vectors: DataFrame,
    is_query: Column,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    k: int = 5,
    scale: int = 256,
    bucket: int = 4096,
    block: int = 4096,
    seeds: int = 2048,
    coordinate_from: float = 0.6,
    focus: int = 4,
    tile: int = 16384,
) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id`` and ``score`` of each query's k best candidates."""
    spark = vectors.sparkSession
    checkpoint_dir(spark)
    at = scratch_location(spark, "top")
    try:
        everything = whole_numbers(vectors, vec_id, embedding, scale, is_query)
        n, width = everything.agg(F.count("*"), F.max(F.size("v"))).first()
        width = width or 0
        laid = everything.repartitionByRange(max(1, math.ceil(n / tile)), F.desc("square"), F.col("id"))
        laid = laid.withColumns({"tile": F.spark_partition_id(), "row": F.monotonically_increasing_id()})
        laid.write.parquet(at)
        tiles = spark.read.schema(laid.schema).parquet(at)
        # Bounded by the parameter: the longest vectors, which give first scores to beat.
        seed_rows = tiles.orderBy(F.desc("square"), "id", "row").limit(seeds).collect()
        seed_vectors = np.zeros((len(seed_rows), width))
        for i, r in enumerate(seed_rows):
            seed_vectors[i, : len(r["v"])] = r["v"]
        first = np.array([r["row"] for r in seed_rows], np.int64), seed_vectors, [r["square"] for r in seed_rows]
        last = tiles.agg(F.max("tile")).first()[0] or 0
        runs = tiles.groupBy(F.expr(f"tile div {-(-(last + 1) // RUNS)}")).agg(F.max("square"), F.min("tile"), F.max("tile"))
        runs = [tuple(r)[1:] for r in runs.collect()]

        nothing = F.lit(None).cast("double").alias("beat")
        held = tiles.select("tile", F.lit(0).alias("kind"), "row", "id", "v", "square", nothing)
        stream = held.unionByName(_asked(tiles.where("query"), first, runs, width, k))
        stream = stream.repartition("tile").sortWithinPartitions("tile", "kind", F.desc("square"), "id")
        found = stream.mapInArrow(
            _searcher(width, k, bucket, block, coordinate_from, focus), "query_row bigint, query_id bigint, vec_id bigint, score bigint"
        )
        best = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")
        ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
        return ranked.select("query_id", "rank", "vec_id", "score").checkpoint()
    finally:
        remove_location(spark, at)


def _searcher(width: int, k: int, bucket: int, block: int, coordinate_from: float, focus: int):
    """Runs over (tile, kind, length): keeps a tile's rows, then searches the queries that follow."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held = None, []
        for batch in batches:
            tiles, kinds = batch.column("tile").to_numpy(), batch.column("kind").to_numpy()
            cuts = np.flatnonzero((np.diff(tiles) != 0) | (np.diff(kinds) != 0)) + 1
            edges = [0, *cuts.tolist(), len(tiles)]
            for begin, end in zip(edges, edges[1:], strict=False):
                if begin == end:
                    continue
                part = batch.slice(begin, end - begin)
                if tiles[begin] != current:
                    current, held = tiles[begin], []
                if kinds[begin] == 0:
                    own = (part.column(c).to_numpy() for c in ("id", "square", "row"))
                    held.append((_matrix(part.column("v"), width), *own))
                    continue
                if len(held) > 1:
                    held = [tuple(map(np.concatenate, zip(*held, strict=True)))]
                for at in range(0, part.num_rows, block):
                    yield found(part.slice(at, block), held)

    def found(queries: pa.RecordBatch, held: list[tuple]) -> pa.RecordBatch:
        rows = queries.column("row").to_numpy()
        search = Search(rows, _matrix(queries.column("v"), width), k, queries.column("beat").to_numpy(), coordinate_from, focus)
        for vectors, ids, squares, own in held:
            for at in range(0, len(ids), bucket):
                part = slice(at, at + bucket)
                search.bucket(ids[part], vectors[part], squares[part], own[part])
        ids = queries.column("id").to_pylist()
        out = [(r, q, v, -s) for r, q, best in zip(rows.tolist(), ids, search.best, strict=True) for s, v in best]
        columns = list(zip(*out, strict=True)) or [()] * 4
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["query_row", "query_id", "vec_id", "score"])

    return run
