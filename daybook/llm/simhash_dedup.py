"""SimHash near-dedup by meet-in-the-middle ball hashing.

Two fingerprints at distance 3 or less have a point between them that is at
most two flips from one and one flip from the other. Every fingerprint emits
the points around it; fingerprints that emit the same point collide, and
colliding pairs are verified. Only points of even parity are needed: an even
fingerprint emits itself and its two-flip variants, an odd one its one-flip
variants, and every pair within distance 3 still meets:

* distance 3 (one even, one odd): a two-flip variant of the even one is a
  one-flip variant of the odd one;
* distance 2: both odd: a shared one-flip variant; both even: one of them;
* distance 1: the even one is a one-flip variant of the odd one.

The shuffle deals out points by their first ``bits`` bits. A fingerprint is
sent once to each such label that its ball reaches, and the task of a label
lays out the ball's points inside the label. ``bits`` grows with the
measured number of distinct fingerprints, so that a label has at most
``label_points`` points on average. Near copies share first bits, so the
points of each label are counted before they are laid out, and labels with
more than twice as many are split by further bits until none is left; a label
of ``FINEST`` bits has few points whatever the fingerprints. At one point, each fingerprint within
one flip of it is within distance 3 of every other one there, so linking one
of these to all others keeps the components with fewer links than pairs; a
point that has none such links nothing that does not meet elsewhere. Each
label hands on a spanning forest of its links, and components come from
large-star and small-star rounds, checkpointed in the shared folder.

Words: A-Z lower-cased, then split at ASCII white space. A bit is set if it
is set in over half of the XXH64 (seed 42) of the shingles.

Defined results: null and empty texts have fingerprint zero and are linked
like any other; fewer words than a shingle make one shingle; a component is
named by its smallest id, null if all are null; repeated rows are linked.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.session import checkpoint_dir

#: The largest distance at which fingerprints link; the balls are built for it.
RADIUS = 3
SEED = 42
POINTS = 1041  # mean points of a ball: (1 + 2016) for half of them, 64 for the others
FINEST = 60
#: Labels that are broadcast to be split; more of them are joined by a shuffle.
BROADCAST_LABELS = 1 << 18
LEAST_BOUND = (1 << 64 - FINEST) * 2081  # so many distinct fingerprints at most are within two flips of a point


def fingerprint_of(text: bytes | None, shingle: int) -> int:
    """The fingerprint as an unsigned number."""
    import xxhash

    words = (text or b"").lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        digests = xxhash.xxh64_digest(b" ".join(words), SEED)
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate([[0], ends[:-1] + 1])
        joined, digest = b" ".join(words), xxhash.xxh64_digest
        bounds = zip(starts[: len(words) - shingle + 1].tolist(), ends[shingle - 1 :].tolist(), strict=True)
        digests = b"".join([digest(joined[a:b], SEED) for a, b in bounds])
    n, counts = len(digests) // 8, np.zeros(64, np.int64)
    rows = np.frombuffer(digests, np.uint8)
    for at in range(0, len(rows), 8 << 14):
        counts += np.unpackbits(rows[at : at + (8 << 14)]).reshape(-1, 64).sum(0, dtype=np.int32)
    return int.from_bytes(np.packbits(2 * counts > n).tobytes(), "big")


def add_fingerprints(docs: DataFrame, text: str, shingle: int) -> DataFrame:
    """``docs`` without ``text``, with ``fingerprint`` as a signed 64-bit number."""
    others = [f for f in docs.schema if f.name not in (text, "fingerprint")]
    docs = docs.select(*(F.col(f"`{f.name}`") for f in others), F.col(text).cast("binary").alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint_of(x.as_py(), shingle) for x in batch.column("_text")], np.uint64)
            kept = [f.name for f in others]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in kept), pa.array(found.view(np.int64))], [*kept, "fingerprint"]
            )

    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in others)
    return docs.mapInArrow(run, f"{schema}fingerprint bigint")


def _flips(width: int, count: int) -> np.ndarray:
    """All masks with ``count`` of the lowest ``width`` bits."""
    ones = np.uint64(1) << np.arange(width, dtype=np.uint64)
    if count == 0:
        return np.zeros(1, np.uint64)
    if count == 1:
        return ones
    a, b = np.triu_indices(width, 1)
    return ones[a] | ones[b]


def label_links(prints: np.ndarray, label: int, bits: int) -> np.ndarray:
    """A spanning forest of the links that meet at points of one label."""
    rest = 64 - bits
    own = (prints >> np.uint64(rest)) ^ np.uint64(label)
    away = np.bitwise_count(own)
    odd = np.bitwise_count(prints) % 2 == 1
    moved = prints ^ (own << np.uint64(rest))
    points, owners, far = [], [], []
    for is_odd in (False, True):
        for flips in (1,) if is_odd else (0, 2):
            for crossed in range(flips + 1):
                at = np.flatnonzero((odd == is_odd) & (away == crossed))
                masks = _flips(rest, flips - crossed)
                points.append((moved[at][:, None] ^ masks).ravel())
                owners.append(np.repeat(at.astype(np.int32), len(masks)))
                far.append(np.full(len(at) * len(masks), flips == 2))
    points, owners, far = map(np.concatenate, (points, owners, far))
    if not len(points):
        return np.zeros((0, 2), np.uint64)
    order = np.argsort(points)
    points, owners, far = points[order], owners[order], far[order]
    same = points[1:] == points[:-1]
    met = np.concatenate([same, [False]]) | np.concatenate([[False], same])
    points, owners, far = points[met], owners[met], far[met]
    order = np.lexsort((prints[owners], far, points))
    points, owners, far = points[order], owners[order], far[order]
    first = np.flatnonzero(np.concatenate([[True], points[1:] != points[:-1]])) if len(points) else order
    sizes = np.diff(np.concatenate([first, [len(points)]]))
    centre = np.repeat(first, sizes)
    linked = ~far[centre] & (centre != np.arange(len(points)))
    a, b = owners[centre[linked]], owners[linked]
    near = np.bitwise_count(prints[a] ^ prints[b]) <= RADIUS
    pairs = np.unique(np.stack([a[near], b[near]], 1), axis=0) if near.any() else np.zeros((0, 2), np.int32)
    return prints[_forest(pairs)]


def _forest(pairs: np.ndarray) -> np.ndarray:
    """The pairs that join two trees, in order."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = x = parent.setdefault(up, up)
        return x

    kept = []
    for a, b in pairs.tolist():
        x, y = root(a), root(b)
        if x != y:
            parent[x] = y
            kept.append((a, b))
    return np.array(kept, np.int64).reshape(-1, 2)


def _left(bits: int) -> Column:
    """How many flips a row of ``fingerprint`` and ``label`` has left inside the label."""
    flips = F.when(F.bit_count("fingerprint") % 2 == 1, 1).otherwise(2)
    if not bits:
        return flips
    return flips - F.bit_count(F.shiftrightunsigned("fingerprint", 64 - bits).bitwiseXOR(F.col("label")))


def _split(rows: DataFrame, bits: int, more: int) -> DataFrame:
    """``rows`` of labels of ``bits`` bits, once for each label with ``more`` further bits that a ball reaches."""
    masks = [F.array(*(F.lit(int(m)) for k in range(n + 1) for m in _flips(more, k))) for n in range(RADIUS)]
    reached = F.when(_left(bits) == 0, masks[0]).when(_left(bits) == 1, masks[1]).otherwise(masks[2])
    own = F.shiftrightunsigned("fingerprint", 64 - bits - more).bitwiseAND(F.lit((1 << more) - 1))
    first = F.shiftleft("label", more).bitwiseOR(own)
    return rows.select("fingerprint", F.explode(F.transform(reached, lambda m: first.bitwiseXOR(m))).alias("label"))


def _points(rows: DataFrame, bits: int) -> DataFrame:
    """How many points each label lays out."""
    rest = 64 - bits
    laid = F.when(_left(bits) == 0, 1).when(_left(bits) == 1, rest).otherwise(1 + rest * (rest - 1) // 2)
    return rows.groupBy("label").agg(F.sum(laid).alias("points"))


def dealt_labels(prints: DataFrame, label_points: int = 1 << 21) -> DataFrame:
    """``prints`` once for each label that a ball reaches, with ``label`` and its number of ``bits``.

    No label has more than ``2 * label_points`` points, or ``LEAST_BOUND`` if that is more.
    """
    checkpoint_dir(prints.sparkSession)
    count, bound = prints.count(), max(2 * label_points, LEAST_BOUND)
    more = min(40, max(6, math.ceil(math.log2(max(1, count * POINTS / label_points)))))
    rows, bits, dealt = prints.select("fingerprint", F.lit(0).cast("long").alias("label")), 0, None
    while True:
        rows, bits = _split(rows, bits, more), bits + more
        # As each of them has more than ``bound`` points, the labels above it are few.
        above = _points(rows, bits).where(F.col("points") > bound).checkpoint()
        largest, labels = above.agg(F.max("points"), F.count("*")).first() if bits < FINEST else (None, 0)
        if labels <= BROADCAST_LABELS:
            above = F.broadcast(above)
        stay = rows if largest is None else rows.join(above, "label", "left_anti")
        stay = stay.select("fingerprint", "label", F.lit(bits).alias("bits"))
        dealt = stay if dealt is None else dealt.union(stay)
        if largest is None:
            return dealt
        rows = rows.join(above, "label", "left_semi").select("fingerprint", "label").checkpoint()
        more = min(FINEST - bits, 8, max(2, math.ceil(math.log2(largest / bound))))


def near_links(prints: DataFrame, label_points: int = 1 << 21) -> DataFrame:
    """Links ``a`` < ``b`` that connect what is within distance 3, from distinct ``fingerprint``."""

    def meet(key, table):
        found = table.column("fingerprint").to_numpy().view(np.uint64)
        pairs = np.sort(label_links(found, key[0].as_py(), key[1].as_py()).view(np.int64), axis=1)
        return pa.table({"a": pa.array(pairs[:, 0]), "b": pa.array(pairs[:, 1])})

    dealt = dealt_labels(prints, label_points)
    return dealt.groupBy("label", "bits").applyInArrow(meet, "a bigint, b bigint").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node that has a link; the root is the smallest node."""
    checkpoint_dir(links.sparkSession)

    def spread(pairs: DataFrame) -> DataFrame:
        # Written out, the least neighbours are a plain side of the join, whose other side
        # Spark can then split where one node has very many links.
        return pairs.join(pairs.groupBy("u").agg(F.min("v").alias("m")).checkpoint(), "u")

    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    edges, before = edges.checkpoint(), None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # Large star: every larger neighbour of u goes to u's least neighbour.
        large = spread(both).select(
            F.when(F.col("v") > F.col("u"), F.col("v")).alias("u"), F.least("m", "u").alias("v")
        )
        large = large.where("u is not null and u <> v").distinct().checkpoint()
        # Small star: u and its smaller neighbours go to the least of them.
        small = spread(large).select(
            F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")
        )
        edges = small.select("e.*").where("u <> v").distinct().checkpoint()
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
                edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            )
        before = now


def near_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3) -> DataFrame:
    """A row for each row of ``docs``: id, ``fingerprint`` (bigint), ``root`` and ``component_id``.

    Other columns than the text are kept. The fingerprints are checkpointed,
    so texts are read once.
    """
    checkpoint_dir(docs.sparkSession)
    marked = add_fingerprints(docs.drop("root", "component_id"), text, shingle).checkpoint()
    prints = marked.groupBy("fingerprint").agg(F.min(doc_id).alias("_least")).checkpoint()
    roots = components(near_links(prints.select("fingerprint"))).withColumnRenamed("node", "fingerprint")
    rooted = prints.join(roots, "fingerprint", "left").withColumn("root", F.coalesce("root", "fingerprint")).checkpoint()
    named = rooted.groupBy("root").agg(F.min("_least").alias("component_id")).checkpoint()
    classes = rooted.select("fingerprint", "root").join(named, "root")
    return marked.join(classes, "fingerprint")


def one_of_each_group(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3) -> DataFrame:
    """The rows of ``docs`` with the smallest id of their group, one for each group."""
    narrow = docs.select(F.col(doc_id).alias("_id"), F.xxhash64(text).alias("_hash"), F.col(text).alias("_text"))
    groups = near_groups(narrow, "_id", "_text", shingle)
    stay = groups.where(F.col("_id").eqNullSafe(F.col("component_id")))
    # One (id, text hash) for each group, and how often it occurs.
    stay = stay.groupBy("root").agg(F.min(F.struct("_id", "_hash")).alias("_key"))
    stay = stay.select("_key.*").withColumn("_stays", F.lit(True)).checkpoint()
    repeated = not groups.groupBy("_id", "_hash").count().where("count > 1").isEmpty()
    own = docs.withColumn("_hash", F.xxhash64(text))
    kept = own.join(stay, F.col(doc_id).eqNullSafe(F.col("_id")) & (own["_hash"] == stay["_hash"]), "left_semi")
    if repeated:  # rows that agree in id and text
        kept = kept.dropDuplicates([doc_id, "_hash"])
    return kept.select(*(F.col(f"`{c}`") for c in docs.columns))
