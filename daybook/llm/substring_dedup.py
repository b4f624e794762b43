"""Removal of repeated byte strings by names of growing strings around anchors.

A byte goes if a string of ``length`` bytes that covers it starts anywhere
else. This takes the place of prefix doubling: no ranks are sorted or paired
and no lengths double. Strings have names (64-bit hashes of their bytes, used
in pairs) that each round makes anew and Spark counts; strings grow from round
to round until a name is unique or reaches past the threshold:

* Every window of ``length`` bytes chooses an anchor, the place of the smallest
  8-byte hash in its middle; equal windows choose the same place. So the
  anchor's next ``length // 4`` bytes on either side, its core, lie in every
  window that chooses it, whatever the document.
* Round 0 has one core for each anchor. Windows can repeat only if their
  anchor's core does. What an anchor's windows cover together is its hull: if
  that repeats, all its windows do, and it is settled.
* Round 1 cuts what is open into blocks of ``BLOCK`` windows. A block's core is
  what its windows share, its hull what they cover; both are named around the
  threshold: a block whose core is unique is dropped, one whose hull is not is
  settled.
* Round 2 names the windows of the blocks that are still open.

So each round names a string below the threshold and one above it, for the
places that are still open. Prefix doubling of all positions would shuffle 16
bytes for each byte of text in every round.

Equal texts are settled first: all but short ones repeat whole, and one of them
goes on for the others' sake. Names come from running sums over a text's
8-byte grams, so any string of a text is named in constant time. Counted names
are written out before rows are joined to them, so that both sides of each
join are plain shuffles, of which Spark's skew rule can split a hot name.

Defined results: null texts are empty; texts shorter than ``length`` keep
everything; matches never cross rows; overlapping repeats in one text count;
repeated rows lose everything that is long enough.
"""

from __future__ import annotations

import gc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.session import remove_location, scratch_location

GRAM = 8
#: Windows in a block of round 1.
BLOCK = 16
#: Bytes that a task hashes at once.
STRETCH = 1 << 18
KEY = ("_t", "_n")
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93))
_BASE = 0xBF58476D1CE4E5B9
_HALF = np.uint64(32)


def _edge(length: int) -> int:
    """Bytes of a window before (and after) the part in which it looks for its anchor."""
    return length // 4


def _grams(raw) -> np.ndarray:
    return np.ndarray((max(len(raw) - GRAM + 1, 0),), "<u8", raw, 0, (1,))


def anchors(text: bytes, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchors, and the first and last window that chooses each."""
    starts, edge = len(text) - length + 1, _edge(length)
    width = length - 2 * edge - GRAM + 1
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for at in range(0, max(starts, 0), STRETCH):
        count = min(STRETCH, starts - at)
        grams = _grams(text[at + edge : at + edge + count - 1 + width - 1 + GRAM])
        mixed = ((grams * _MIX[0]) >> _HALF) * _MIX[1] >> _HALF
        keys = np.full(-(-len(mixed) // width) * width, np.iinfo(np.uint64).max, np.uint64)
        keys[: len(mixed)] = (mixed << _HALF) | np.arange(len(mixed), dtype=np.uint64)
        rows = keys.reshape(-1, width)
        ahead = np.minimum.accumulate(rows, 1).ravel()
        behind = np.minimum.accumulate(rows[:, ::-1], 1)[:, ::-1].ravel()
        least = np.minimum(behind[:count], ahead[width - 1 : width - 1 + count])
        chosen = (least & np.uint64(0xFFFFFFFF)).astype(np.int64) + (at + edge)
        first = np.flatnonzero(np.concatenate([[True], chosen[1:] != chosen[:-1]]))
        found.append((chosen[first], first + at, np.concatenate([first[1:], [count]]) - 1 + at))
    if not found:
        none = np.zeros(0, np.int64)
        return none, none, none
    place, first, last = (np.concatenate(x) for x in zip(*found, strict=True))
    # An anchor whose windows lie on both sides of a cut between stretches is one anchor.
    new = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
    return place[new], first[new], last[np.concatenate([new[1:], [len(place)]]) - 1]


class Names:
    """Names of strings of ``raw``, from running sums over its grams."""

    powers = (np.ones(1, np.uint64), np.ones(1, np.uint64))

    def __init__(self, raw) -> None:
        grams = _grams(raw)
        up, down = self._powers(len(grams) + 1)
        mixed = (grams ^ (grams >> np.uint64(29))) * _MIX[0]
        mixed = (mixed ^ (mixed >> _HALF)) * _MIX[1]
        self.up = up
        self.sums = np.zeros(len(grams) + 1, np.uint64)
        np.cumsum(mixed * down[: len(grams)], out=self.sums[1:])

    @classmethod
    def _powers(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.powers[0]) < n:
            size = 1 << max(n, STRETCH).bit_length()
            base = (_BASE, pow(_BASE, -1, 1 << 64))
            made = []
            for b in base:
                factors = np.full(size, b, np.uint64)
                factors[0] = 1
                made.append(np.multiply.accumulate(factors))
            cls.powers = tuple(made)
        return cls.powers

    def of(self, begin: np.ndarray, end: np.ndarray, salt) -> np.ndarray:
        """Names of the strings from ``begin`` to ``end`` (8 bytes or more); one place counts once for a salt."""
        name = (self.sums[end - (GRAM - 1)] - self.sums[begin]) * self.up[begin]
        name = (name + np.asarray(salt).astype(np.uint64) * _MIX[0]) ^ ((end - begin).astype(np.uint64) << np.uint64(48))
        name = (name ^ (name >> _HALF)) * _MIX[1]
        return (name ^ (name >> np.uint64(29))).view(np.int64)


def _anchor_rows(text: bytes, length: int) -> list[np.ndarray]:
    """Round 0 of a text: core, hull, anchor, and the smallest and greatest offset of its windows."""
    place, first, last = anchors(text, length)
    low, high = place - last, place - first
    core, hull = np.zeros(len(place), np.int64), np.zeros(len(place), np.int64)
    edge, cuts = _edge(length), [*range(0, len(text), STRETCH), len(text)]
    marks = np.searchsorted(place, cuts)
    for at, begin, end in zip(cuts, marks, marks[1:], strict=False):
        if begin == end:
            continue
        base = max(0, at - length)
        names = Names(text[base : at + STRETCH + length + GRAM])
        p, lo, hi = place[begin:end] - base, low[begin:end], high[begin:end]
        core[begin:end] = names.of(p - edge, p + GRAM + edge, 0)
        hull[begin:end] = names.of(p - hi, p - lo + length, (hi << 32) + lo + 1)
    return [core, hull, place, low, high]


def _first_round(texts: DataFrame, length: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, size = [], 0
            for t, n, text in zip(batch.column("_t").to_numpy(), batch.column("_n").to_numpy(), batch.column("_text"), strict=True):
                own = _anchor_rows(text.as_py(), length)
                rows.append([np.full(len(own[0]), t), np.full(len(own[0]), n), *own])
                size += len(own[0])
                if size > 100_000:
                    yield packed(rows)
                    rows, size = [], 0
            if rows:
                yield packed(rows)

    def packed(rows: list) -> pa.RecordBatch:
        t, n, core, hull, place, low, high = (np.concatenate(x) for x in zip(*rows, strict=True))
        columns = {"core": core, "hull": hull, "_t": t, "_n": n.astype(np.int32)}
        columns |= {"anchor": place.astype(np.int32), "low": low.astype(np.int32), "high": high.astype(np.int32)}
        return pa.RecordBatch.from_pydict({k: pa.array(v) for k, v in columns.items()})

    return texts.mapInArrow(run, "core bigint, hull bigint, _t bigint, _n int, anchor int, low int, high int")


def _surroundings(joined: DataFrame, length: int) -> DataFrame:
    """Cuts what an open anchor's blocks cover out of its text."""
    edge, last = _edge(length), length - _edge(length) - GRAM

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for r in batch.to_pylist():
                text = r["_text"]
                for x in r["places"]:
                    p = x["anchor"]
                    low, high = max(x["low"] // BLOCK * BLOCK, edge), min(x["high"] // BLOCK * BLOCK + BLOCK - 1, last)
                    base = max(0, p - high)
                    rows.append((r["_t"], r["_n"], p, x["low"], x["high"], base, text[base : p - low + length]))
                if len(rows) > 5000:
                    yield packed(rows)
                    rows = []
            yield packed(rows)

    def packed(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) or [()] * 7
        kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.binary())
        names = ["_t", "_n", "anchor", "low", "high", "base", "around"]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    return joined.mapInArrow(run, "_t bigint, _n int, anchor int, low int, high int, base int, around binary")


def _pieces(around: DataFrame, size: int, length: int) -> DataFrame:
    """Names of each row's blocks of ``size`` windows from offset ``low`` to ``high``.

    Columns core, hull (null where the text ends before it does), place and
    ``block``, the first offset over ``size``.
    """
    edge, last = _edge(length), length - _edge(length) - GRAM

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            step = max(1, STRETCH // (3 * length))
            for at in range(0, batch.num_rows, step):
                yield named(batch.slice(at, step))

    def named(batch: pa.RecordBatch) -> pa.RecordBatch:
        n, p, low, high, base = (batch.column(c).to_numpy().astype(np.int64) for c in ("_n", "anchor", "low", "high", "base"))
        raws = batch.column("around").to_pylist()
        begins = np.concatenate([[0], np.cumsum([len(x) for x in raws])[:-1]]).astype(np.int64)
        names = Names(b"".join(raws))
        first, count = low // size, high // size - low // size + 1
        row = np.repeat(np.arange(len(n)), count)
        block = np.repeat(first - (np.cumsum(count) - count), count) + np.arange(len(row))
        lo, hi = np.maximum(block * size, edge), np.minimum(block * size + size - 1, last)
        shift = begins[row] - base[row]
        inside = (p[row] - hi >= 0) & (p[row] - lo + length <= n[row])  # the hull lies in the text
        if size == 1:
            row, block, lo, hi, shift = (x[inside] for x in (row, block, lo, hi, shift))
            inside = np.ones(len(row), bool)
        a = p[row]
        core = names.of(a - lo + shift, a - hi + length + shift, block * 2)
        begin, end = np.where(inside, a - hi, a - lo) + shift, np.where(inside, a - lo, a - hi) + length + shift
        hull = names.of(begin, end, block * 2 + 1)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(core), pa.array(hull, mask=~inside), batch.column("_t").take(pa.array(row)),
                batch.column("_n").take(pa.array(row)), pa.array(a.astype(np.int32)), pa.array(block.astype(np.int32)),
            ],
            ["core", "hull", "_t", "_n", "anchor", "block"],
        )

    return around.mapInArrow(run, "core bigint, hull bigint, _t bigint, _n int, anchor int, block int")


class _Folder:
    """Tables of a run below the shared folder, dropped when no longer needed."""

    def __init__(self, spark: SparkSession):
        self.spark, self.at = spark, scratch_location(spark, "repeats")

    def keep(self, rows: DataFrame, name: str, codec: str = "lz4") -> DataFrame:
        rows.write.option("compression", codec).parquet(f"{self.at}/{name}")
        return self.spark.read.schema(rows.schema).parquet(f"{self.at}/{name}")

    def drop(self, *names: str) -> None:
        for name in names:
            remove_location(self.spark, f"{self.at}/{name}")
        # Lets Spark drop the shuffle files of finished rounds, which it does once nothing refers to them.
        gc.collect()
        self.spark.sparkContext._jvm.System.gc()


def _settle(rows: DataFrame, place: list[str], folder: _Folder, turn: str) -> tuple[DataFrame, DataFrame]:
    """Rows whose core repeats, with ``repeats`` (the hull does too); and the places that go on.

    Of equal hulls that are settled, one goes on as a witness where an open
    row has the same core: windows of the two may still be equal.
    """
    shared = rows.groupBy("core").agg(F.count("*").alias("_c")).where("_c > 1").select("core")
    shared = folder.keep(shared, f"{turn}-shared")
    alive = folder.keep(rows.join(shared, "core"), f"{turn}-alive")
    twice = alive.where("hull is not null").groupBy("core", "hull")
    twice = twice.agg(F.count("*").alias("_c"), F.min(F.struct(*place)).alias("_witness")).where("_c > 1")
    twice = folder.keep(twice, f"{turn}-twice")
    marked = alive.join(twice.select("core", "hull", F.lit(True).alias("repeats")), ["core", "hull"], "left")
    marked = marked.select("core", *place, F.coalesce("repeats", F.lit(False)).alias("repeats"))
    marked = folder.keep(marked, f"{turn}-marked")
    still = marked.where("not repeats")
    cores = folder.keep(still.select("core").distinct(), f"{turn}-open")
    witnesses = twice.select("core", "_witness.*").join(cores, "core", "left_semi")
    return marked, still.select(*place).union(witnesses.select(*place))


def _keyed(docs: DataFrame, text: str) -> DataFrame:
    raw = F.coalesce(F.col(text).cast("binary"), F.lit(b""))
    return docs.withColumn("_text", raw).withColumns({"_t": F.xxhash64("_text"), "_n": F.octet_length("_text")})


def repeated_spans(docs: DataFrame, text: str = "text", length: int = 400) -> DataFrame:
    """For each text (``_t`` its hash, ``_n`` its bytes) that has repeats: ``spans`` (start, end), unmerged."""
    if length < 4 * GRAM:
        raise ValueError(f"strings must have {4 * GRAM} bytes at least")
    spark = docs.sparkSession
    folder = _Folder(spark)
    edge, last = _edge(length), length - _edge(length) - GRAM
    long = _keyed(docs.select(text), text).where(F.col("_n") >= length)
    texts = long.groupBy(*KEY).agg(F.first("_text").alias("_text"), F.count("*").alias("_copies"))
    texts = folder.keep(texts, "texts", "zstd")
    span = {"start": F.lit(0), "end": F.col("_n")}
    found = [texts.where("_copies > 1").select(*KEY, *(c.alias(n) for n, c in span.items()))]

    rows = folder.keep(_first_round(texts.select(*KEY, "_text"), length), "0")
    marked, left = _settle(rows, [*KEY, "anchor", "low", "high"], folder, "0")
    reach = [(F.col("anchor") - F.col("high")).alias("start"), (F.col("anchor") - F.col("low") + length).alias("end")]
    found.append(folder.keep(marked.where("repeats").select(*KEY, *reach), "0-spans"))
    places = left.groupBy(*KEY).agg(F.collect_list(F.struct("anchor", "low", "high")).alias("places"))
    places = folder.keep(places, "0-left")
    around = folder.keep(_surroundings(texts.select(*KEY, "_text").join(places, list(KEY)), length), "around", "zstd")
    del rows, marked, left, places
    folder.drop("0", "0-shared", "0-alive", "0-twice", "0-marked", "0-open", "0-left")

    rows = folder.keep(_pieces(around, BLOCK, length), "1")
    marked, left = _settle(rows, [*KEY, "anchor", "block"], folder, "1")
    low = F.greatest(F.col("block") * BLOCK, F.lit(edge))
    high = F.least(F.col("block") * BLOCK + (BLOCK - 1), F.lit(last))
    reach = [(F.col("anchor") - high).alias("start"), (F.col("anchor") - low + length).alias("end")]
    found.append(folder.keep(marked.where("repeats").select(*KEY, *reach), "1-spans"))
    left = folder.keep(left.select(*KEY, "anchor", low.alias("low"), high.alias("high")), "1-left")
    del rows, marked
    folder.drop("1", "1-shared", "1-alive", "1-twice", "1-marked", "1-open")

    windows = around.drop("low", "high").join(left, [*KEY, "anchor"])
    # A row has as many windows as a block; those of one anchor share its surroundings.
    rows = folder.keep(_pieces(windows, 1, length).select("core", *KEY, "anchor", "block"), "2")
    shared = rows.groupBy("core").agg(F.count("*").alias("_c")).where("_c > 1").select("core")
    shared = folder.keep(shared, "2-shared")
    start = F.col("anchor") - F.col("block")
    found.append(folder.keep(rows.join(shared, "core").select(*KEY, start.alias("start"), (start + length).alias("end")), "2-spans"))
    spans = found[0]
    for more in found[1:]:
        spans = spans.union(more)
    spans = spans.groupBy(*KEY).agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    spans = folder.keep(spans, "spans")
    del rows, windows, around, left, shared, found, texts
    folder.drop("texts", "around", "0-spans", "1-spans", "1-left", "2", "2-shared", "2-spans")
    return spans


def _merged(spans: list[dict] | None) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted((s["start"], s["end"]) for s in spans or ()):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((start, end))
    return out


def _whole_words(raw: bytes, start: int, end: int) -> int:
    """Words between white space that lie wholly in the run."""
    count = len(raw[start:end].split())
    split = [at for at in (start, end) if 0 < at < len(raw) and not (raw[at - 1 : at].isspace() or raw[at : at + 1].isspace())]
    return count - min(count, len(split))


def _cutter(words: int, decode: bool):
    def cut(texts: pa.Array, spans: pa.Array) -> pa.Array:
        runs, kept = [], []
        for raw, own in zip(texts, spans.to_pylist(), strict=True):
            if own is None:
                runs.append(None)
                kept.append(None)
                continue
            raw = raw.as_py()
            own = [(a, b) for a, b in _merged(own) if not words or _whole_words(raw, a, b) > words]
            runs.append([{"start": a, "end": b} for a, b in own])
            edges = [0, *(x for span in own for x in span), len(raw)]
            left = b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
            kept.append(left.decode("utf-8", "ignore") if decode else left)
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        return pa.StructArray.from_arrays([pa.array(runs, kind), pa.array(kept, pa.string() if decode else pa.binary())], ["removed", "kept"])

    return cut


def without_repeats(docs: DataFrame, text: str = "text", length: int = 400, decode: bool = False, words: int = 0) -> DataFrame:
    """``docs`` with ``removed`` (start and end of each run, in bytes) and ``kept``.

    With ``words``, a run is removed only if more than so many words (between
    white space) lie wholly in it. ``kept`` is binary; with ``decode`` it
    is a string, without the bytes of characters that a run has cut in two.
    Columns of these names are replaced; the text column stays as it was.
    """
    docs = docs.drop(*(c for c in ("removed", "kept") if c != text))
    spans = repeated_spans(docs, text, length)
    joined = _keyed(docs, text).join(spans, list(KEY), "left")
    kind = "string" if decode else "binary"
    cut = F.arrow_udf(_cutter(words, decode), f"removed array<struct<start:bigint,end:bigint>>, kept {kind}")
    # Only texts with repeats go to Python.
    done = cut(F.when(F.col("spans").isNotNull(), F.col("_text")), F.col("spans"))
    joined = joined.withColumn("_cut", done)
    whole = F.col("_text").cast(kind) if decode else F.col("_text")
    columns = [F.col(f"`{c}`") for c in docs.columns]
    none = F.array().cast("array<struct<start:bigint,end:bigint>>")
    return joined.select(
        *columns, F.coalesce("_cut.removed", none).alias("removed"), F.coalesce("_cut.kept", whole).alias("kept")
    )
