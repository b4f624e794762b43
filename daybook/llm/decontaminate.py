"""Benchmark decontamination with suffix arrays over shards of the corpus.

The corpus is read in shards: some megabytes of documents in one task. In a
shard, words become numbers (those of the benchmark's vocabulary; any other
word is 0), the suffixes that can reach a match are sorted into a suffix
array, and every benchmark suffix is binary-searched in it. A suffix counts
up to ``window`` words; runs of hits in a row give the longest verbatim
matches and their places. Suffixes that meet a foreign word before the
shortest benchmark window ends can match nothing and are left out.

Nothing is shuffled. The benchmark is the query set: it goes to the tasks in
blocks of whole items of about ``block_bytes``, one pass for each block, and
a pass adds to the hits of the passes before it, which are in a file by then:
a worker process holds the index of one block.

Words: A-Z lower-cased, then ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``.

Defined results: null and empty texts have no words, no hits and no items;
an item with fewer words than a window is one window, an item without words
is none; items without an id add hits and are not listed; repeated items are
listed once; repeated documents are judged one by one; an empty benchmark
hits nothing. Input columns named like a result column are replaced by it.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.session import remove_location, scratch_location

#: Lower-cases A-Z and turns all other ASCII characters that no word has into spaces.
TO_WORDS = bytes(
    b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else b + 32 if 0x41 <= b <= 0x5A else 0x20
    for b in range(256)
)
RESULT = ("n_words", "n_hit", "items", "matches", "spans")
SPAN = "array<struct<start:bigint,n_words:bigint>>"
MATCH = "array<struct<start:bigint,n_words:bigint,item_id:string,item_word:bigint>>"


def words_of(text: bytes) -> list[bytes]:
    return text.translate(TO_WORDS).split()


class Benchmark:
    """The windows of some items, sorted, with the places where they come from.

    About 100 bytes for each word while it is built, 60 afterwards, and the
    vocabulary.
    """

    def __init__(self, items: list[tuple[str | None, bytes | None]], window: int):
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        self.ids: list[str | None] = []
        texts: list[np.ndarray] = []
        for item_id, text in items:
            words = words_of(text or b"")
            if not words:
                continue
            numbers = (self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words)
            texts.append(np.fromiter(numbers, ">u4", len(words)))
            self.ids.append(item_id)
        sizes = np.array([len(t) for t in texts], np.int64)
        counts = np.maximum(1, sizes - window + 1)
        item = np.repeat(np.arange(len(sizes), dtype=np.int32), counts)
        word = (np.arange(len(item)) - np.repeat(np.cumsum(counts) - counts, counts)).astype(np.int32)
        length = np.minimum(window, sizes)[item]
        joined = np.concatenate([*texts, np.zeros(window, ">u4")])
        begin = (np.cumsum(sizes) - sizes)[item] + word
        rows = joined[begin[:, None] + np.arange(window)]
        rows[np.arange(window) >= length[:, None]] = 0
        keys = self.as_keys(rows)
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        new = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
        self.low, self.lengths = keys[new], length[order[new]]
        #: Window k comes from places ``owned[k]`` up to ``owned[k + 1]`` of ``item`` and ``word``.
        self.owned, self.item, self.word = np.append(new, len(keys)), item[order], word[order]
        self.shortest = int(self.lengths.min()) if len(new) else 0
        self.high = self.low
        if (self.lengths < window).any():  # these match whatever follows
            high = self.low.copy().view(">u4").reshape(-1, window)
            high[np.arange(window) >= self.lengths[:, None]] = 0xFFFFFFFF
            self.high = self.as_keys(high)

    def items_of(self, which: np.ndarray) -> set[str]:
        """Ids of the items that windows ``which`` come from."""
        held = [self.item[self.owned[k] : self.owned[k + 1]] for k in np.unique(which).tolist()]
        return {self.ids[i] for i in np.unique(np.concatenate(held)).tolist()} - {None} if held else set()

    def as_keys(self, rows: np.ndarray) -> np.ndarray:
        """Rows of big-endian numbers as byte strings that sort alike."""
        return np.ascontiguousarray(rows, ">u4").view(f"S{4 * self.window}").ravel()

    def search(self, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in ``tokens`` where windows begin, and which windows."""
        known = np.concatenate([tokens != 0, [False]])
        ends = np.flatnonzero(~known)
        reach = ends[np.searchsorted(ends, np.arange(len(tokens)))] - np.arange(len(tokens))
        starts = np.flatnonzero(reach >= self.shortest)
        if not len(starts):
            return starts, starts
        padded = np.concatenate([tokens, np.zeros(self.window, tokens.dtype)])
        rows = padded[starts[:, None] + np.arange(self.window)]
        rows *= np.arange(self.window) < reach[starts][:, None]
        keys = self.as_keys(rows)
        suffix_array = np.argsort(keys, kind="stable")
        keys, starts = keys[suffix_array], starts[suffix_array]
        begin, end = np.searchsorted(keys, self.low, "left"), np.searchsorted(keys, self.high, "right")
        found = end - begin
        which = np.repeat(np.arange(len(found)), found)
        within = np.arange(found.sum()) - np.repeat(np.cumsum(found) - found, found)
        return starts[np.repeat(begin, found) + within], which


def _shard(texts: list[bytes | None], bench: Benchmark, before: list, placed: bool) -> list[dict]:
    """One result for each text; ``before`` has what earlier passes found."""
    get = bench.vocabulary.get
    tokens, counts = [], []
    for text in texts:
        words = words_of(text or b"")
        counts.append(len(words))
        tokens.append(np.fromiter((get(w, 0) for w in words), np.uint32, len(words)))
        tokens.append(np.zeros(1, np.uint32))
    joined = np.concatenate(tokens)
    base = np.cumsum([0, *(n + 1 for n in counts)])
    if bench.shortest:
        at, which = bench.search(joined)
    else:
        at = which = np.zeros(0, np.int64)
    order = np.lexsort((which, at))
    at, which = at[order], which[order]
    bounds = np.searchsorted(at, base)
    out = []
    for i, n in enumerate(counts):
        own_at, own_which = at[bounds[i] : bounds[i + 1]] - base[i], which[bounds[i] : bounds[i + 1]]
        edges = np.zeros(n + 1, np.int64)
        np.add.at(edges, own_at, 1)
        np.add.at(edges, own_at + bench.lengths[own_which], -1)
        covered = np.cumsum(edges)[:n] > 0
        items, matches, spans = before[i] if before else ((), (), ())
        for s in spans or ():
            covered[s["start"] : s["start"] + s["n_words"]] = True
        turns = np.flatnonzero(np.diff(np.concatenate([[0], covered.astype(np.int8), [0]])))
        listed = bench.items_of(own_which)
        out.append(
            {
                "n_words": n,
                "n_hit": int(covered.sum()),
                "items": sorted(listed | set(items or ())),
                "matches": [*(matches or ()), *(_matches(own_at, own_which, bench) if placed else ())],
                "spans": [{"start": int(a), "n_words": int(b - a)} for a, b in zip(turns[::2], turns[1::2], strict=True)],
            }
        )
    return out


def _matches(at: np.ndarray, which: np.ndarray, bench: Benchmark) -> list[dict]:
    """Longest verbatim matches: windows that follow one another in the text and in an item, for each place of an item."""
    out: list[dict] = []
    open_: dict[tuple[int, int], int] = {}  # (item, item word - document word) -> its last match
    for p, k in zip(at.tolist(), which.tolist(), strict=True):
        length, places = int(bench.lengths[k]), slice(bench.owned[k], bench.owned[k + 1])
        for item, word in zip(bench.item[places].tolist(), bench.word[places].tolist(), strict=True):
            last = open_.get((item, word - p))
            if last is not None and out[last]["start"] + out[last]["n_words"] >= p + length - 1:
                out[last]["n_words"] = max(out[last]["n_words"], p + length - out[last]["start"])
                continue
            open_[(item, word - p)] = len(out)
            out.append({"start": p, "n_words": length, "item_id": bench.ids[item], "item_word": word})
    return out


#: The block that this worker process searched last.
_HELD: dict[str, Benchmark] = {}


def find_leaks(
    docs: DataFrame,
    items: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = 10,
    shard_bytes: int = 8 << 20,
    block_bytes: int = 4 << 20,
    places: bool = True,
) -> DataFrame:
    """``docs`` with ``n_words``, ``n_hit``, ``items``, ``matches`` and ``spans`` (hit runs).

    Without ``places`` the matches are left empty. A match names one place of
    one item: a text that many items hold has as many matches.
    """
    spark = docs.sparkSession
    named = items.select(F.col(item_id).cast("string").alias("id"), F.col(item_text).cast("binary").alias("text"))
    named = named.where(F.col("text").isNotNull())
    size = named.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks = max(1, -(-size // block_bytes))
    out = docs.drop(*(c for c in RESULT if c != text))
    columns = out.columns
    out = out.withColumn("_text", F.col(text).cast("binary"))
    for block in range(blocks):
        own = named.where(F.pmod(F.xxhash64("text"), F.lit(blocks)) == block)
        # One block of the query set: about block_bytes, whatever the benchmark's size.
        shipped = spark.sparkContext.broadcast(
            [(r["id"], bytes(r["text"])) for r in own.orderBy("id", "text").collect()]
        )
        out = _pass(out, columns, shipped, window, shard_bytes, places)
        if block + 1 < blocks:  # the next pass starts from a file, when this block's index is gone
            done = scratch_location(spark, "leaks")
            out.write.parquet(done)
            if block:
                remove_location(spark, at)
            at, out = done, spark.read.schema(out.schema).parquet(done)
    return out.select(*(F.col(f"`{c}`") for c in columns), *RESULT)


def _pass(docs: DataFrame, columns: list[str], shipped, window: int, shard_bytes: int, places: bool) -> DataFrame:
    name = uuid.uuid4().hex
    kept = [f for f in docs.schema if f.name not in RESULT]
    again = "spans" in docs.columns
    kinds = {"n_words": "bigint", "n_hit": "bigint", "items": "array<string>", "matches": MATCH, "spans": SPAN}

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if name not in _HELD:
            _HELD.clear()
            _HELD[name] = Benchmark(shipped.value, window)
        bench = _HELD[name]
        types = {
            "n_words": pa.int64(),
            "n_hit": pa.int64(),
            "items": pa.list_(pa.string()),
            "matches": pa.list_(
                pa.struct([("start", pa.int64()), ("n_words", pa.int64()), ("item_id", pa.string()), ("item_word", pa.int64())])
            ),
            "spans": pa.list_(pa.struct([("start", pa.int64()), ("n_words", pa.int64())])),
        }
        for batch in batches:
            names = [f.name for f in kept]
            sizes = np.array([len(x.as_buffer()) if x.is_valid else 0 for x in batch.column("_text")], np.int64)
            shard = np.cumsum(sizes) // shard_bytes
            cuts = [0, *(np.flatnonzero(np.diff(shard)) + 1), batch.num_rows]
            for a, b in zip(cuts, cuts[1:], strict=False):
                part = batch.slice(a, b - a)
                if not part.num_rows:
                    continue
                before = []
                if again:
                    before = list(zip(*(part.column(c).to_pylist() for c in ("items", "matches", "spans")), strict=True))
                rows = _shard(part.column("_text").to_pylist(), bench, before, places)
                added = [pa.array([r[c] for r in rows], types[c]) for c in RESULT]
                yield pa.RecordBatch.from_arrays([*(part.column(n) for n in names), *added], [*names, *RESULT])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    return docs.mapInArrow(search, f"{schema}, " + ", ".join(f"{c} {k}" for c, k in kinds.items()))


def remove_leaks(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that share no window with any item."""
    return find_leaks(docs, items, places=False, **options).where(F.col("n_hit") == 0).select(*(F.col(f"`{c}`") for c in docs.columns))
