"""Toxicity by compression distance to two zstandard dictionaries.

Training (on the driver, from a bounded sample of labelled texts): words
whose share of toxic texts and of ordinary texts differ beyond chance are
laid into two content dictionaries, one from each class, the most telling
words nearest the end; both end with the same common words. A word that the
dictionary holds already by its first bytes adds nothing and is left out.

Scoring: a text is cut into windows, its words between spaces. A window is
compressed with each dictionary between a fixed prefix, which both hold, and
a fixed suffix, so that lengths add up byte by byte even for short windows;
the window's value is the ordinary length less the toxic length. The
values' maximum, mean of the top three, and shares and number above
thresholds go through a logistic function that is fitted on sample texts
which the dictionaries have not seen, weighted to the labelled classes'
sizes; of some dictionary sizes the one with the least loss there counts.
A worker process keeps the values of windows it has met, up to a limit.

Defined results: null and empty texts, and texts without words, have no
window above a threshold and get that score; without enough labelled texts
of either class every text gets the share of toxic labels as score. Equal
texts get equal scores; rows and other columns are kept, a column named
``score`` is replaced.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Around a window; bytes that text hardly has.
PREFIX = bytes([14, 15, 16, 17, 18, 19, 20, 21, 22, 23, 24, 25, 26, 27, 28, 29, 14, 16, 18, 20, 22, 24, 26, 28])
SUFFIX = bytes(range(1, 9))
EDGE = re.compile(rb"^[\x00-\x2f\x3a-\x60\x7b-\x7f]+|[\x00-\x2f\x3a-\x60\x7b-\x7f]+$")
LONGEST_WINDOW = 64
HEAD = 7  # a space and the shortest match that zstandard is told to make
SIZES = (300, 600, 1200, 2400)
LEAST_TEXTS = 12
MEMO_LIMIT = 400_000
FEATURES = 6


@dataclass
class Classifier:
    toxic: bytes = b""
    ordinary: bytes = b""
    centre: list[float] = field(default_factory=list)
    weights: list[float] = field(default_factory=list)
    constant: float | None = 0.0


def windows(text: str | None) -> list[bytes]:
    words = (text or "").lower().encode().split()
    if words and max(map(len, words)) > LONGEST_WINDOW:
        words = [w[i : i + LONGEST_WINDOW] for w in words for i in range(0, len(w), LONGEST_WINDOW)]
    return words


class Distance:
    """A window's compressed length with the ordinary less that with the toxic dictionary."""

    def __init__(self, toxic: bytes, ordinary: bytes):
        import zstandard

        options = zstandard.ZstdCompressionParameters(
            window_log=17, hash_log=14, chain_log=14, search_log=6, min_match=6, target_length=32,
            strategy=zstandard.STRATEGY_LAZY, write_content_size=0, write_checksum=0, write_dict_id=0,
            format=zstandard.FORMAT_ZSTD1_MAGICLESS,
        )

        def compressor(content: bytes):
            held = zstandard.ZstdCompressionDict(content + PREFIX, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            held.precompute_compress(compression_params=options)
            return zstandard.ZstdCompressor(dict_data=held, compression_params=options).compress

        self.by_toxic, self.by_ordinary = compressor(toxic), compressor(ordinary)
        self.memo: dict[bytes, int] = {}

    def __call__(self, window: bytes) -> int:
        framed = PREFIX + b" " + window + b" " + SUFFIX
        value = len(self.by_ordinary(framed)) - len(self.by_toxic(framed))
        if len(self.memo) >= MEMO_LIMIT:
            self.memo.clear()
        self.memo[window] = value
        return value

    def features(self, text: str | None) -> list[float]:
        known = self.memo.get
        values = [v if (v := known(w)) is not None else self(w) for w in windows(text)]
        if not values:
            return [0.0] * FEATURES
        s = np.sort(np.array(values))
        n = len(s)
        above = n - np.searchsorted(s, (2, 3, 4))
        top = s[-3:].sum() / 3 if n >= 3 else s.mean()
        return [
            float(s[-1]), float(top), math.sqrt(above[0] / n), math.sqrt(above[2] / n),
            math.log1p(above[1]), math.log1p(n),
        ]


def _content(words: list[bytes], size: int, after: bytes) -> bytes:
    """Words up to ``size`` bytes, the first nearest the end, ahead of ``after``."""
    out = b" "
    for word in words:
        if len(out) >= size:
            break
        if (b" " + word + b" ")[:HEAD] not in out:
            out = b" " + word + out
    return out + after


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Weights of the columns and a constant, by Newton steps with a small penalty."""
    x = np.c_[x, np.ones(len(x))]
    w, penalty = np.zeros(x.shape[1]), np.full(x.shape[1], 1e-3)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (weight * (p - y)) + penalty * w
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(curve + 1e-9 * np.eye(len(w)), slope)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit(toxic: list[str], ordinary: list[str], share: float) -> Classifier:
    """``share`` is the toxic share of all labelled texts."""
    if min(len(toxic), len(ordinary)) < LEAST_TEXTS:
        return Classifier(constant=share)
    cut = [len(x) * 2 // 3 for x in (toxic, ordinary)]
    seen, held = (toxic[: cut[0]], ordinary[: cut[1]]), (toxic[cut[0] :], ordinary[cut[1] :])

    def counts(texts: list[str]) -> Counter:
        found: Counter = Counter()
        for text in texts:
            found.update({EDGE.sub(b"", w) for w in set(windows(text))})
        found.pop(b"", None)
        return found

    in_toxic, in_ordinary = map(counts, seen)
    n_toxic, n_ordinary = map(len, seen)

    def lean(word: bytes) -> float:
        """How many standard errors the word's share of toxic texts is above that of ordinary ones."""
        a, b = in_toxic[word], in_ordinary[word]
        p = (a + b) / (n_toxic + n_ordinary)
        return (a / n_toxic - b / n_ordinary) / math.sqrt(p * (1 - p) * (1 / n_toxic + 1 / n_ordinary) + 1e-12)

    def telling(found: Counter, sign: int, least: float) -> list[bytes]:
        leans = {w: sign * lean(w) for w, n in found.items() if n >= 4}
        return sorted((w for w in leans if leans[w] > least), key=lambda w: (-leans[w], w))

    toxic_words, ordinary_words = telling(in_toxic, 1, 5.5), telling(in_ordinary, -1, 2.0)
    usual = sorted(in_ordinary, key=lambda w: (-in_ordinary[w], w))[:600]
    shared = b" " + b" ".join([w for w in usual if lean(w) < 3][:150][::-1]) + b" "
    y = np.concatenate([np.ones(len(held[0])), np.zeros(len(held[1]))])
    weight = np.where(y == 1, share / len(held[0]), (1 - share) / len(held[1])) * len(y)
    best, least = Classifier(constant=share), math.inf
    for size in SIZES:
        parts = _content(toxic_words, size, shared), _content(ordinary_words, size, shared)
        measure = Distance(*parts)
        x = np.array([measure.features(t) for t in [*held[0], *held[1]]])
        centre = x.mean(0)
        w = _logistic(x - centre, y, weight)
        p = 1 / (1 + np.exp(-np.clip(np.c_[x - centre, np.ones(len(x))] @ w, -30, 30)))
        loss = -(weight * np.log(np.where(y == 1, p, 1 - p))).sum()
        if loss < least:
            best, least = Classifier(*parts, centre.tolist(), w.tolist(), None), loss
        if len(parts[0]) - len(shared) < size:
            break  # all telling words are in
    return best


#: The classifier that this worker process used last, with the windows it has met.
_LAST: dict[bytes, Distance] = {}


def score_of(text: str | None, model: Classifier, measure: Distance | None) -> float:
    if model.constant is not None:
        return model.constant
    x = np.append(np.array(measure.features(text)) - model.centre, 1.0)
    return float(1 / (1 + np.exp(-np.clip(x @ model.weights, -30, 30))))


def train(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    per_class: int = 2500,
    longest: int = 1 << 16,
) -> Classifier:
    """Fits on about ``per_class`` labelled texts of each class, none above ``longest`` bytes.

    The sample is drawn by a hash of the id. The driver holds at most about
    ``2 * per_class`` texts.
    """
    known = labels.where(F.col(doc_id).isNotNull() & F.col(label).isNotNull())
    known = known.groupBy(doc_id).agg((F.max(label) > 0).alias("_toxic"))
    sizes = {r["_toxic"]: r["count"] for r in known.groupBy("_toxic").count().collect()}
    total = sum(sizes.values())
    if not total:
        return Classifier(constant=0.0)
    draw = F.pmod(F.xxhash64(F.col(doc_id), F.lit("sample")), F.lit(1 << 20))
    wanted = F.lit(False)
    for kind, n in sizes.items():
        wanted = wanted | ((F.col("_toxic") == kind) & (draw < min(1 << 20, math.ceil((1 << 20) * per_class / n))))
    picked = known.where(wanted)
    texts = docs.select(F.col(doc_id), F.col(text).alias("_text")).where(F.octet_length("_text").between(1, longest))
    rows = texts.join(F.broadcast(picked), doc_id).select("_toxic", F.xxhash64(doc_id).alias("_order"), "_text")
    rows = sorted(rows.collect(), key=lambda r: (r["_order"], r["_text"]))
    toxic, ordinary = ([r["_text"] for r in rows if r["_toxic"] == kind] for kind in (True, False))
    return fit(toxic, ordinary, sizes.get(True, 0) / total)


def score_texts(docs: DataFrame, model: Classifier, text: str = "text") -> DataFrame:
    """``docs`` with ``score``, 0 to 1, higher where the toxic dictionary does better."""
    docs = docs.drop("score") if text != "score" else docs
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shipped.value
        key = model.toxic + b"\0" + model.ordinary
        if model.constant is None and key not in _LAST:
            _LAST.clear()
            _LAST[key] = Distance(model.toxic, model.ordinary)
        measure = _LAST.get(key)
        for batch in batches:
            scores = [score_of(x.as_py(), model, measure) for x in batch.column(text)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(scores, pa.float64())], [*batch.schema.names, "score"]
            )

    kept = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in docs.schema)
    return docs.mapInArrow(run, f"{kept}score double")
