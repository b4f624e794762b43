"""Language identification by a bidirectional gated recurrent network over bytes.

The network reads lower-cased UTF-8 bytes in segments of ``SEGMENT`` bytes,
from both ends, and labels every position; a document's probabilities are
the geometric means of its letters' position probabilities, normalised. It is
trained on the driver in numpy by backpropagation through time, on segments
of a bounded sample: ``per_language`` labelled texts drawn by a hash of the
id, the same number for each language as far as there are as many.

Scoring runs where the texts are read, some thousand segments at a time;
whole texts count, and nothing is shuffled but the broadcast weights.

Defined results: a null text, or one without a letter, is ``und`` with score
0; with no labelled text everything is; equal texts get equal labels; rows
and other columns are kept, result columns of the same name are replaced.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SEGMENT = 128
HIDDEN = 16
BATCH = 2048
UNKNOWN = "und"
RESULT = ("lang_pred", "score")
#: Bytes that count in the pooling: ASCII letters and parts of other characters.
COUNTS = np.array([b >= 0x80 or chr(b).isalpha() for b in range(256)])


@dataclass
class Direction:
    inputs: np.ndarray  # (256, 3 hidden): what a byte adds to update, reset and candidate
    state: np.ndarray  # (hidden, 3 hidden)
    out: np.ndarray  # (hidden, languages)


@dataclass
class Network:
    languages: list[str]
    forward: Direction | None = None
    backward: Direction | None = None
    bias: np.ndarray | None = None


def _run(side: Direction, text: np.ndarray, keep: list | None = None) -> np.ndarray:
    """Hidden states (time, batch, hidden) over ``text`` (time, batch)."""
    size = side.state.shape[0]
    h = np.zeros((text.shape[1], size), np.float32)
    states = np.empty((*text.shape, size), np.float32)
    for t in range(len(text)):
        x = side.inputs[text[t]]
        a = h @ side.state
        gates = x[:, : 2 * size] + a[:, : 2 * size]
        np.tanh(np.multiply(gates, 0.5, out=gates), out=gates)
        gates *= 0.5
        gates += 0.5
        update, reset = gates[:, :size], gates[:, size:]
        candidate = np.tanh(x[:, 2 * size :] + reset * a[:, 2 * size :])
        if keep is not None:
            keep.append((h, update, reset, candidate, a[:, 2 * size :]))
        h = candidate + update * (h - candidate)
        states[t] = h
    return states


def _gradients(side: Direction, text: np.ndarray, keep: list, d_states: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Backpropagation through time: gradients of ``inputs`` and ``state``."""
    size = side.state.shape[0]
    d_inputs, d_state = np.zeros_like(side.inputs), np.zeros_like(side.state)
    d_h = np.zeros_like(d_states[0])
    for t in range(len(text) - 1, -1, -1):
        before, update, reset, candidate, hidden = keep[t]
        d_h = d_h + d_states[t]
        d_candidate = d_h * (1 - update) * (1 - candidate * candidate)
        d_update = d_h * (before - candidate) * update * (1 - update)
        d_reset = d_candidate * hidden * reset * (1 - reset)
        d_x = np.concatenate([d_update, d_reset, d_candidate], 1)
        d_a = np.concatenate([d_update, d_reset, d_candidate * reset], 1)
        np.add.at(d_inputs, text[t], d_x)
        d_state += before.T @ d_a
        d_h = d_h * update + d_a @ side.state.T
    return d_inputs, d_state


def _softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(-1, keepdims=True))
    return x / x.sum(-1, keepdims=True)


def fit(texts: list[str], labels: list[str], steps: int = 400, batch: int = 96, span: int = 64, seed: int = 7) -> Network:
    """Adam on random segments; every step draws languages evenly."""
    languages = sorted(set(labels))
    net = Network(languages)
    if not languages:
        return net
    by: list[list[np.ndarray]] = [[] for _ in languages]
    for text, label in zip(texts, labels, strict=True):
        raw = np.frombuffer(text.lower().encode(), np.uint8)
        if len(raw):
            by[languages.index(label)].append(raw)
    rng = np.random.default_rng(seed)

    def side() -> Direction:
        return Direction(
            rng.normal(0, 0.3, (256, 3 * HIDDEN)).astype(np.float32),
            rng.normal(0, 1 / math.sqrt(HIDDEN), (HIDDEN, 3 * HIDDEN)).astype(np.float32),
            rng.normal(0, 0.3, (HIDDEN, len(languages))).astype(np.float32),
        )

    net.forward, net.backward = side(), side()
    net.bias = np.zeros(len(languages), np.float32)
    filled = [k for k, x in enumerate(by) if x]
    sides = (net.forward, net.backward)
    weights = [w for s in sides for w in (s.inputs, s.state, s.out)] + [net.bias]
    means, squares = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    for step in range(1, steps + 1):
        kinds = rng.choice(filled, batch)
        text = np.zeros((span, batch), np.uint8)
        for i, k in enumerate(kinds):
            raw = by[k][rng.integers(len(by[k]))]
            at = rng.integers(max(1, len(raw) - span + 1))
            part = raw[at : at + span]
            text[: len(part), i] = part
        counts = COUNTS[text]
        total = max(1, counts.sum())
        kept: list[list] = [[], []]
        ahead, behind = _run(net.forward, text, kept[0]), _run(net.backward, text[::-1], kept[1])[::-1]
        d = _softmax(ahead @ net.forward.out + behind @ net.backward.out + net.bias)
        d[:, np.arange(batch), kinds] -= 1
        d *= (counts / total)[:, :, None]
        gradients = []
        for s, states, keep, turned in ((net.forward, ahead, kept[0], False), (net.backward, behind, kept[1], True)):
            d_states = d @ s.out.T
            order = slice(None, None, -1) if turned else slice(None)
            gradients += _gradients(s, text[order], keep, d_states[order])
            gradients.append(np.einsum("tbh,tbk->hk", states, d))
        gradients.append(d.sum((0, 1)))
        norm = math.sqrt(sum(float((g * g).sum()) for g in gradients))
        rate = 0.02 * (0.5 + 0.5 * math.cos(math.pi * step / steps)) + 0.0005
        for w, g, m, v in zip(weights, gradients, means, squares, strict=True):
            g = g * min(1.0, 1.0 / (norm + 1e-12))
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return net


def position_log_probabilities(net: Network, text: np.ndarray) -> np.ndarray:
    """(time, batch, languages) for segments ``text`` (time, batch)."""
    ahead, behind = _run(net.forward, text), _run(net.backward, text[::-1])[::-1]
    x = ahead @ net.forward.out + behind @ net.backward.out + net.bias
    x -= x.max(-1, keepdims=True)
    x -= np.log(np.exp(x).sum(-1, keepdims=True))
    return x


def label_texts(net: Network, texts: list[str | None]) -> list[tuple[str, float]]:
    """Language and probability of whole texts."""
    out = [(UNKNOWN, 0.0)] * len(texts)
    if net.forward is None:
        return out
    raws = [(i, np.frombuffer(t.lower().encode(), np.uint8)) for i, t in enumerate(texts) if t and any(map(str.isalpha, t))]
    if not raws:
        return out
    pieces = np.array([-(-len(raw) // SEGMENT) for _, raw in raws])
    padded = np.zeros((pieces.sum(), SEGMENT), np.uint8)
    flat, at = padded.ravel(), 0
    for (_, raw), n in zip(raws, pieces, strict=True):
        flat[at * SEGMENT : at * SEGMENT + len(raw)] = raw
        at += n
    sums = np.zeros((len(padded), len(net.languages)))
    for a in range(0, len(padded), BATCH):
        part = np.ascontiguousarray(padded[a : a + BATCH].T)
        logs = position_log_probabilities(net, part)
        sums[a : a + BATCH] = np.einsum("tbk,tb->bk", logs, COUNTS[part].astype(np.float32))
    letters = COUNTS[padded].sum(1)
    owner = np.repeat(np.arange(len(raws)), pieces)
    pooled = np.stack([np.bincount(owner, s) for s in sums.T], 1) / np.bincount(owner, letters)[:, None]
    shares = _softmax(pooled)
    for (i, _), p in zip(raws, shares, strict=True):
        best = int(p.argmax())
        out[i] = (net.languages[best], float(p[best]))
    return out


def train(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    per_language: int = 300,
    most: int = 6000,
    longest: int = 1 << 16,
) -> Network:
    """Fits on about ``per_language`` texts of each language, ``most`` in all, none above ``longest`` bytes."""
    known = docs.select(
        F.xxhash64(F.col(doc_id), F.col(text)).alias("_order"), F.col(text).alias("_text"), F.col(lang).alias("_lang")
    ).where(F.col("_lang").isNotNull() & F.octet_length("_text").between(1, longest))
    sizes = {r["_lang"]: r["count"] for r in known.groupBy("_lang").count().collect()}
    wanted, draw = F.lit(False), F.pmod(F.xxhash64("_order"), F.lit(1 << 20))
    each = max(1, min(per_language, most // max(1, len(sizes))))
    for kind, n in sizes.items():
        wanted = wanted | ((F.col("_lang") == kind) & (draw < min(1 << 20, math.ceil((1 << 20) * each / n))))
    rows = sorted(known.where(wanted).collect(), key=lambda r: (r["_order"], r["_text"]))
    return fit([r["_text"] for r in rows], [r["_lang"] for r in rows])


def label_languages(docs: DataFrame, net: Network, text: str = "text", slab: int = 1 << 20) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``; about ``slab`` bytes of text are in work at a time."""
    docs = docs.drop(*(c for c in RESULT if c != text))
    shipped = docs.sparkSession.sparkContext.broadcast(net)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[tuple[str, float]] = []
            texts: list[str | None] = []
            held = 0
            for value in batch.column(text):
                texts.append(value.as_py())
                held += len(texts[-1] or "")
                if held >= slab:
                    found += label_texts(shipped.value, texts)
                    texts, held = [], 0
            found += label_texts(shipped.value, texts)
            added = [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], [*batch.schema.names, *RESULT])

    kept = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in docs.schema)
    return docs.mapInArrow(run, f"{kept}lang_pred string, score double")
