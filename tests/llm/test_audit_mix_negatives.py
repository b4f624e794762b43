"""Filter audit, source mix and hard negatives against plain Python."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter, defaultdict
from fractions import Fraction
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from daybook.llm import filter_audit, queries
from daybook.llm.filter_audit import audit
from daybook.llm.hard_negatives import Forest, interval, mine, pack
from daybook.llm.mix_sources import emitted, mix

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# -- filter audit

DOCS = [
    (1, "a b c", "s", 0), (2, "a b c", "s", 1), (3, "a b c", None, 2), (None, "a b c", "s", 3), (None, "a b c", "s", 3),
    (4, "same same same same same", "", 4), (5, None, None, 5), (6, "", "s", 6), (7, "SHOUT " * 250, "t", 7),
    (8, " ".join(f"w{i}" for i in range(220)), "t", 8), (8, " ".join(f"w{i}" for i in range(220)), "t", 8),
    (9, " ".join(f"w{i}" for i in range(220)), "t", 9), (10, "# " + "x y " * 300, "t", 10), (11, "€ é\x0bü|", "s", 11),
    (11, "other text under the same id", "s", 12), (12, "same same same same same", "t", 13),
]
LABELS = [(1, 1, 0), (1, 0, 1), (2, 1, 1), (5, 1, 0), (8, 1, 1), (9, None, 1), (10, 0, None), (None, 1, 1), (99, 1, 1)]


def audited_by_hand(docs, labels, names="ABCDE"):
    fails = []
    for key, text, part, *_ in docs:
        text = text or ""
        words = WORD.findall(text)
        f = {
            "A": len(words) < 200,
            "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 2 * len(text),
            "D": bool(re.search(r"[#$%&*|]", text)),
            "E": key is not None and any(k is not None and k < key and (t or "") == text for k, t, *_ in docs),
        }
        good = key is not None and any(k == key and q == 1 for k, q, _ in labels)
        toxic = key is not None and any(k == key and x == 1 for k, _, x in labels)
        fails.append((part or "", {n for n in names if f[n]}, good, toxic))
    out = {}
    for part in {p for p, *_ in fails}:
        rows = [r[1:] for r in fails if r[0] == part]
        shapley = Counter()
        for order in permutations(names):
            left = rows
            for step, name in enumerate(order, 1):
                gone = [r for r in left if name in r[0]]
                left = [r for r in left if name not in r[0]]
                shapley[name] += len(gone)
                failing = [r for r in rows if name in r[0]]
                out[part, "".join(order), step] = (
                    len(left), len(gone), len(failing) - len(gone), sum(r[0] == {name} for r in rows),
                    sum(r[1] for r in gone), sum(r[2] for r in gone), name,
                )
        for key in [k for k in out if k[0] == part]:
            out[key] = out[key][:-1] + (shapley[out[key][-1]],)
    return out


def as_audit(rows):
    return {
        (r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley)
        for r in rows
    }


def run_audit(spark, docs, labels):
    docs = spark.createDataFrame(docs, "doc_id long, text string, source string, removed int")
    docs = docs.withColumns({"part": F.lit("mine"), "_id": F.lit(1), "_text": F.lit("theirs")})
    labels = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    good, toxic = (labels.where(F.col(c) == 1).select("doc_id") for c in ("quality", "toxic"))
    return audit(docs, queries.audited_filters(), good, toxic)


def test_audit_equals_plain_python(spark):
    rows = run_audit(spark, DOCS, LABELS).collect()
    expected = audited_by_hand(DOCS, LABELS)
    assert len(rows) == len(expected) and as_audit(rows) == expected


def test_audit_of_random_documents_with_a_hot_copy(spark):
    rng = random.Random(3)
    pool = ["x y", "A B C D", "# a", "a " * 210, "Z " * 205, " ".join(f"v{i}" for i in range(230))]
    docs = [(i, "hot text" if i % 3 else rng.choice(pool), rng.choice("pq"), 0) for i in range(300)]
    labels = [(i, rng.randint(0, 1), rng.randint(0, 1)) for i in range(0, 300, 2)]
    assert as_audit(run_audit(spark, docs, labels).collect()) == audited_by_hand(docs, labels)


def test_audit_without_rows_and_labels(spark):
    assert run_audit(spark, [], LABELS).count() == 0
    got = as_audit(run_audit(spark, DOCS, []).collect())
    assert got == audited_by_hand(DOCS, [])


def test_audit_joins_are_semi_and_anti(spark):
    state = spark.createDataFrame([(b"a", "p", 1)], "_id binary, part string, _n long")
    plan = filter_audit.removals({n: state for n in "ABCDE"})._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join LeftAnti") == 5 and "Cartesian" not in plan and "Inner" not in plan


# -- source mix


def mixed_by_hand(rows, weights=(5, 2, 1), limit=3):
    """(doc_id, source, size) to (source_size, target, copies), equal rows interchangeable."""
    sizes = defaultdict(int)
    for _, source, size in rows:
        sizes[source] += max(size or 0, 0)
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, targets = sum(sizes.values()), {}
    open_ = list(names)
    while open_:  # shares again until none is above
        level = Fraction(total - sum(targets.values()), sum(weight[s] for s in open_))
        above = [s for s in open_ if weight[s] * level >= limit * sizes[s]]
        if not above:
            targets |= {s: weight[s] * level for s in open_}
            break
        targets |= {s: Fraction(limit * sizes[s]) for s in above}
        open_ = [s for s in open_ if s not in above]
    return sizes, {s: float(t) for s, t in targets.items()}


MIX = [(i, f"s{i % 4}", (i * 37) % 50) for i in range(400)]


@pytest.mark.parametrize(
    "rows",
    [
        MIX,
        [(1, "a", 5)],
        [(1, None, 3), (2, "", 4), (3, "b", None), (4, "c", -2), (None, "b", 7), (None, "b", 7)],
        [(i, "tiny" if i < 3 else "big" if i < 200 else "é" if i < 220 else "\U0001f600", 1 if i < 3 else 20) for i in range(300)],
        [(7, "hot", 9)] * 500 + [(i, f"x{i}", i) for i in range(40)],
        [(1, "a", 0), (2, None, 0)],
    ],
)
def test_mix_targets_copies_and_reruns(spark, rows):
    frame = spark.createDataFrame(rows, "doc_id long, source string, size long").withColumns({"target": F.lit("x"), "_k": F.lit(1)})
    out = mix(frame)
    assert out.columns == ["doc_id", "source", "size", "_k", "source_size", "target", "copies"]
    got = out.collect()
    assert sorted(map(str, ((r.doc_id, r.source, r.size) for r in got))) == sorted(map(str, rows))
    sizes, targets = mixed_by_hand(rows)
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(targets[r.source], rel=1e-12)
        rate = targets[r.source] / sizes[r.source] if sizes[r.source] else 0
        assert math.floor(rate - 1e-9) <= r.copies <= min(3, math.ceil(rate + 1e-9))
    assert sum(targets.values()) == pytest.approx(sum(sizes.values()))
    by_source = defaultdict(list)
    for r in got:
        by_source[r.source].append(r)
    for source, own in by_source.items():
        taken = sum(r.copies * max(r.size or 0, 0) for r in own)
        assert abs(taken - targets[source]) <= 2 * max(max(r.size or 0, 0) for r in own) + 1e-6
        expected = len(own) * targets[source] / sizes[source] if sizes[source] else 0
        assert abs(sum(r.copies for r in own) - expected) <= 1 + 1e-6
    assert sorted(map(str, mix(frame.repartition(3)).collect())) == sorted(map(str, got))
    assert emitted(out).count() == sum(r.copies for r in got)


def test_mix_crosses_whole_numbers_of_the_prefix_sum(spark):
    frame = spark.createDataFrame(MIX, "doc_id long, source string, size long")
    got = {r.doc_id: r.copies for r in mix(frame).collect()}
    sizes, targets = mixed_by_hand(MIX)
    for source in sizes:
        own = sorted((size, key) for key, s, size in MIX if s == source)
        unit = 10**12
        start = int(hashlib.md5(f"mix:s{source}".encode()).hexdigest()[:8], 16) * unit >> 32
        rate = int(Fraction(targets[source]) / sizes[source] * unit)
        for i, (_, key) in enumerate(own):
            low, high = ((start + (rate + d) * (i + e)) // unit for d, e in ((-1, 0), (1, 1)))
            assert got[key] in range(high - low - 1, high - low + 2)
            if (start + rate * i) % unit > 1000 and (start + rate * (i + 1)) % unit > 1000:
                assert got[key] == (start + rate * (i + 1)) // unit - (start + rate * i) // unit


def test_mix_is_empty_for_no_rows_and_native(spark):
    none = spark.createDataFrame([], "doc_id long, source string, size long")
    assert mix(none).count() == 0
    plan = mix(spark.createDataFrame(MIX, none.schema))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


# -- hard negatives


def mined_by_hand(rows, is_anchor, k=5, m=5, low=80, high=100):
    rows = [
        (i, [math.floor(256 * x) for x in v], label)
        for i, v, label in rows
        if i is not None and v is not None and label is not None and all(x is not None and math.isfinite(x) for x in v)
    ]

    def score(a, b):
        s = sum(x * y for x, y in zip(a, b))
        return max(-(2**63 - 1), min(2**63 - 1, s))

    out = []
    for n, (a, va, la) in enumerate(rows):
        if not is_anchor(a):
            continue
        scored = sorted((-score(va, v), i, label == la) for j, (i, v, label) in enumerate(rows) if j != n)
        for s, p, _ in [x for x in scored if x[2]][:k]:
            window = [(t, i) for t, i, same in scored if not same and low * -s <= 100 * -t <= high * -s][:m]
            out += [(a, p, rank, i, -s, -t) for rank, (t, i) in enumerate(window, 1)]
    return Counter(out)


def mined(spark, rows, **options):
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    frame = frame.withColumns({"score": F.lit(1), "row": F.lit(2), "tile": F.lit(3), "id": F.lit("x")})
    return Counter(tuple(r) for r in mine(frame, F.col("vec_id") % 10 == 0, **options).collect())


@pytest.mark.parametrize("group", [40, 10_000])
def test_negatives_equal_plain_python(spark, group):
    rng = np.random.default_rng(5)
    centers = rng.normal(size=(6, 12))
    rows = [(i, (centers[i % 6] + 0.4 * rng.normal(size=12)).tolist(), int(rng.integers(0, 4))) for i in range(420)]
    rows += [(i, rows[i][1], 1) for i in range(0, 60, 3)]  # ids and vectors again
    rows += [(1000 + i, [0.25] * 12, i % 3) for i in range(150)]  # one very common vector
    assert mined(spark, rows, group=group) == mined_by_hand(rows, lambda i: i % 10 == 0)


def test_negatives_of_odd_rows(spark):
    rows = [
        (0, [1.0, 2.0], 1), (10, [1.0], 1), (20, [], 1), (30, None, 1), (40, [1.0, None], 1), (50, [math.nan, 1.0], 2),
        (60, [math.inf, 1.0], 1), (None, [1.0, 1.0], 1), (70, [1.0, 1.0], None), (1, [0.9, 1.8], 2), (2, [1.0, 1.9], 2),
        (80, [-1.0, -1.0], 1), (3, [0.9, 1.0], 2), (4, [1.0, 2.0], 1), (5, [1e18, 1e18], 2), (90, [3e17, -2e18], 2), (6, [1e18, 2.0], 1),
    ]
    assert mined(spark, rows) == mined_by_hand(rows, lambda i: i % 10 == 0)
    assert mined(spark, []) == Counter()
    assert mined(spark, [(0, [1e305, -1e308], 1), (1, [1e308, 1.0], 1), (2, [1.0, 1.0], 2)]) is not None
    assert mined(spark, [(0, [1.0], 1), (1, [1.0], 1)]) == Counter()


def test_boxes_bound_products_and_prune():
    rng = np.random.default_rng(2)
    vectors = np.floor(256 * np.concatenate([rng.normal(size=(500, 3)) + 9 * c for c in rng.normal(size=(8, 3))]))
    order = pack(vectors, 32)
    assert sorted(order.tolist()) == list(range(4000))
    n = np.arange(4000)
    forest = Forest(n, n, n % 2, vectors, page=32, fanout=4)
    query = vectors[7]
    for low, high in forest.levels:
        least, most = interval(low, high, query)
        assert (least <= most).all()
    scores = vectors @ query
    best = forest.search(query, 7, 1, True, [(-(2**62), 2**62)], 5, None)[0]
    expected = sorted((-int(s), i) for i, s in enumerate(scores) if i % 2 == 1 and i != 7)[:5]
    assert [(s, i) for s, i, _ in best] == expected
    assert forest.opened < len(forest.starts) // 2
