"""Decontamination, encoding, repeats, fingerprints: against brute force on odd rows."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from daybook.llm import queries
from daybook.llm.decontaminate import Benchmark, find_leaks, remove_leaks
from daybook.llm.piece_encoding import ChunkTable, encode_texts
from daybook.llm.simhash_dedup import LEAST_BOUND, components, dealt_labels, fingerprint_of, label_links, near_groups, near_links, one_of_each_group
from conftest import SF001
from daybook.llm.substring_dedup import STRETCH, _anchor_rows, _merged, anchors, without_repeats

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


# --- decontamination


def leaks_by_hand(text, items, window=10):
    words = WORD.findall(lower(text))
    hit, listed = set(), set()
    for item_id, item in items:
        own = WORD.findall(lower(item))
        if not own:
            continue
        n = min(window, len(own))
        windows = {tuple(own[i : i + n]) for i in range(len(own) - n + 1)}
        for p in range(len(words) - n + 1):
            if tuple(words[p : p + n]) in windows:
                hit |= set(range(p, p + n))
                if item_id is not None:
                    listed.add(str(item_id))
    return len(words), len(hit), sorted(listed)


def leak_rows():
    r = random.Random(5)
    vocabulary = ["the", "of", "Und", "éa", "x9", "漢字", "a", "b"]
    items = [(i, " ".join(r.choices(vocabulary, k=r.randint(1, 25)))) for i in range(12)]
    items += [(3, items[3][1]), (None, " ".join(r.choices(vocabulary, k=12))), (77, None), (78, ""), (79, "..."), (80, "a b a b a b a b a b a b")]
    texts = [None, "", "...", "a b " * 40, "THE of"]
    for _ in range(60):
        parts = r.choices(vocabulary, k=r.randint(0, 40))
        item = r.choice(items)[1] or ""
        parts[len(parts) // 2 : len(parts) // 2] = [item.upper() if r.random() < 0.5 else item.replace(" ", ",\n")]
        texts.append(" - ".join(parts) if r.random() < 0.3 else " ".join(parts))
    return items, texts + texts[:7]


@pytest.mark.parametrize("shard,block", [(8 << 20, 16 << 20), (50, 150)])
def test_leaks_equal_brute_force(spark, shard, block):
    items, texts = leak_rows()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string").withColumn("items", F.lit("mine"))
    bench = spark.createDataFrame(items, "item_id int, text string")
    out = find_leaks(docs, bench, shard_bytes=shard, block_bytes=block)
    rows = out.collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert (r.n_words, r.n_hit, sorted(r["items"])) == leaks_by_hand(texts[r.doc_id], items), texts[r.doc_id]
        assert sum(s.n_words for s in r.spans) == r.n_hit
        words = WORD.findall(lower(texts[r.doc_id]))
        for m in r.matches:
            same = [WORD.findall(lower(t)) for i, t in items if (None if i is None else str(i)) == m.item_id]
            found = words[m.start : m.start + m.n_words]
            assert len(found) == m.n_words and any(w[m.item_word : m.item_word + m.n_words] == found for w in same)
    clean = {r.doc_id for r in remove_leaks(docs, bench).collect()}
    assert clean == {r.doc_id for r in rows if not r.n_hit}


def test_longest_match_and_place(spark):
    item = " ".join(f"w{i}" for i in range(30))
    docs = spark.createDataFrame([(1, "x y " + " ".join(f"w{i}" for i in range(4, 25)) + " z")], "doc_id int, text string")
    bench = spark.createDataFrame([(9, item)], "item_id int, text string")
    row = find_leaks(docs, bench).first()
    assert [(m.start, m.n_words, m.item_id, m.item_word) for m in row.matches] == [(2, 21, "9", 4)]


def test_every_place_of_an_item_has_its_longest_match(spark):
    words = [f"w{i}" for i in range(40)]
    items = [(1, " ".join(words[:20])), (2, " ".join(["x", *words[5:35]])), (2, " ".join(words[5:35])), (3, " ".join(words[8:18] * 2))]
    docs = spark.createDataFrame([(1, " ".join(["a", *words[3:30], "b"]))], "doc_id int, text string")
    for block in (4 << 20, 60):
        row = find_leaks(docs, spark.createDataFrame(items, "item_id int, text string"), block_bytes=block).first()
        got = sorted((m.item_id, m.start, m.n_words, m.item_word) for m in row.matches)
        assert got == [("1", 1, 17, 3), ("2", 3, 25, 0), ("2", 3, 25, 1), ("3", 6, 10, 0), ("3", 6, 10, 10)]
        assert row.spans == [(1, 27)] and row["items"] == ["1", "2", "3"]


def test_index_of_a_block_is_small():
    import tracemalloc

    r = random.Random(1)
    vocabulary = ["".join(r.choices("abcdefghij", k=5)) for _ in range(20_000)]
    items = [(str(i), " ".join(r.choices(vocabulary, k=200)).encode()) for i in range(1700)]  # 2 MB
    tracemalloc.start()
    bench = Benchmark(items, 10)
    held, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert len(bench.low) == 1700 * 191 and held < 40 << 20 and peak < 80 << 20


def test_no_benchmark(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id int, text string")
    none = spark.createDataFrame([], "item_id int, text string")
    assert find_leaks(docs, none).select("n_words", "n_hit").first() == (3, 0)
    assert find_leaks(docs.limit(0), none).count() == 0


# --- encoding


@pytest.fixture(scope="module")
def pieces():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_proto=queries.tokenizer_file())


ODD = [" ", "  ", "▁", "\n", "\t", "a", "the", "é", "漢", "🙂", "​", "\x00", "0", "ing", ".", "　", "<s>", "</s>", "<0x41>", "x" * 70, "ﬁ", "Ａ", "﻿"]


def test_chunks_equal_the_library(pieces):
    table, r = ChunkTable(queries.tokenizer_file(), 200, 30), random.Random(3)
    for _ in range(4000):
        text = "".join(r.choice(ODD) for _ in range(r.randint(0, 12)))
        ids = pieces.encode(text, add_bos=True, add_eos=True)
        assert table.encode(text) == (np.array(ids, "<u4").tobytes(), pieces.decode(ids)), repr(text)


def test_encoding_rows(spark, pieces):
    texts = [None, "", " ", "word", "word", "y" * 50_000, "a  b▁c\n" * 2000]
    docs = spark.createDataFrame([(i, t, "mine") for i, t in enumerate(texts)], "doc_id int, text string, decoded string")
    out = {r.doc_id: r for r in encode_texts(docs, queries.tokenizer_file()).collect()}
    for i, t in enumerate(texts):
        ids = pieces.encode(t or "", add_bos=True, add_eos=True)
        assert bytes(out[i].piece_ids) == np.array(ids, "<u4").tobytes() and out[i].n_tokens == len(ids)
        assert out[i].decoded == pieces.decode(ids)
    assert encode_texts(docs.limit(0), queries.tokenizer_file()).count() == 0


# --- repeats


def repeats_by_hand(texts, length, words=0):
    raws = [(t or "").encode() for t in texts]
    seen = Counter(r[i : i + length] for r in raws for i in range(len(r) - length + 1))
    out = []
    for r in raws:
        covered = np.zeros(len(r), bool)
        for i in range(len(r) - length + 1):
            if seen[r[i : i + length]] > 1:
                covered[i : i + length] = True
        edges = np.flatnonzero(np.diff(np.concatenate([[0], covered, [0]])))
        for a, b in zip(edges[::2], edges[1::2], strict=True):
            inside = sum(a <= m.start() and m.end() <= b for m in re.finditer(rb"\S+", r))
            covered[a:b] = not words or inside > words
        out.append((bytes(np.frombuffer(r, np.uint8)[~covered]), int(covered.sum())))
    return out


def repeat_rows():
    r = random.Random(11)
    block = lambda n: "".join(r.choices("abcdefghij é漢\n", k=n))
    passages = [block(450), block(700), block(405)]
    texts = [None, "", "x" * 399, "z" * 900, block(3000)]
    for _ in range(25):
        texts.append(block(r.randint(0, 400)) + r.choice(passages) + block(r.randint(0, 300)) + r.choice(passages)[r.randint(0, 60) :])
    base = block(2500)
    for at in range(100, 2400, 230):  # near copies
        texts.append(base[:at] + "#" + base[at + 1 :])
    texts += [texts[4], texts[7], base, passages[2], passages[2][1:], passages[0][20:] + passages[1][:390]]
    return texts


def test_repeats_equal_brute_force(spark):
    texts = repeat_rows()
    docs = spark.createDataFrame([(i, t, "mine") for i, t in enumerate(texts)], "doc_id int, text string, kept string")
    rows = {r.doc_id: r for r in without_repeats(docs).collect()}
    assert len(rows) == len(texts)
    for i, (kept, removed) in enumerate(repeats_by_hand(texts, 400)):
        spans = [(s.start, s.end) for s in rows[i].removed]
        assert bytes(rows[i].kept) == kept, i
        assert sum(b - a for a, b in spans) == removed
        assert all(a < b for a, b in spans) and all(x[1] < y[0] for x, y in zip(spans, spans[1:]))
    decoded = {r.doc_id: r.kept for r in without_repeats(docs, decode=True).collect()}
    assert all(decoded[i] == bytes(rows[i].kept).decode("utf-8", "ignore") for i in rows)
    assert without_repeats(docs.limit(0)).count() == 0


@pytest.mark.parametrize("length", [32, 200, 401])
def test_repeats_of_other_lengths(spark, length):
    texts = repeat_rows() + ["ab" * 40_000, "ab" * 40_000 + "c"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    rows = {r.doc_id: r for r in without_repeats(docs, length=length).collect()}
    for i, (kept, removed) in enumerate(repeats_by_hand(texts, length)):
        assert bytes(rows[i].kept) == kept and sum(s.end - s.start for s in rows[i].removed) == removed, i


def test_only_runs_of_more_words_go(spark):
    r = random.Random(4)
    own = lambda n: " ".join("".join(r.choices("abcdefgh", k=6)) for _ in range(n))
    for n, gone in ((50, False), (51, True), (90, True)):
        passage = own(n)
        texts = [f"{own(30)} \n{passage}\n {own(20)}" for _ in range(3)]
        docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
        kept = without_repeats(docs, length=200, words=50, decode=True).collect()
        assert all((passage not in x.kept) == gone and (x.kept == x.text) != gone for x in kept)


def test_long_text_is_one_text():
    r = random.Random(8)
    text = bytes(r.choices(b"abcd ", k=2 * STRETCH + 777))
    core, hull, place, low, high = _anchor_rows(text, 400)
    chosen = np.concatenate([np.full(h - lo + 1, p) for p, lo, h in zip(place, low, high, strict=True)])
    assert len(chosen) == len(text) - 399 and (np.diff(place) > 0).all()
    names = {}
    for p, c, lo, h, x in zip(place, core, low, high, hull, strict=True):
        assert names.setdefault(text[p - 100 : p + 108], c) == c
        assert names.setdefault((text[p - h : p - lo + 400], lo, h), x) == x
    assert len(set(names.values())) == len(names)


def test_registered_repeats_equal_brute_force(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").collect()
    rows = {r.doc_id: r for r in queries.op8_substring_dedup(spark, SF001).collect()}
    for d, (kept, removed) in zip(docs, repeats_by_hand([d.text for d in docs], 400), strict=True):
        r = rows[d.doc_id]
        assert (r.n_bytes, r.n_removed) == (len((d.text or "").encode()), removed)
        assert r.kept_sha256 == hashlib.sha256(kept).hexdigest() and (removed > 0) == (r.n_spans > 0)
        assert r.kept == kept.decode("utf-8", "replace")


def test_equal_windows_choose_the_same_place():
    r = random.Random(2)
    text = bytes(r.choices(b"abcd ", k=3000))
    for shift in (1, 7, 300):
        moved = bytes(r.choices(b"abcd ", k=shift)) + text
        for a, b in ((anchors(text, 400), anchors(moved, 400)),):
            where = {w: p for p, f, e in zip(*a, strict=True) for w in range(f, e + 1)}
            other = {w: p for p, f, e in zip(*b, strict=True) for w in range(f, e + 1)}
            assert len(where) == 2601 and all(other[w + shift] == p + shift for w, p in where.items())


def test_spans_merge():
    spans = [{"start": 5, "end": 9}, {"start": 0, "end": 5}, {"start": 20, "end": 22}]
    assert _merged(spans) == [(0, 9), (20, 22)] and _merged(None) == []


# --- fingerprints


def print_by_hand(text):
    words = re.findall("[^\x20\x09-\x0d]+", lower(text))
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) > 2 else [" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if hashes and 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints_equal_brute_force():
    r = random.Random(1)
    for text in [None, "", " \n", "A", "A b", "a B c", "é\x0bÉ\x0c\xa0 x", *(" ".join(r.choices("ab cD é".split(), k=r.randint(0, 50))) for _ in range(50))]:
        assert fingerprint_of(text.encode() if text else None, 3) == print_by_hand(text)


def roots_by_hand(prints):
    parent = list(range(len(prints)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3:
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(prints))]


def near_prints(seed, centres=12, n=160):
    r = random.Random(seed)
    base = [r.getrandbits(64) for _ in range(centres)]
    out = {0, (1 << 64) - 1}
    while len(out) < n:
        x = r.choice(base)
        for _ in range(r.choice((0, 1, 2, 3, 3, 4, 5))):
            x ^= 1 << r.randrange(64)
        out.add(x)
    return sorted(out)


@pytest.mark.parametrize("seed,points", [(1, 1 << 21), (2, 400), (3, 20)])
def test_links_connect_what_brute_force_connects(spark, seed, points):
    prints = near_prints(seed)
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    links = near_links(spark.createDataFrame(signed, "fingerprint long"), label_points=points).collect()
    at = {s[0]: i for i, s in enumerate(signed)}
    assert all((prints[at[x.a]] ^ prints[at[x.b]]).bit_count() <= 3 for x in links)
    parent = list(range(len(prints)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for x in links:
        a, b = root(at[x.a]), root(at[x.b])
        parent[max(a, b)] = min(a, b)
    assert [root(i) for i in range(len(prints))] == roots_by_hand(prints)


def test_labels_of_near_copies_are_split(spark):
    r = random.Random(5)
    prints = sorted({(0xC0FFEE << 40) ^ sum(1 << b for b in r.sample(range(40), r.randint(0, 7))) for _ in range(400)} | {0, (1 << 64) - 1})
    signed = [(x - (1 << 64) if x >> 63 else x,) for x in prints]
    frame = spark.createDataFrame(signed, "fingerprint long")
    points = {}
    for row in dealt_labels(frame, label_points=1 << 14).collect():
        own, rest = row.fingerprint % (1 << 64), 64 - row.bits
        left = (1 if own.bit_count() % 2 else 2) - ((own >> rest) ^ row.label).bit_count()
        points[row.label, row.bits] = points.get((row.label, row.bits), 0) + (1, rest, 1 + rest * (rest - 1) // 2)[left]
    # Every point of every ball once, and no label with too many of them.
    assert sum(points.values()) == sum(64 if x.bit_count() % 2 else 2017 for x in prints)
    assert max(points.values()) <= LEAST_BOUND and len({bits for _, bits in points}) > 1
    links = near_links(frame, label_points=1 << 14).collect()
    at = {x: i for i, (x,) in enumerate(signed)}
    parent = list(range(len(prints)))
    for a, b in links:
        assert ((a ^ b) % (1 << 64)).bit_count() <= 3
        a, b = at[a], at[b]
        while parent[a] != a:
            a = parent[a]
        while parent[b] != b:
            b = parent[b]
        parent[max(a, b)] = min(a, b)
    found = []
    for i in range(len(prints)):
        while parent[i] != i:
            i = parent[i]
        found.append(i)
    assert found == roots_by_hand(prints)


def test_pairs_at_every_distance_meet():
    for seed in range(40):
        r = random.Random(seed)
        a = r.getrandbits(64)
        for distance in (1, 2, 3):
            b = a
            for bit in r.sample(range(64), distance):
                b ^= 1 << bit
            found = sum(len(label_links(np.array([a, b], np.uint64), label, 6)) for label in range(64))
            assert found > 0, (a, b)


def test_components_of_long_chains(spark):
    chain = [(i, i + 1) for i in range(0, 40)] + [(100, 101), (103, 101), (500, 499)] + [(200, 200 + i) for i in range(1, 30)]
    got = {r.node: r.root for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert {got[i] for i in range(41)} == {0} and {got[i] for i in (100, 101, 103)} == {100}
    assert {got[200 + i] for i in range(30)} == {200} and got[500] == 499
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_groups_and_survivors(spark):
    long = " ".join(f"w{i}" for i in range(900))
    texts = [(7, long), (3, long + " end"), (9, None), (4, ""), (5, "other words here"), (5, "other words here"), (None, long.upper())]
    docs = spark.createDataFrame([(i, t, "s", "mine") for i, t in texts], "doc_id long, text string, source string, root string")
    rows = near_groups(docs).collect()
    prints = [print_by_hand(t) for _, t in texts]
    roots = roots_by_hand(prints)
    least = {}
    for (i, _), r in zip(texts, roots):
        least[r] = min((x for x in (least.get(r), i) if x is not None), default=None)
    expected = Counter((i, least[r]) for (i, _), r in zip(texts, roots))
    assert Counter((r.doc_id, r.component_id) for r in rows) == expected
    kept = one_of_each_group(docs)
    assert kept.columns == docs.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter(least[r] for r in set(roots))
    assert near_groups(docs.limit(0)).count() == 0 and one_of_each_group(docs.limit(0)).count() == 0


def test_digest(spark):
    assert hashlib.sha256(b"").hexdigest() == spark.sql("SELECT sha2(cast('' AS binary), 256)").first()[0]
