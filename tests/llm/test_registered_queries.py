"""Registered queries without SQL, column by column against plain Python on the given tables."""

from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict

import pytest

from conftest import SF001
from daybook.llm import queries
from test_text_operators import print_by_hand, roots_by_hand


@pytest.fixture(scope="module")
def docs(spark):
    return {r.doc_id: r for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()}


def test_ring_sharding(spark, docs):
    rows = queries.op3_ring_sharding(spark, SF001).collect()
    assert len(rows) == len(docs)
    slots = defaultdict(list)
    for r in rows:
        raw = (docs[r.doc_id].text or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(raw) + 8, zlib.crc32(raw), "rows", None)
        slots[r.shard].append(r.slot)
    assert set(slots) == set(range(24)) and all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1


def test_simhash_dedup(spark, docs):
    ids = sorted(docs)
    prints = [print_by_hand(docs[i].text) for i in ids]
    roots = roots_by_hand(prints)
    expected = {i: (format(p % (1 << 64), "016x"), ids[root]) for i, p, root in zip(ids, prints, roots, strict=True)}
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in queries.op5_simhash_dedup(spark, SF001).collect()}
    assert got == expected


def test_piece_encoding(spark, docs):
    import sentencepiece

    pieces = sentencepiece.SentencePieceProcessor(model_proto=queries.tokenizer_file())
    for r in queries.op7_piece_encoding(spark, SF001).collect():
        ids = pieces.encode(docs[r.doc_id].text or "", add_bos=True, add_eos=True)
        raw = b"".join(i.to_bytes(4, "little") for i in ids)
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(raw).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(pieces.decode(ids).encode()).hexdigest()
