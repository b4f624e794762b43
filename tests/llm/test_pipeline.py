"""The pipeline against the same stages in plain Python, and the registration of its queries."""

from __future__ import annotations

import random

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from conftest import SF001
from daybook.llm import queries, stages, toxicity
from test_models_and_pages import labelled
from test_text_operators import leaks_by_hand, print_by_hand, repeats_by_hand, roots_by_hand


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    at = str(tmp_path_factory.mktemp("tables"))
    r = random.Random(9)
    rows = labelled(7, 260)
    texts = {i: t for i, t, _ in rows}
    items = [(1, texts[3]), (2, "one short item"), (3, " ".join(f"q{i}" for i in range(20)))]
    passage = " ".join(f"passage{i}é" for i in range(60))
    texts[400] = "before " + " ".join(f"q{i}" for i in range(4, 18)) + " after"
    texts[401] = "here ONE, short\nITEM there"
    for i in range(402, 406):
        texts[i] = " ".join(r.choices("ra mi ken sul ver".split(), k=40)) + " " + passage + f" end{i}é"
    texts[410], texts[411], texts[412] = texts[5], texts[5] + " ", texts[5].upper()
    texts[420], texts[421] = "", None
    for i in range(500, 540):  # passages of 51 to 90 words, each in two documents
        own = lambda n: " ".join("".join(r.choices("bcdfgklm", k=5)) for _ in range(n))
        words = " ".join(f"p{i // 2}x{n}x" for n in range(51 + (i // 2 - 250) * 2))
        texts[i] = f"rare {own(120)} {words} {own(120)}"
    frame = [(i, t, "en", "s", None if t is None else len(t), "extra") for i, t in sorted(texts.items())]
    schema = "doc_id long, text string, lang string, source string, n_chars long, kept string"
    spark.createDataFrame(frame, schema).write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame([(i, 1, y) for i, _, y in rows], "doc_id long, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{at}/benchmark.parquet")
    return at, texts, items


def by_hand(spark, at, texts, items):
    import sentencepiece

    docs = spark.read.parquet(f"{at}/documents.parquet")
    model = toxicity.train(docs, queries.training_labels(spark, at))
    measure = toxicity.Distance(model.toxic, model.ordinary)
    kept = {i: t for i, t in sorted(texts.items()) if toxicity.score_of(t, model, measure) < 0.5}
    yield set(kept)
    ids = list(kept)
    roots = roots_by_hand([print_by_hand(kept[i]) for i in ids])
    kept = {ids[k]: kept[ids[k]] for k in sorted(set(roots))}
    yield set(kept)
    cut = repeats_by_hand(list(kept.values()), stages.PASSAGE_BYTES, stages.PASSAGE_WORDS)
    kept = {i: None if t is None else k.decode("utf-8", "ignore") for (i, t), (k, _) in zip(kept.items(), cut, strict=True)}
    yield set(kept)
    kept = {i: t for i, t in kept.items() if not leaks_by_hand(t, items)[1]}
    yield set(kept)
    pieces = sentencepiece.SentencePieceProcessor(model_proto=queries.tokenizer_file())
    yield {(i, t, None if t is None else len(t), tuple(pieces.encode(t or "", add_bos=True, add_eos=True))) for i, t in kept.items()}


def test_run_equals_plain_python(spark, tables):
    at, texts, items = tables
    *kept, expected = by_hand(spark, at, texts, items)
    sizes = [len(texts), *map(len, kept)]
    assert all(a > b for a, b in zip(sizes[:2], sizes[1:])) and sizes[2] < sizes[1] and sizes[4] < sizes[3]
    out = corpus_pipeline.run(spark, at)
    got = {(r.doc_id, r.text, r.n_chars, tuple(int.from_bytes(r.piece_ids[k : k + 4], "little") for k in range(0, 4 * r.n_tokens, 4))) for r in out.collect()}
    assert got == expected
    assert {r.kept for r in out.collect()} == {"extra"}
    planted = {i: t for i, t, *_ in got if i >= 500}
    assert len(planted) == 40 and all(f"p{i // 2}x40x" not in t and "rare" in t for i, t in planted.items())
    short = [t for i, t, *_ in got if i in range(402, 406)]
    assert short and all("passage30" not in t for t in short)


def test_stages_keep_the_columns(spark, tables):
    docs = spark.read.parquet(f"{tables[0]}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "simhash_dedup", "substring_dedup", "decontamination", "piece_encoding"]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, tables[0])
        assert out.dtypes == docs.dtypes
        assert stage(spark, docs.limit(0), tables[0]).count() == 0


def test_queries_are_registered(spark):
    found = entry.queries()
    assert [k for k in found if k.startswith("op")] == [*queries.QUERIES]
    assert len(queries.QUERIES) == 13 and found["pipeline"] is corpus_pipeline.run
    assert set(queries.ORACLE_SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_sql_agrees(spark, name):
    from oracle_harness import compare

    rep = compare(spark, SF001, [name], verbose=False)[name]
    assert rep["cols"] and rep["values"] and rep["rows"] == rep["oracle_rows"], rep
