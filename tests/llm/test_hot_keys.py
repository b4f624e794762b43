"""Joins of op4 and op5 on a key with a third of all rows are split."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from daybook.llm import simhash_dedup
from daybook.llm.simhash_dedup import add_fingerprints, near_groups
from daybook.llm.url_filter import filter_urls


@pytest.fixture()
def tiny_skew_thresholds(spark):
    conf = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def final_plan(df):
    rows = df.collect()
    return rows, df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


@pytest.mark.parametrize("hot", [None, "http://a.net/hot"])
def test_hot_urls_are_split(spark, tiny_skew_thresholds, hot):
    n = 9000
    url = F.when(F.col("id") % 3 == 0, F.lit(hot)).otherwise(F.concat(F.lit("http://h"), F.col("id"), F.lit(".net/x")))
    pages = spark.range(n, numPartitions=6).select(F.col("id").alias("page_id"), url.alias("url"), F.sha2(F.col("id").cast("string"), 512).alias("wide"))
    rules = spark.sql("SELECT 'net' AS host, '/' AS path, 'block' AS verdict")
    rows, plan = final_plan(filter_urls(pages, rules))
    assert "skew=true" in plan and len(rows) == n
    assert all((r.verdict == "allow") == (r.url is None) for r in rows)


def test_a_hot_component_is_split(spark, tiny_skew_thresholds, monkeypatch):
    n = 3000
    roots = spark.range(n).select(F.col("id").alias("node"), F.lit(0).cast("long").alias("root"))
    prints = spark.range(3 * n).select(F.col("id"))
    docs = prints.select(F.col("id").alias("doc_id"), F.concat(F.lit("w"), "id").alias("text"))
    # Fingerprints 0 to 8999; the first third is one component.
    monkeypatch.setattr(simhash_dedup, "add_fingerprints", lambda d, t, s: docs.select("doc_id", F.col("doc_id").alias("fingerprint")))
    monkeypatch.setattr(simhash_dedup, "near_links", lambda p: p)
    monkeypatch.setattr(simhash_dedup, "components", lambda links: roots)
    rows, plan = final_plan(near_groups(docs))
    assert "skew=true" in plan and len(rows) == 3 * n
    assert all(r.component_id == (0 if r.doc_id < n else r.doc_id) for r in rows)


def test_components_of_a_star_with_skew(spark, tiny_skew_thresholds):
    star = spark.range(1, 2000).select(F.col("id").alias("a"), F.lit(0).cast("long").alias("b"))
    chain = spark.range(5000, 5040).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    got = {r.node: r.root for r in simhash_dedup.components(star.union(chain)).collect()}
    assert got == {i: 0 for i in range(2000)} | {i: 5000 for i in range(5000, 5041)}


def test_labels_split_without_a_broadcast(spark, monkeypatch):
    docs = spark.range(300).select(F.col("id").alias("doc_id"), F.concat_ws(" ", *[F.lit(f"w{i}") for i in range(60)], F.col("id").cast("string")).alias("text"))
    monkeypatch.setattr(simhash_dedup, "LEAST_BOUND", 500)
    prints = add_fingerprints(docs, "text", 3).select("fingerprint").distinct()
    expected = sorted(map(tuple, simhash_dedup.dealt_labels(prints, 200).collect()))
    monkeypatch.setattr(simhash_dedup, "BROADCAST_LABELS", -1)
    assert sorted(map(tuple, simhash_dedup.dealt_labels(prints, 200).collect())) == expected
