"""URL filter: a blocked Bloom filter in front of an exact hash join.

A list entry is a canonical URL start: a host (which stands for its
subdomains too) and a path start. All entries go into a blocked Bloom
filter: a table with one row for each 256-bit block, in which a key sets
eight bits. Each URL yields one key for every entry shape (number of host
labels, path length) in the list; keys whose bits are all set are possible
hits and go on to an exact hash join with the list, which removes the false
positives. The longest entry that fits decides; a URL with none passes.

Everything is DataFrame expressions. The filter and the list are broadcast
only when their measured sizes are below ``broadcast_limit``, and joined by
a shuffle otherwise (AQE splits a key that many URLs share).

Defined results: a null URL or one without ``://`` has an empty host and
path and passes; repeated URLs are judged once and repeated rows are kept;
an empty list passes all; input columns named like a result column are
replaced by it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.session import checkpoint_dir

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
RESULT = ("host", "path", "rule", "verdict")
WORDS = 4
BLOCK_BITS = 64 * WORDS
#: Bytes that a block's row takes in a broadcast hash table, with overhead.
BLOCK_ROW_BYTES = 120


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end; A-Z lower-cased."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def url_path(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks))


def _masks(key: Column) -> list[Column]:
    """Two bits in each word of the block, from a second hash."""
    bits = F.xxhash64(key, F.lit("bits"))

    def bit(n: int) -> Column:
        at = F.shiftrightunsigned(bits, 6 * n).bitwiseAND(F.lit(63)).cast("int")
        return F.call_function("shiftleft", F.lit(1).cast("long"), at)

    return [bit(2 * w).bitwiseOR(bit(2 * w + 1)) for w in range(WORDS)]


def block_count(entries: int, bits_per_key: int) -> int:
    return max(1, -(-entries * bits_per_key // BLOCK_BITS))


def blocked_bloom(keys: DataFrame, key: str, blocks: int) -> DataFrame:
    """One row for each block that has a key: its number and its words."""
    masks = _masks(F.col(key))
    return (
        keys.where(F.col(key).isNotNull())
        .select(_block(F.col(key), blocks).alias("_block"), *(m.alias(f"_m{i}") for i, m in enumerate(masks)))
        .groupBy("_block")
        .agg(*(F.bit_or(f"_m{i}").alias(f"_w{i}") for i in range(WORDS)))
    )


def possible_hits(keys: DataFrame, key: str, bloom: DataFrame, blocks: int, small: bool) -> DataFrame:
    """The rows of ``keys`` whose bits are all set in their block."""
    masks = _masks(F.col(key))
    all_set = masks[0].bitwiseAND(F.col("_w0")) == masks[0]
    for i in range(1, WORDS):
        all_set = all_set & (masks[i].bitwiseAND(F.col(f"_w{i}")) == masks[i])
    return (
        keys.withColumn("_block", _block(F.col(key), blocks))
        .join(F.broadcast(bloom) if small else bloom, "_block")
        .where(all_set)
        .select(*keys.columns)
    )


def filter_urls(
    pages: DataFrame,
    rules: DataFrame,
    url: str = "url",
    default: str = "allow",
    bits_per_key: int = 16,
    broadcast_limit: int = 64 << 20,
) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` and ``verdict``.

    ``rules`` has ``host``, ``path`` and ``verdict``; of equal entries the
    smallest verdict counts. The driver gets the list's size and its shapes,
    of which there are at most (labels of a host) x (lengths of a path).
    """
    listed = (
        rules.select(
            F.translate(F.coalesce("host", F.lit("")), UPPER, LOWER).alias("_h"),
            F.coalesce("path", F.lit("")).alias("_p"),
            F.col("verdict").alias("_verdict"),
        )
        .where(F.col("_h") != "")
        .withColumn("_rule", F.concat("_h", "_p"))
        .withColumn("_labels", F.size(F.split("_h", r"\.")))
        .withColumn("_length", F.length("_p"))
    )
    shapes = [
        (r["_labels"], r["_length"], r["n"], r["bytes"])
        for r in listed.groupBy("_labels", "_length")
        .agg(F.count("*").alias("n"), F.sum(F.octet_length("_rule") + 64).alias("bytes"))
        .collect()
    ]
    host, path = url_host(F.col(url)), url_path(F.col(url))
    out = pages.withColumns({"host": host, "path": path})
    if not shapes:
        return out.withColumns({"rule": F.lit(None).cast("string"), "verdict": F.lit(default)})

    entries = listed.groupBy("_rule").agg(F.min("_verdict").alias("_verdict"))
    blocks = block_count(sum(s[2] for s in shapes), bits_per_key)
    few_blocks = blocks * BLOCK_ROW_BYTES <= broadcast_limit
    few_rules = 3 * sum(s[3] for s in shapes) <= broadcast_limit

    def key_of(labels: int, length: int) -> Column:
        fits = (F.size(F.split("host", r"\.")) >= labels) & (F.length("path") >= length) & (F.col("host") != "")
        return F.when(fits, F.concat(F.substring_index("host", ".", -labels), F.substring("path", 1, length)))

    keys = (
        pages.select(F.col(url).alias("_url"))
        .where(F.col("_url").isNotNull())
        .distinct()
        .select("_url", url_host(F.col("_url")).alias("host"), url_path(F.col("_url")).alias("path"))
        .select("_url", F.explode(F.array_compact(F.array(*(key_of(a, b) for a, b, *_ in shapes)))).alias("_rule"))
    )
    hits = possible_hits(keys, "_rule", blocked_bloom(entries, "_rule", blocks), blocks, few_blocks)
    # What is aggregated is written out before a join: of two plain sides Spark can split a hot rule or URL.
    checkpoint_dir(pages.sparkSession)
    exact = hits.join(F.broadcast(entries) if few_rules else entries.checkpoint().hint("shuffle_hash"), "_rule")
    decided = exact.groupBy("_url").agg(
        F.max_by(F.struct("_rule", "_verdict"), F.struct(F.length("_rule"), "_rule")).alias("_best")
    ).checkpoint()
    return (
        out.join(decided, out[url] == decided["_url"], "left")
        .withColumns({"rule": F.col("_best._rule"), "verdict": F.coalesce("_best._verdict", F.lit(default))})
        .drop("_url", "_best")
    )
