"""The registered queries of this package and their SQL."""

from __future__ import annotations

import string

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.llm import filter_audit
from daybook.llm.decontaminate import find_leaks
from daybook.llm.hard_negatives import mine
from daybook.llm.language_id import label_languages
from daybook.llm.language_id import train as train_languages
from daybook.llm.mix_sources import mix
from daybook.llm.page_text import main_texts
from daybook.llm.piece_encoding import encode_texts
from daybook.llm.ring_sharding import shard_rows
from daybook.llm.simhash_dedup import near_groups
from daybook.llm.substring_dedup import without_repeats
from daybook.llm.topk_search import top_products
from daybook.llm.toxicity import score_texts, train
from daybook.llm.url_filter import filter_urls
from daybook.session import ship_package

#: The rules that the URL query applies.
URL_RULES = """SELECT * FROM VALUES
  ('net', '/', 'block'),
  ('example.net', '/en/', 'allow'),
  ('example.com', '/de/', 'block'),
  ('org', '/fr/', 'allow') AS t(host, path, verdict)"""
SHARDS = 24


PIECE_MODEL = "piece_bpe_32k.model"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_file(name: str = PIECE_MODEL) -> bytes:
    """A public vocabulary file's content; read on the driver, shipped to the tasks."""
    import public_tokenizers

    with open(public_tokenizers.path(name), "rb") as f:
        return f.read()


def op1_decontamination(spark, sf_dir):
    """Every document's words inside benchmark windows, and the items."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return find_leaks(docs, _table(spark, sf_dir, "benchmark")).select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def training_labels(spark, sf_dir):
    """The rows of ``labels`` that may be learned from."""
    return _table(spark, sf_dir, "labels").where(F.crc32(F.col("doc_id").cast("string")) % 5 != 0)


def op2_toxicity(spark, sf_dir):
    """Every document's toxicity score."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(docs, training_labels(spark, sf_dir))
    return score_texts(docs, model).select(
        "doc_id",
        F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op3_ring_sharding(spark, sf_dir):
    """Every document's shard and slot on the bounded ring."""
    rows = _table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 8).cast("long").alias("size"),
        F.coalesce(F.crc32("text"), F.lit(0)).cast("long").alias("text_crc32"),
    )
    return shard_rows(rows, "doc_id", SHARDS).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "home_shard",
    )


def op4_url_filter(spark, sf_dir):
    """Every page's host, path, rule and verdict."""
    pages = _table(spark, sf_dir, "pages").select("page_id", "url")
    return filter_urls(pages, spark.sql(URL_RULES)).select("page_id", "host", "path", "rule", "verdict")


def op5_simhash_dedup(spark, sf_dir):
    """Every document's fingerprint and component."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return near_groups(docs).select(
        "doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id"
    )


def op6_language_id(spark, sf_dir):
    """Every document's predicted language."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
    net = train_languages(docs.where(~held_out))
    return label_languages(docs.drop("lang"), net).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score"
    )


def op7_piece_encoding(spark, sf_dir):
    """Every document's ids and what they decode to, as digests."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return encode_texts(docs, tokenizer_file()).select(
        "doc_id",
        "n_tokens",
        F.sha2("piece_ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op8_substring_dedup(spark, sf_dir):
    """Every document's repeated bytes, and the others as a digest and as text."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    span_bytes = F.aggregate("removed", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return without_repeats(docs).select(
        "doc_id",
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
        span_bytes.alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
        F.make_valid_utf8(F.col("kept").cast("string")).alias("kept"),
    )


def op9_topk_search(spark, sf_dir):
    """The five best candidates of every fiftieth vector."""
    vectors = _table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return top_products(vectors, F.col("vec_id") % 50 == 0)


def op10_page_text(spark, sf_dir):
    """Every page's main text."""
    pages = _table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return main_texts(pages).select("page_id", "url", "text", "n_chars")


def audited_filters():
    """The five filters of the audit, as conditions over whole texts."""
    words = F.regexp_extract_all("_text", F.lit(filter_audit.WORD), F.lit(0))
    capitals = F.length("_text") - F.length(F.translate("_text", string.ascii_uppercase, ""))
    return {
        "A": F.size(words) < 200,
        "B": 100 * F.size(F.array_distinct(words)) < 50 * F.size(words),
        "C": 100 * capitals > 2 * F.length("_text"),
        "D": F.col("_text").rlike(r"[#$%&*|]"),
        "E": filter_audit.COPY,
    }


def op11_filter_audit(spark, sf_dir):
    """What each of five filters removes, in every source and order."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    labels = _table(spark, sf_dir, "labels")
    good, toxic = (labels.where(F.col(c) == 1).select("doc_id") for c in ("quality", "toxic"))
    return filter_audit.audit(docs, audited_filters(), good, toxic)


def op12_source_mix(spark, sf_dir):
    """Every document's part in a mix of the sources by weight."""
    docs = _table(spark, sf_dir, "documents").select(
        "doc_id",
        "source",
        F.regexp_count(F.coalesce("text", F.lit("")), F.lit(filter_audit.WORD)).cast("long").alias("size"),
    )
    mixed = mix(docs)
    return mixed.select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "source", "copies"
    )


def op13_hard_negatives(spark, sf_dir):
    """Hard negatives of every hundredth vector, some of whose labels are moved on by one."""
    vec = F.col("vec_id")
    moved = F.when(vec % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = _table(spark, sf_dir, "embeddings").select("vec_id", "embedding", moved.alias("label"))
    return mine(vectors, vec % 100 == 0)


QUERIES = {
    "op1_decontamination": op1_decontamination,
    "op2_toxicity": op2_toxicity,
    "op3_ring_sharding": op3_ring_sharding,
    "op4_url_filter": op4_url_filter,
    "op5_simhash_dedup": op5_simhash_dedup,
    "op6_language_id": op6_language_id,
    "op7_piece_encoding": op7_piece_encoding,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_topk_search": op9_topk_search,
    "op10_page_text": op10_page_text,
    "op11_filter_audit": op11_filter_audit,
    "op12_source_mix": op12_source_mix,
    "op13_hard_negatives": op13_hard_negatives,
}

ORACLE_SQL = {
    "op1_decontamination": r"""
        WITH d AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
            FROM documents),
        i AS (
            SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
            FROM benchmark),
        iw AS (SELECT item_id, w, least(len(w), 10) AS n, unnest(range(1, greatest(len(w) - 8, 2))) AS p
               FROM i WHERE len(w) > 0),
        win AS (SELECT DISTINCT item_id, n, array_to_string(w[p : p + n - 1], ' ') AS key FROM iw),
        sizes AS (SELECT DISTINCT n FROM win),
        dp AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS p FROM d),
        dw AS (SELECT doc_id, p, n, array_to_string(w[p : p + n - 1], ' ') AS key
               FROM dp, sizes WHERE p + n - 1 <= len(w)),
        hit AS (SELECT doc_id, p, n, item_id FROM dw JOIN win USING (n, key)),
        covered AS (SELECT doc_id, count(DISTINCT q) AS n_hit
                    FROM (SELECT doc_id, unnest(range(p, p + n)) AS q FROM (SELECT DISTINCT doc_id, p, n FROM hit))
                    GROUP BY doc_id),
        listed AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items
                   FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item_id FROM hit) GROUP BY doc_id)
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
               coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
               coalesce(n_hit, 0) > 0 AS contaminated
        FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN listed USING (doc_id)""",
    "op4_url_filter": r"""
        WITH u AS (
            SELECT page_id,
                   translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''),
                             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                   coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
            FROM pages),
        m AS (
            SELECT *, ('.' || host) LIKE '%.net' AND path LIKE '/%' AS net,
                   ('.' || host) LIKE '%.example.net' AND path LIKE '/en/%' AS net_en,
                   ('.' || host) LIKE '%.example.com' AND path LIKE '/de/%' AS com_de,
                   ('.' || host) LIKE '%.org' AND path LIKE '/fr/%' AS org_fr
            FROM u)
        SELECT page_id, host, path,
               CASE WHEN net_en THEN 'example.net/en/' WHEN com_de THEN 'example.com/de/'
                    WHEN org_fr THEN 'org/fr/' WHEN net THEN 'net/' END AS rule,
               CASE WHEN net_en OR org_fr THEN 'allow' WHEN com_de OR net THEN 'block' ELSE 'allow' END AS verdict
        FROM m""",
    "op9_topk_search": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
            FROM embeddings
            WHERE vec_id IS NOT NULL AND len(embedding) > 0
              AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
        s AS (
            SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
            FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id),
        r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
              FROM s)
        SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5""",
    "op11_filter_audit": r"""
        WITH w AS (
            SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
                   regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
            FROM documents),
        f AS (
            SELECT doc_id, part,
                   CAST(len(words) < 200 AS INT)
                   + 2 * CAST(100 * len(list_distinct(words)) < 50 * len(words) AS INT)
                   + 4 * CAST(100 * len(regexp_replace(t, '[^A-Z]+', '', 'g')) > 2 * len(t) AS INT)
                   + 8 * CAST(regexp_matches(t, '[#$%&*|]') AS INT)
                   + 16 * CAST(coalesce(min(doc_id) OVER (PARTITION BY t) < doc_id, false) AS INT) AS fails
            FROM w),
        l AS (SELECT doc_id, max(CAST(quality = 1 AS INT)) AS good, max(CAST(toxic = 1 AS INT)) AS toxic
              FROM labels GROUP BY doc_id),
        c AS (
            SELECT part, fails, count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic
            FROM f LEFT JOIN l USING (doc_id) GROUP BY part, fails),
        x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS a),
        o AS (
            SELECT [p.a, q.a, r.a, s.a, t.a] AS o FROM x p, x q, x r, x s, x t
            WHERE len(list_distinct([p.a, q.a, r.a, s.a, t.a])) = 5),
        st AS (SELECT o, unnest(range(1, 6)) AS step FROM o),
        b AS (
            SELECT array_to_string(o, '') AS filter_order, CAST(step AS INT) AS step,
                   1 << (ascii(o[step]) - 65) AS own,
                   CAST(coalesce(list_sum(list_transform(o[1 : step - 1], lambda g: 1 << (ascii(g) - 65))), 0) AS INT) AS before
            FROM st),
        r AS (
            SELECT part, filter_order, step, own,
                   sum(CASE WHEN fails & (own | before) = 0 THEN n ELSE 0 END) AS kept,
                   sum(CASE WHEN fails & own <> 0 AND fails & before = 0 THEN n ELSE 0 END) AS removed,
                   sum(CASE WHEN fails & own <> 0 AND fails & before <> 0 THEN n ELSE 0 END) AS redundant,
                   sum(CASE WHEN fails = own THEN n ELSE 0 END) AS unique_fails,
                   sum(CASE WHEN fails & own <> 0 AND fails & before = 0 THEN good ELSE 0 END) AS good_lost,
                   sum(CASE WHEN fails & own <> 0 AND fails & before = 0 THEN toxic ELSE 0 END) AS toxic_lost
            FROM c, b GROUP BY part, filter_order, step, own)
        SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
               CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
               CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
               CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
        FROM r""",
    "op12_source_mix": r"""
        WITH d AS (
            SELECT doc_id, source, coalesce('s' || source, 'n') AS k,
                   CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
            FROM documents),
        s AS (SELECT k, CAST(sum(size) AS HUGEINT) AS ss, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS r
              FROM d GROUP BY k, source),
        w AS (SELECT *, CAST([5, 2, 1][r % 3 + 1] AS HUGEINT) AS w FROM s),
        p AS (SELECT *, coalesce(sum(ss) OVER o, 0) AS sb, coalesce(sum(w) OVER o, 0) AS wb,
                     sum(ss) OVER () AS total, sum(w) OVER () AS heavy
              FROM w WINDOW o AS (ORDER BY ss * (10 // w), r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
        c AS (SELECT *, 3 * ss * (heavy - wb) <= w * (total - 3 * sb) AS capped FROM p),
        m AS (SELECT *, CAST(sum(total) FILTER (WHERE r = 0) OVER () - 3 * coalesce(sum(ss) FILTER (WHERE capped) OVER (), 0) AS HUGEINT) AS rest,
                     CAST(coalesce(sum(w) FILTER (WHERE NOT capped) OVER (), 1) AS HUGEINT) AS among
              FROM c),
        t AS (SELECT k, CAST(ss AS BIGINT) AS source_size,
                     CASE WHEN capped THEN CAST(3 * ss AS DOUBLE) ELSE CAST(w * rest AS DOUBLE) / CAST(among AS DOUBLE) END AS target,
                     CASE WHEN ss = 0 THEN 0 WHEN capped THEN 3000000000000
                          ELSE (w * rest * 1000000000000) // (among * ss) END AS rate,
                     (CAST('0x' || md5('mix:' || k)[1:8] AS UBIGINT)::HUGEINT * 1000000000000) // 4294967296 AS off
              FROM m),
        n AS (SELECT doc_id, k, source, size, row_number() OVER (PARTITION BY k ORDER BY size, doc_id NULLS FIRST) AS i FROM d),
        e AS (SELECT doc_id, source, size, source_size, target,
                     CAST((off + rate * i) // 1000000000000 - (off + rate * (i - 1)) // 1000000000000 AS BIGINT) AS copies
              FROM n JOIN t USING (k))
        SELECT doc_id, size, source_size, target, copies * size AS taken, source, copies FROM e""",
    "op13_hard_negatives": """
        WITH v AS (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                   list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
            FROM embeddings
            WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
        s AS (
            SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
                   CAST(list_dot_product(a.e, c.e) AS BIGINT) AS score
            FROM v a JOIN v c ON a.vec_id % 100 = 0 AND a.vec_id <> c.vec_id),
        p AS (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS i FROM s WHERE same),
        n AS (
            SELECT p.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id,
                   p.score AS positive_score, s.score AS negative_score,
                   CAST(row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY s.score DESC, s.vec_id) AS INT) AS rank
            FROM p JOIN s ON p.i <= 5 AND s.anchor_id = p.anchor_id AND NOT s.same
             AND 80 * p.score <= 100 * s.score AND s.score <= p.score)
        SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5""",
}
