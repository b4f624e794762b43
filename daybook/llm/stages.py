"""The operators as stages of a corpus pipeline: documents in, documents out.

Every stage but the encoding returns the columns of its input. Documents that
a stage rejects are left out; where a stage shortens a text, ``n_chars``
follows, and bytes of characters that were cut in two are dropped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.llm import queries
from daybook.llm.decontaminate import remove_leaks
from daybook.llm.piece_encoding import encode_texts
from daybook.llm.simhash_dedup import one_of_each_group
from daybook.llm.substring_dedup import without_repeats
from daybook.llm.toxicity import score_texts, train

#: What a passage is that repeats: more than so many words; they are found by strings of so many bytes.
PASSAGE_WORDS = 50
PASSAGE_BYTES = 200


def _columns(docs: DataFrame) -> list:
    return [F.col(f"`{c}`") for c in docs.columns]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below 0.5; learned from the labelled ones among them."""
    model = train(docs, queries.training_labels(spark, sf_dir))
    scored = score_texts(docs.withColumnRenamed("score", "_own_score"), model)
    return scored.where(F.col("score") < 0.5).drop("score").withColumnRenamed("_own_score", "score").select(*_columns(docs))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component: the one with the smallest id."""
    return one_of_each_group(docs, shingle=3)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of more than ``PASSAGE_WORDS`` words that repeat elsewhere.

    The bytes that repeat in ``PASSAGE_BYTES`` or more are found first; runs of
    them with more words go. So a passage is missed only if its words are
    shorter than four letters on average. A null text stays null; a document
    that loses all its text stays, empty.
    """
    own = docs.withColumnsRenamed({"removed": "_own_removed", "kept": "_own_kept"})
    cut = without_repeats(own, length=PASSAGE_BYTES, words=PASSAGE_WORDS, decode=True)
    changed = F.size("removed") > 0
    now = {"text": F.when(changed, F.col("kept")).otherwise(F.col("text"))}
    if "n_chars" in docs.columns:
        count = F.when(changed, F.length("kept")).otherwise(F.col("n_chars"))
        now["n_chars"] = count.cast(docs.schema["n_chars"].dataType)
    cut = cut.withColumns(now).drop("removed", "kept")
    return cut.withColumnsRenamed({"_own_removed": "removed", "_own_kept": "kept"}).select(*_columns(docs))


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no ten words in a row with a benchmark item."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return remove_leaks(docs, items)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their ids (32-bit little-endian) and number of ids."""
    encoded = encode_texts(docs, queries.tokenizer_file())
    return encoded.drop("decoded")


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_dedup", drop_near_copies),
    ("substring_dedup", cut_repeats),
    ("decontamination", drop_leaks),
    ("piece_encoding", encode),
]
