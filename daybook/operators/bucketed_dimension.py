"""First-order dimension in buckets: joined without moving it, merged where it changes.

The same (email, first_order_date) rows as ``operators.dimension``, kept in a
catalog table that is clustered by email into a fixed number of buckets. Two
things follow:

* Spark knows from the catalog how the rows are dealt out. The daily job's
  distinct and its join on email read bucket by bucket; only the day's
  customers are shuffled, never the dimension.
* The table is also partitioned by the bucket's number, computed by the same
  hash that Spark deals buckets by, so every bucket is a folder with one file.
  A merge reads the buckets that the new lines hash to, finds the customers
  that are new or now earlier, and rewrites the buckets of those alone. The
  other folders keep their files.

A write goes to a folder of its own below the table's location
(``_versions/<version>/bucket=...``) and the catalog's partitions are moved
there afterwards, one entry a bucket: a reader sees a bucket's old or its new
rows, never none. A merge that dies in between is completed by running it
again, since the earliest date wins however often a line is folded in. The day
through which lines are covered is a table property, set last; until then the
daily job goes by the old one.

Choose the number of buckets so that a bucket is about 128 MB. It stays as the
table was created.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.operators.dimension import build_first_order_dimension
from daybook.operators.sink import check_ident, catalog_partitions, plain_path, quote
from daybook.schema import EMAIL, FIRST_ORDER_DATE
from daybook.session import checkpoint_dir, remove_location

BUCKET = "bucket"
VERSIONS = "_versions"
COVERED = "daybook.covered_through"


def bucket_of(email: Column, buckets: int) -> Column:
    """The bucket that Spark's bucketed writer and its joins deal an email to."""
    return F.pmod(F.hash(email), F.lit(buckets))


def _detail(spark: SparkSession, table: str, name: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {check_ident(table)}").where(F.col("col_name") == name)
    found = rows.first()
    if found is None:
        raise ValueError(f"{table} is no bucketed dimension")
    return found["data_type"]


def bucket_count(spark: SparkSession, table: str) -> int:
    return int(_detail(spark, table, "Num Buckets"))


def table_covered_through(spark: SparkSession, table: str) -> dt.date:
    """The last day whose lines the table covers; raises if it does not say."""
    found = spark.sql(f"SHOW TBLPROPERTIES {check_ident(table)}").where(F.col("key") == COVERED).first()
    if found is None:
        raise ValueError(f"{table} is no complete first-order dimension")
    return dt.date.fromisoformat(found["value"])


def read_bucketed_dimension(spark: SparkSession, table: str) -> DataFrame:
    return spark.table(check_ident(table)).select(EMAIL, FIRST_ORDER_DATE)


def _create(spark: SparkSession, table: str, location: str, buckets: int) -> None:
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {check_ident(table)} ({EMAIL} STRING, {FIRST_ORDER_DATE} DATE, {BUCKET} INT) "
        f"USING parquet PARTITIONED BY ({BUCKET}) CLUSTERED BY ({EMAIL}) SORTED BY ({EMAIL}) INTO {buckets} BUCKETS "
        f"LOCATION {quote(location)}"
    )


def _stage(spark: SparkSession, table: str, rows: DataFrame, buckets: int) -> tuple[str, list[int]]:
    """Writes rows to a new version, bucket by bucket; returns its folder and the buckets written.

    Only a table can be written in buckets, so there is one over the folder
    while it is written; files stay when it is dropped.
    """
    version = f"{_detail(spark, table, 'Location').rstrip('/')}/{VERSIONS}/{uuid.uuid4().hex}"
    staging = f"{table}_{uuid.uuid4().hex[:12]}"
    _create(spark, staging, version, buckets)
    try:
        dealt = rows.select(EMAIL, FIRST_ORDER_DATE, bucket_of(F.col(EMAIL), buckets).alias(BUCKET))
        dealt.write.insertInto(staging)
        return version, sorted(map(int, catalog_partitions(spark, staging, BUCKET)))
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {staging}")


def _point(spark: SparkSession, table: str, version: str, numbers: list[int]) -> None:
    """Lets the buckets' partitions point into the version."""
    known = catalog_partitions(spark, table, BUCKET)
    folder = {b: f"{version}/{BUCKET}={b}" for b in numbers}
    new = [b for b in numbers if str(b) not in known]
    if new:
        parts = " ".join(f"PARTITION ({BUCKET} = {b}) LOCATION {quote(folder[b])}" for b in new)
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {parts}")
    for b in sorted(set(numbers) - set(new)):
        spark.sql(f"ALTER TABLE {table} PARTITION ({BUCKET} = {b}) SET LOCATION {quote(folder[b])}")
    spark.catalog.refreshTable(table)


def _state_cover(spark: SparkSession, table: str, through: dt.date) -> None:
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ({quote(COVERED)} = {quote(through.isoformat())})")


def _numbers(rows: DataFrame) -> list[int]:
    """The buckets that rows with a bucket number are in: at most as many as there are buckets."""
    return sorted(r[0] for r in rows.select(BUCKET).distinct().collect())


def build_bucketed_dimension(
    spark: SparkSession, lines: DataFrame, table: str, location: str, buckets: int, through: dt.date
) -> None:
    """Creates the table, or replaces all buckets of an existing one, from the full history.

    ``through`` is the day up to which ``lines`` is complete. An existing
    table keeps its place and its number of buckets; others raise.
    """
    if buckets < 1:
        raise ValueError("a bucketed dimension needs a bucket")
    _create(spark, table, location, buckets)
    there = bucket_count(spark, table)
    if there != buckets:
        raise ValueError(f"{table} has {there} buckets, not {buckets}")
    at = _detail(spark, table, "Location")
    if plain_path(at) != plain_path(location):
        raise ValueError(f"{table} is at {at}, not at {location}")
    # Dealt as the buckets are, so that a bucket is one task and one file.
    rows = build_first_order_dimension(lines).repartition(buckets, EMAIL)
    version, written = _stage(spark, table, rows, buckets)
    _point(spark, table, version, written)
    for b in sorted(set(map(int, catalog_partitions(spark, table, BUCKET))) - set(written)):
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({BUCKET} = {b})")
    _state_cover(spark, table, through)


def changed_customers(dimension: DataFrame, fresh: DataFrame) -> DataFrame:
    """Rows of ``fresh`` whose customer the dimension lacks or has with a later day."""
    before = dimension.select(EMAIL, F.col(FIRST_ORDER_DATE).alias("_before"))
    later = F.col("_before").isNull() | (F.col(FIRST_ORDER_DATE) < F.col("_before"))
    return fresh.join(before, EMAIL, "left").where(later).drop("_before")


def merge_bucketed_dimension(spark: SparkSession, table: str, new_lines: DataFrame, through: dt.date | None = None) -> list[int]:
    """Folds ``new_lines`` into the table; returns the buckets it rewrote.

    ``through`` is the day up to which the table covers all lines afterwards
    (never earlier than before), by default as before. The new lines are
    reduced to one row a customer first and checkpointed; the dimension is
    read where they fall and not shuffled.
    """
    buckets = bucket_count(spark, table)
    covered = table_covered_through(spark, table)
    checkpoint_dir(spark)
    fresh = build_first_order_dimension(new_lines).withColumn(BUCKET, bucket_of(F.col(EMAIL), buckets)).checkpoint()
    there = spark.table(table)
    changed = changed_customers(there.where(F.col(BUCKET).isin(_numbers(fresh))), fresh).checkpoint()
    touched = _numbers(changed)
    if touched:
        old = there.where(F.col(BUCKET).isin(touched)).select(EMAIL, FIRST_ORDER_DATE)
        now = changed.select(EMAIL, F.col(FIRST_ORDER_DATE).alias("_now"))
        merged = old.join(now, EMAIL, "full").select(EMAIL, F.least(FIRST_ORDER_DATE, "_now").alias(FIRST_ORDER_DATE))
        _point(spark, table, *_stage(spark, table, merged, buckets))
    if through and through > covered:
        _state_cover(spark, table, through)
    return touched


def remove_old_bucket_versions(spark: SparkSession, table: str) -> list[str]:
    """Deletes versions that no bucket points into; run it when their readers are done."""
    root = f"{_detail(spark, table, 'Location').rstrip('/')}/{VERSIONS}"
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(path):
        return []
    used = {plain_path(at).split("/")[-2] for at in catalog_partitions(spark, table, BUCKET).values()}
    old = sorted({s.getPath().getName() for s in files.listStatus(path)} - used)
    for name in old:
        remove_location(spark, f"{root}/{name}")
    return old
