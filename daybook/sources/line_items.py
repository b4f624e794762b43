"""Line-item sources.

The statistics read five columns of a line-item table: ``order_id``,
``email``, ``order_date``, ``quantity``, ``price``. Two ways in:

* ``line_items_from_table`` - any catalog table or parquet path that already
  has those columns (the production layout). Only the five columns are
  selected, so the parquet scan prunes everything else.
* ``line_items_from_tpch`` - an adapter over the TPC-H style test tables
  (lineitem, orders, part). One customer key in ten is treated as a guest
  checkout (no email); the ``dirty`` variant also blanks the order date of
  every 101st order, for the data-quality queries.
"""

from __future__ import annotations

import csv
import re
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F

from daybook.functions import finite, to_day
from daybook.schema import EMAIL, LINE_ITEM_COLUMNS, ORDER_DATE, ORDER_ID, PRICE, QUANTITY


# The columns (and types) the adapter reads from each table.
TPCH_COLUMNS = {
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_quantity DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderdate TIMESTAMP_NTZ",
    "part": "p_partkey BIGINT, p_retailprice DOUBLE",
}


def read_table(spark: SparkSession, sf_dir: str, name: str, schema: str | None = None) -> DataFrame:
    """Read ``<sf_dir>/<name>.parquet``.

    With ``schema`` (a DDL string of the needed columns) Spark skips the
    footer-sampling job it otherwise runs to infer the schema, and the scan
    reads only those columns.
    """
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def normalise_line_items(df: DataFrame) -> DataFrame:
    """Project to the five used columns with their working types.

    ``order_date`` becomes a DATE; quantity and price become DOUBLE through a
    strict cast (an empty string or junk raises rather than becoming null),
    with NaN, a missing number, as NULL; infinity raises. Emails are kept verbatim: no trimming or case folding.

    Filters on ``order_date`` reach a parquet scan only if the column is a
    DATE or TIMESTAMP; text is cast row by row.
    """
    return df.select(
        F.col(ORDER_ID),
        F.col(EMAIL).cast("string").alias(EMAIL),
        to_day(ORDER_DATE).alias(ORDER_DATE),
        finite(QUANTITY).alias(QUANTITY),
        finite(PRICE).alias(PRICE),
    )


def line_items_from_table(
    spark: SparkSession, table_or_path: str, partition_column: str | None = None
) -> DataFrame:
    """Line items from a catalog table name or a parquet location.

    ``partition_column`` names a DATE partition column that holds each line's
    order day; it then serves as ``order_date``, so the daily job's day and
    history filters prune partitions before anything is read.
    """
    if "/" in table_or_path:
        df = spark.read.parquet(table_or_path)
    else:
        df = spark.table(table_or_path)
    if partition_column:
        df = df.withColumn(ORDER_DATE, F.col(partition_column))
    return normalise_line_items(df)


def line_items_from_csv(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Line items from CSV text files with a header line.

    Every cell is read as text, as the original job received it, and typed by
    ``normalise_line_items``. An empty unquoted cell is NULL; a quoted empty
    string stays ``''`` (an empty email is a customer). Extra columns are
    ignored. All files must have the same header: one that differs in names or
    order raises (``line_items_from_csv_by_header`` reads them), as does a line with too few cells. Cells that hold line
    breaks need ``multi_line`` (a file is then read by one task); without it
    their parts are short lines and raise.
    """
    return normalise_line_items(_csv_reader(spark, multi_line).option("enforceSchema", "false").csv(path))


def _csv_reader(spark: SparkSession, multi_line: bool) -> DataFrameReader:
    # The parser returns ``nullValue`` for an empty unquoted cell and
    # ``emptyValue`` for a quoted ``""``; Spark then maps cells equal to
    # ``nullValue`` to NULL. With the default ``nullValue`` of "" both become
    # NULL, so it is set to a control character that does not occur in text.
    return (
        spark.read.option("header", "true")
        .option("inferSchema", "false")
        .option("mode", "FAILFAST")
        .option("columnPruning", "false")
        .option("multiLine", str(multi_line).lower())
        .option("nullValue", "\u0000")
        .option("emptyValue", "")
    )


def line_items_from_csv_by_header(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Line items from CSV text files that need not have the same columns in the same order.

    Every file is read by the names in its own header line. Files whose
    headers place the five columns alike are one scan; the scans are united by
    name, so the plan grows with the number of layouts, not of files. Cells
    are read as by ``line_items_from_csv``; other columns are ignored, whatever
    their names. A header that lacks one of the five columns or has it twice
    raises, with the file's name, before anything is read. Files without any
    line, or with nothing but a header, have no line items.

    The headers are taken by one task a file that stops at the first line
    with text; the driver holds the names of the files, as it does for any scan.
    """
    layouts: dict[tuple[int, tuple[int, ...]], list[str]] = {}
    for file, line in sorted(_header_lines(spark, path)):
        layouts.setdefault(_layout(file, line), []).append(file)
    parts = []
    for (width, places), files in sorted(layouts.items()):
        names = dict(zip(places, LINE_ITEM_COLUMNS))
        schema = ", ".join(f"`{names.get(i, f'_unused_{i}')}` STRING" for i in range(width))
        rows = _csv_reader(spark, multi_line).option("enforceSchema", "true").schema(schema)
        parts.append(normalise_line_items(rows.csv([_literal_path(f) for f in files])))
    if not parts:
        nothing = spark.createDataFrame([], ", ".join(f"{c} STRING" for c in LINE_ITEM_COLUMNS))
        return normalise_line_items(nothing)
    return reduce(DataFrame.unionByName, parts)


def _header_lines(spark: SparkSession, path: str) -> list[tuple[str, str]]:
    """(file, first line that is not blank) of every file that has one."""
    # A session of its own, so that the settings hold for this job alone: files
    # are neither split nor put together, one task each.
    apart = spark.newSession()
    apart.conf.set("spark.sql.files.maxPartitionBytes", str(1 << 40))
    apart.conf.set("spark.sql.files.openCostInBytes", str(1 << 40))
    apart.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "16")

    def first_line(batches):
        for batch in batches:
            for i, line in enumerate(batch.column("line")):
                if (line.as_py() or "").strip():
                    yield batch.slice(i, 1)
                    return  # the rest of the file stays unread

    lines = apart.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("line"))
    return [(unquote(r.file), r.line) for r in lines.mapInArrow(first_line, "file string, line string").collect()]


def _layout(file: str, header: str) -> tuple[int, tuple[int, ...]]:
    """Number of columns and the places of the five; raises where they are not all there once."""
    if header.count('"') % 2:
        raise ValueError(f"the header of {file} has a line break in a name")
    names = next(csv.reader([header.removeprefix("\ufeff")]))
    for wanted in LINE_ITEM_COLUMNS:
        if names.count(wanted) != 1:
            raise ValueError(f"{file} has {names.count(wanted)} columns {wanted}, not one: {', '.join(names)}")
    return len(names), tuple(names.index(c) for c in LINE_ITEM_COLUMNS)


def _literal_path(file: str) -> str:
    """A file's name as Spark's readers take it, not as a pattern."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", file)


def line_items_from_tpch(spark: SparkSession, sf_dir: str, dirty: bool = False) -> DataFrame:
    """Adapter: lineitem x orders x part at line grain.

    Both joins are many-to-one inner equi-joins. Catalyst prunes each scan to
    the join key plus the one or two columns used; AQE broadcasts ``part`` and
    ``orders`` when their pruned size is small and keeps sort-merge joins when
    it is not. The per-order attributes (email text, day) are computed on the
    orders side, once per order instead of once per line.
    """
    lineitem = read_table(spark, sf_dir, "lineitem", TPCH_COLUMNS["lineitem"])
    part = read_table(spark, sf_dir, "part", TPCH_COLUMNS["part"])

    # Guest rule and dirty-date rule of the test adapter.
    guest = F.col("o_custkey") % 10 == 0
    email = F.when(~guest, F.concat(F.lit("c"), F.col("o_custkey").cast("string"), F.lit("@example.com")))
    day = to_day("o_orderdate")
    if dirty:
        day = F.when(F.col("o_orderkey") % 101 != 0, day)
    orders = read_table(spark, sf_dir, "orders", TPCH_COLUMNS["orders"]).select(
        F.col("o_orderkey"), email.alias(EMAIL), day.alias(ORDER_DATE)
    )

    joined = lineitem.join(orders, lineitem.l_orderkey == orders.o_orderkey).join(
        part, lineitem.l_partkey == part.p_partkey
    )
    return joined.select(
        F.col("o_orderkey").alias(ORDER_ID),
        F.col(EMAIL),
        F.col(ORDER_DATE),
        F.col("l_quantity").alias(QUANTITY),
        F.col("p_retailprice").alias(PRICE),
    )


__all__ = [
    "LINE_ITEM_COLUMNS",
    "line_items_from_csv",
    "line_items_from_csv_by_header",
    "line_items_from_table",
    "line_items_from_tpch",
    "normalise_line_items",
    "read_table",
]
