"""CSV line items read by each file's own header."""

from __future__ import annotations

import os

import pytest

from daybook.operators.per_day import daily_stats
from daybook.sources import line_items_from_csv, line_items_from_csv_by_header
from tests.fixtures import GOLDEN_EXPECTED, GOLDEN_LINES, local_path

COLUMNS = ("order_id", "email", "order_date", "quantity", "price")


@pytest.fixture()
def folder(scratch):
    """(location, write): ``write(name, text)`` puts a file into a fresh folder."""
    location = scratch("csv")
    root = local_path(location)
    os.makedirs(root)

    def write(name: str, text: str) -> None:
        os.makedirs(os.path.dirname(f"{root}/{name}"), exist_ok=True)
        with open(f"{root}/{name}", "w", encoding="utf-8", newline="") as out:
            out.write(text)

    return location, write


def _csv(rows, columns=COLUMNS, end="\n") -> str:
    def cell(row, c):
        if c not in COLUMNS:
            return "extra"
        value = row[COLUMNS.index(c)]
        return "" if value is None else value or '""'

    lines = [",".join(columns)] + [",".join(cell(r, c) for c in columns) for r in rows]
    return end.join(lines) + end


def _rows(df):
    return sorted(map(str, df.collect()))


def test_files_with_different_columns_give_the_rows_of_one_layout(spark, folder, scratch):
    location, write = folder
    write("a.csv", _csv(GOLDEN_LINES[:4]))
    write("b.csv", _csv(GOLDEN_LINES[4:7], COLUMNS[::-1]))
    write("c.csv", _csv(GOLDEN_LINES[7:9], ("Email", "price", *COLUMNS[:4], "price ")))
    write("d.csv", "﻿" + _csv(GOLDEN_LINES[9:11], ("quantity", "price", "order_date", "order_id", "email"), "\r\n"))
    write("e.csv", "\n  \n" + _csv(GOLDEN_LINES[11:]).replace("order_id,email", '"order_id","email"'))
    write("f.csv", _csv([], ("price", *COLUMNS[:4])))
    write("g.csv", "")
    lines = line_items_from_csv_by_header(spark, location)
    assert lines.columns == list(COLUMNS)
    got = daily_stats(lines).orderBy("order_date").collect()
    assert [tuple(r) for r in got] == GOLDEN_EXPECTED
    # The same lines in one layout, by the other reader.
    whole = scratch("whole")
    os.makedirs(local_path(whole))
    with open(f"{local_path(whole)}/all.csv", "w", encoding="utf-8") as out:
        out.write(_csv(GOLDEN_LINES))
    assert _rows(lines) == _rows(line_items_from_csv(spark, whole))
    assert _rows(lines) == _rows(line_items_from_csv_by_header(spark, f"{location}/*.csv"))


def test_one_scan_for_each_layout(spark, folder):
    location, write = folder
    for i in range(6):
        write(f"{i}.csv", _csv(GOLDEN_LINES[i : i + 1], COLUMNS if i % 2 else COLUMNS[::-1]))
    df = line_items_from_csv_by_header(spark, location)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan csv") == 2 and "Python" not in plan and "Arrow" not in plan
    assert df.count() == 6


def test_names_with_signs_of_patterns_and_folders_of_partitions(spark, folder):
    location, write = folder
    write("day=2024-01-01/a b%20{x} [1].csv", _csv(GOLDEN_LINES[:2]))
    write("day=2024-01-02/ü.csv", _csv(GOLDEN_LINES[2:5], COLUMNS[::-1]))
    assert line_items_from_csv_by_header(spark, location).count() == 5


@pytest.mark.parametrize(
    "columns, message",
    [
        (COLUMNS[:4], "0 columns price"),
        ((*COLUMNS, "email"), "2 columns email"),
        (("order_id", "EMAIL", *COLUMNS[2:]), "0 columns email"),
    ],
)
def test_missing_and_repeated_columns_raise_with_the_file(spark, folder, columns, message):
    location, write = folder
    write("good.csv", _csv(GOLDEN_LINES))
    write("bad.csv", _csv(GOLDEN_LINES, columns))
    with pytest.raises(ValueError, match=f"bad.csv has {message}"):
        line_items_from_csv_by_header(spark, location)


def test_short_lines_and_junk_raise_and_line_breaks_need_their_option(spark, folder, scratch):
    location, write = folder
    write("a.csv", _csv(GOLDEN_LINES[:1], COLUMNS[::-1]) + "1,2\n")
    with pytest.raises(Exception, match="MALFORMED|Malformed"):
        line_items_from_csv_by_header(spark, location).collect()
    write("a.csv", _csv([("1", "a@x.com", "2024-01-01", "two", "1")], COLUMNS[::-1]))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        line_items_from_csv_by_header(spark, location).collect()
    write("a.csv", _csv([("1", '"a\nb"', "2024-01-01", "2", "1")], COLUMNS[::-1]))
    assert line_items_from_csv_by_header(spark, location, multi_line=True).collect()[0].email == "a\nb"
    write("a.csv", '"a\nb",' + _csv([], COLUMNS))
    with pytest.raises(ValueError, match="line break"):
        line_items_from_csv_by_header(spark, location, multi_line=True)


def test_folder_without_headers_is_empty(spark, folder):
    location, write = folder
    write("a.csv", "")
    write("b.csv", "\n\n")
    df = line_items_from_csv_by_header(spark, location)
    assert df.columns == list(COLUMNS) and df.count() == 0 and dict(df.dtypes)["order_date"] == "date"


def test_command_line_reads_csv(spark, folder, scratch, capsys):
    from daybook.operators.sink import read_daily_stats
    from daybook.plans.cli import main

    location, write = folder
    write("a.csv", _csv(GOLDEN_LINES[:5]))
    write("b.csv", _csv(GOLDEN_LINES[5:], COLUMNS[::-1]))
    at = scratch("stats")
    main(["--csv", "backfill", "--source", location, "--location", at, "--share-source"])
    assert "lines row_count: 13" in capsys.readouterr().out
    got = read_daily_stats(spark, at).drop("partition_date").orderBy("order_date").collect()
    assert [tuple(r) for r in got] == GOLDEN_EXPECTED
