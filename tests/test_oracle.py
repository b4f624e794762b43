"""Every registered query against its DuckDB oracle (sf0.001 for speed).

The same comparison at sf0.01 is ``python tests/oracle_harness.py``.
"""

from __future__ import annotations

import pytest

from conftest import SF001
from oracle_harness import compare

import __spark_entry__ as entry


def test_every_query_has_an_oracle():
    assert set(entry._QUERIES) == set(entry._own_oracle_sql())
    assert set(entry._QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(entry._QUERIES))
def test_query_matches_oracle(spark, name):
    rep = compare(spark, SF001, [name], verbose=False)[name]
    assert rep["cols"], rep
    assert rep["rows"] == rep["oracle_rows"], rep
    assert rep["values"], rep


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns[0] == "order_date"
    assert df.count() > 0
