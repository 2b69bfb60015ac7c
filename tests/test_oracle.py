"""Every registered query against its DuckDB oracle (the driver's gate),
plus the entry() smoke check."""

import pytest
from conftest import SF001
from oracle import compare, duck, out_of_order

import __spark_entry__ as entry

from epilake.queries import ORDER, QUERIES

KEYS = sorted(QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck(SF001)


def test_every_query_has_oracle():
    assert set(KEYS) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    problems, _ = compare(entry.queries()[key](spark, SF001), con, entry.oracle_sql()[key],
                          ORDER.get(key))
    assert not problems, problems


def test_order_check_sees_ties_nulls_and_descents():
    cols = ["a", "b"]
    assert out_of_order(cols, [(None, 1), (1, 2), (1, 3), (2, 0)], "a b") is None
    assert out_of_order(cols, [(1, 3), (1, 2)], "a b") == 1
    assert out_of_order(cols, [(3, 0), (1, 0), (None, 0)], "-a") is None
    assert out_of_order(cols, [(None, 0), (1, 0)], "-a") == 1
    assert out_of_order(cols, [(1, 0), (None, 0)], "a") == 1


def test_entry_smoke(spark):
    rows = entry.entry(spark).collect()
    assert len(rows) == 10
    assert (rows[0].code, rows[0].total_cases, float(rows[0].rate_per_100k)) == ("12", 49, 1225.0)
