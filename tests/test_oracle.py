"""Every registered query against its DuckDB reference SQL (sf0.001),
compared exactly: aggregated doubles are rounded through decimals on both
sides, so no tolerance is needed."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(__file__)), "tools"))

import __spark_entry__ as E  # noqa: E402
import compare as C  # noqa: E402


def test_every_query_has_sql():
    assert set(E.coverage()) <= set(E.oracle_sql()) <= set(E.queries())


@pytest.fixture(scope="module")
def results(spark, sf_small):
    C.EXACT = True          # doubles must agree bit for bit (only -0.0 == 0.0)
    try:
        return C.compare(spark, sf_small, names=list(E.oracle_sql()), verbose=False)
    finally:
        C.EXACT = False


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_matches_reference_sql(results, name):
    status, info = results[name]
    assert status == "OK", info
