"""The driver contract, and every registered query against its oracle SQL."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(__file__)), "tools"))

import __spark_entry__ as E  # noqa: E402
from oracle_check import compare, duck  # noqa: E402

from conftest import SF_SMALL  # noqa: E402
from tallyspark.plans.catalog import QUERIES  # noqa: E402

NO_ORACLE: set[str] = set()


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["n_vertices", "n_edges", "triangles"]
    rows = df.collect()
    assert len(rows) == 1 and rows[0].triangles > 0


def test_every_query_has_oracle_or_is_declared():
    q = {k: v for k, v in E.queries().items() if k in QUERIES}
    o = {k: v for k, v in E.oracle_sql().items() if k in QUERIES}
    assert set(E.oracle_sql()) <= set(E.queries())
    assert set(o) <= set(q)
    assert set(q) - set(o) == NO_ORACLE


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    rows = df.collect()
    if name in NO_ORACLE:
        assert len(rows) >= 1
        return
    problems, _, _ = compare(rows, df.schema, con.sql(E.oracle_sql()[name]))
    assert not problems, problems
