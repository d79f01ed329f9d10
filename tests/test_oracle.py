"""Every registered query against its DuckDB oracle at sf0.01."""

import os
import sys

import pytest

from conftest import ROOT, SF01

sys.path.insert(0, os.path.join(ROOT, "tools"))
import __spark_entry__ as entry  # noqa: E402
from sessionscope.plans import registry  # noqa: E402
from oracle_check import compare, duck  # noqa: E402

QUERIES = entry.queries()
ORACLES = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF01)


def test_every_session_query_has_an_oracle():
    assert set(registry.queries()) == set(registry.oracle_sql()) <= set(QUERIES)
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    res = compare(spark, SF01, name, QUERIES[name], ORACLES[name], con)
    assert res["status"] == "ok", res


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) == len(registry.STAT_CLOCKS) and "session_count" in df.columns
