"""Every registered query equals its DuckDB oracle on the smallest tables."""
import pytest

import __spark_entry__ as E
from compare import compare, duck
from util import SF_SMALL
from touchline.registry import QUERIES

NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(E.oracle_sql()) and set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    ok, msg = compare(spark, name, E.queries()[name], E.oracle_sql()[name], SF_SMALL, con)
    assert ok, msg


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns[0] == "channel" and df.count() > 0
