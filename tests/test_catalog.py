"""Every query against its SQL on the smallest tables; the others must give rows."""

import os

import pytest

import __spark_entry__ as entry_module
from tests.oracle import connect, difference

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES = entry_module.queries()
ORACLE = entry_module.oracle_sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables here")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


# Pairs that near need not exist in the smallest tables.
MAY_BE_EMPTY = {"lsh_join", "stream_growing_corpus", "stream_near_dup", "stream_near_dup_stop"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF_DIR)
    if name in ORACLE:
        found = difference(df, con, ORACLE[name])
        assert found is None or (found == "no rows" and name in MAY_BE_EMPTY)
    else:
        assert df.count() > 0


def test_entry(spark):
    assert entry_module.entry(spark).columns == ["id_a", "id_b", "distance", "copies_a", "copies_b"]


def test_every_check_names_a_query():
    assert set(ORACLE) <= set(QUERIES)
