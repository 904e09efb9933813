"""Every registered query against its SQL twin at the smallest scale."""

import pytest

from evenledger.catalog import ORACLE, QUERIES, load_all
from oracle_check import compare, connect

load_all()
SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_answer(spark, con, name):
    assert compare(spark, con, name, QUERIES[name], ORACLE[name], SF_DIR) == ""
