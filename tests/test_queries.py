"""Every registered query against its SQL on the smallest tables."""

import pytest
from compare import compare, duck

from __spark_entry__ import entry
from pagetables.plans.catalog import QUERIES
from pagetables.plans.oracle import ORACLE

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    assert compare(QUERIES[name](spark, SF_DIR), con, ORACLE[name]) == []


def test_entry(spark):
    assert entry(spark).count() > 0
