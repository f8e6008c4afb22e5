"""Every registered query against its SQL on the given tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as registry
from compare import compare, duck

from spinledger.plans import catalog

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def oracle():
    return duck(SF)


def test_every_query_has_sql():
    assert catalog.QUERIES.keys() == catalog.ORACLES.keys()
    assert catalog.QUERIES.keys() <= registry.queries().keys()


def test_entry(spark):
    assert registry.entry(spark).count() > 0


@pytest.mark.parametrize("name", catalog.QUERIES)
def test_query_equals_sql(spark, oracle, name):
    ours, theirs = compare(registry.queries()[name](spark, SF), oracle, registry.oracle_sql()[name])
    assert ours[0] == theirs[0]
    assert ours[1] == theirs[1]
