"""Every query against its SQL text on the smallest given tables."""

import os

import pytest

import __spark_entry__ as entry_module
import check
from pagetally.catalogue.oracles import ORACLES
from pagetally.catalogue.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="the given tables are not here")


@pytest.fixture(scope="module")
def tables():
    return check.connect(FOLDER)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_module.queries())
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, tables, name):
    outcome = check.compare(spark, tables, FOLDER, name)
    assert outcome.startswith("ok "), outcome


def test_flagship(spark):
    rows = entry_module.entry(spark).collect()
    assert [row.ord for row in sorted(rows, key=lambda row: row.ord)] == [0, 1, 2, 3, 4]
