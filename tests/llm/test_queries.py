"""Every query of the operators that has SQL, against it, and what is registered."""

import os

import pytest

import __spark_entry__ as entry_module
import check
from pagetally.llm.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="the given tables are not here")


@pytest.fixture(scope="module")
def tables():
    return check.connect(FOLDER)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_corpus_query_equals_sql(spark, tables, name):
    outcome = check.compare(spark, tables, FOLDER, name)
    assert outcome.startswith("ok "), outcome


def test_every_operator_is_registered():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(entry_module.queries())
    assert set(ORACLES) <= set(entry_module.oracle_sql()) and set(ORACLES) <= set(QUERIES)
    assert all(query.__doc__ for query in QUERIES.values())
