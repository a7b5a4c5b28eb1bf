"""Every registered query against its SQL on the smallest driver tables."""

import os

import pytest

from compare import compare, duck
from tabloom.catalog import all_queries

FOLDER = os.environ.get("TABLOOM_TEST_TABLES", "/root/testdata/sf0.001")
QUERIES = all_queries()

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="driver tables not present")


@pytest.fixture(scope="module")
def connection():
    return duck(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, connection, name):
    entry = QUERIES[name]
    assert compare(spark, connection, FOLDER, name, entry.run, entry.sql) == ""


def test_contract_names_agree():
    import __spark_entry__ as contract

    own = set(QUERIES)
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert not (set(contract.queries()) - set(contract.oracle_sql())) & own
