import os

import pytest
from compare import compare, duck

from tabloom.llm.queries import ORACLES, QUERIES

FOLDER = os.environ.get("TABLOOM_TEST_TABLES", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="driver tables not present")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_runs_and_equals_its_sql(spark, name):
    assert compare(spark, duck(FOLDER), FOLDER, name, QUERIES[name], ORACLES.get(name)) == ""


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
