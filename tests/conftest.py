import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tabloom.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("8", app="tabloom-tests")
    yield session
    session.stop()


# fixed values: the 17-row melon table (all categories coded 1..3, label 0/1)
MELON = """1,1,1,1,1,1,1,1
2,2,1,2,1,1,1,1
3,2,1,1,1,1,1,1
4,1,1,2,1,1,1,1
5,3,1,1,1,1,1,1
6,1,2,1,1,2,2,1
7,2,2,1,2,2,2,1
8,2,2,1,1,2,1,1
9,2,2,2,2,2,1,0
10,1,3,3,1,3,2,0
11,3,3,3,3,3,1,0
12,3,1,1,3,3,2,0
13,1,2,1,2,1,1,0
14,3,2,2,2,1,1,0
15,2,2,1,1,2,2,0
16,3,1,1,3,3,1,0
17,1,1,2,2,2,1,0"""
MELON_COLUMNS = "id,seze,gendi,qiaosheng,wenli,qibu,chugan,haogua".split(",")
MELON_FEATURES = MELON_COLUMNS[1:7]


@pytest.fixture(scope="session")
def melon(spark):
    rows = [tuple(map(int, line.split(","))) for line in MELON.splitlines()]
    return spark.createDataFrame(rows, ", ".join(f"{c} int" for c in MELON_COLUMNS)).cache()
