import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from ratewell.session import local_session

    session = local_session("tests", "4", 4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def mines(spark):
    """Cleaned entity-period rows of the smallest data set."""
    from ratewell.plans.base import clean

    rows = clean(spark, SMALL).persist()
    rows.count()
    return rows
