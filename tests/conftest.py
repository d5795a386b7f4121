import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tillroll.plans.session import local_session

    s = local_session(cores=4, shuffle_partitions=4, app="tillroll-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck_small():
    from compare import duck

    return duck(SF_SMALL)


@pytest.fixture(scope="session")
def wh_small(spark):
    from tillroll.plans.warehouse import warehouse_for

    return warehouse_for(spark, SF_SMALL)
