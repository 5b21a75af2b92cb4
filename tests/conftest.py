import os

import pytest

from opsight.session import local_session

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = local_session("opsight-tests", cpus=8)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def tables(spark):
    from opsight.plans import load_all
    from opsight.plans.views import Tables

    load_all()
    return Tables(spark, SF_DIR)
