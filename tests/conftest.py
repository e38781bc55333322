import os

import pytest

from loanloom.session import build_session

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", shuffle=4)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    if not os.path.isdir(SF):
        pytest.skip("test tables are not here")
    return SF


@pytest.fixture()
def frame(spark):
    """Build a table from ``(rows, ddl)``."""
    return lambda rows, ddl: spark.createDataFrame(rows, ddl)
