import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

ROOT = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from claimrisk.session import local_session
    home = tmp_path_factory.mktemp("spark")
    session = local_session(
        4, app="claimrisk-tests",
        **{"spark.sql.warehouse.dir": str(home / "warehouse"),
           "spark.checkpoint.dir": str(home / "work"),
           "spark.sql.shuffle.partitions": "4"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def root():
    return ROOT
