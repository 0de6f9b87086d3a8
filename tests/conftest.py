import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).parent), str(Path(__file__).parent.parent)]

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from kpiloom.session import build_session

    session = build_session(
        "kpiloom-tests",
        "local[4]",
        **{"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "6g", "spark.sql.maxMetadataStringLength": "2000"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def src():
    return SMALL
