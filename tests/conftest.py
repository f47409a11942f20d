import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from stationcast.session import build_session

    shared = tmp_path_factory.mktemp("shared")
    session = build_session(
        "tests",
        master="local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.checkpoint.dir": str(shared),
            "spark.driver.memory": "8g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
