import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidemark.session import build_session

TINY = "/root/testdata/sf0.001"


def make_session():
    spark = build_session(
        app="tidemark-tests",
        master="local[8]",
        shuffle_partitions=8,
        **{
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
            # Plans name whole paths, however long the folder's name is.
            "spark.sql.maxMetadataStringLength": "4000",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@pytest.fixture(scope="session")
def spark():
    session = make_session()
    yield session
    session.stop()
