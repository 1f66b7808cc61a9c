import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from eventloom.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[8]",
        spark__sql__shuffle__partitions="4",
        # tiny tables: compiling code costs more than it saves
        spark__sql__codegen__wholeStage="false",
        spark__ui__enabled="false",
        spark__driver__memory="8g",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def split_everything(spark):
    """Cut every group of four rows or more, to run the segmented form of each scan."""
    spark.conf.set("spark.eventloom.rowsPerSegment", "2")
    spark.conf.set("spark.eventloom.sampleEvery", "1")
    yield
    spark.conf.unset("spark.eventloom.rowsPerSegment")
    spark.conf.unset("spark.eventloom.sampleEvery")
