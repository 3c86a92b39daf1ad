import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from weirflow import new_session  # noqa: E402

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = new_session(
        "local[8]",
        "weirflow-tests",
        spark__driver__memory="8g",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("ckpt")),
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("wh")),
        spark__sql__shuffle__partitions="4",
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture
def texts(spark):
    """One-column DataFrame of JSON texts."""

    def make(*values):
        return spark.createDataFrame([(v,) for v in values], "payload string")

    return make
