import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.dirname(os.path.abspath(__file__))]

from stoplens.session import build_session  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "stoplens-tests",
        master="local[4]",
        shuffle_partitions=4,
        conf={"spark.ui.showConsoleProgress": "false", "spark.driver.memory": "4g"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture
def plan():
    """The physical plan of a frame as text."""

    def text(df, capsys=None):
        return df._jdf.queryExecution().executedPlan().toString()

    return text
