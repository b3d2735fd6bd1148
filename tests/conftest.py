import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from medallion.session import get_spark  # noqa: E402

DATA = os.environ.get("MEDALLION_TESTDATA", "/root/testdata")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    warehouse = tmp_path_factory.mktemp("warehouse")
    session = get_spark(
        "tests",
        "local[8]",
        spark__sql__shuffle__partitions="8",
        spark__sql__warehouse__dir=str(warehouse),
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
        spark__driver__memory="8g",
        spark__ui__showConsoleProgress="false",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return f"{DATA}/sf0.01"


@pytest.fixture(scope="session")
def tiny_dir():
    return f"{DATA}/sf0.001"
