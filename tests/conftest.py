import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
# Python workers import the package and the model functions of the tests.
os.environ["PYTHONPATH"] = os.pathsep.join(
    [ROOT, os.path.join(ROOT, "tests"), os.environ.get("PYTHONPATH", "")]
)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from termloom.session import build_session

    session = build_session(
        "tests",
        spark__master="local[8]",
        spark__sql__shuffle__partitions="8",
        spark__ui__enabled="false",
        spark__driver__memory="8g",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("checkpoints")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
