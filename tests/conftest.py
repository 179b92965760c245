import tempfile

import pytest

from paylake.session import build_session


@pytest.fixture(scope="session")
def spark():
    scratch = tempfile.mkdtemp(prefix="paylake-test-")
    session = build_session(master="local[4]", **{
        "spark.sql.shuffle.partitions": "4",
        "spark.driver.memory": "4g",
        "spark.checkpoint.dir": scratch,
        "spark.sql.warehouse.dir": f"{scratch}/warehouse",
        "spark.ui.showConsoleProgress": "false",
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path)
