import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from bindery.session import drop_run_folder, get_session  # noqa: E402

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = get_session(
        "bindery-tests",
        master="local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
            "spark.checkpoint.dir": tmp_path_factory.mktemp("shared").as_uri(),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    drop_run_folder(session)
    session.stop()


@pytest.fixture(scope="session")
def data_dir():
    if not os.path.isdir(DATA):
        pytest.skip("test tables are not there")
    return DATA
