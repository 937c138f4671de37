import os

import pytest

from tidewatch.session import build_session, remove_work_folders


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tidewatch-tests",
        master="local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "8g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    remove_work_folders(session)
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture
def narrow_state(spark):
    """Streams of two state partitions: most of a small trigger's time goes into committing them."""
    spark.conf.set("spark.tidewatch.statePartitions", "2")
    yield
    spark.conf.unset("spark.tidewatch.statePartitions")
