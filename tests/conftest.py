import tempfile

import pytest

from marketloom.session import build_session


@pytest.fixture(scope="session")
def spark():
    settings = {
        "spark.sql.shuffle.partitions": "4",
        "spark.ui.enabled": "false",
        "spark.marketloom.spread": "true",
        "spark.driver.memory": "6g",
        "spark.checkpoint.dir": tempfile.mkdtemp(prefix="marketloom-test-"),
    }
    session = build_session("marketloom-tests", "local[4]", **settings)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
