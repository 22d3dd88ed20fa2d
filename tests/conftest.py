import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lexloom.session import BROADCAST_CONF, build_session  # noqa: E402

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "4g"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def joins_only(spark):
    """No in-task lookups: every table is joined."""
    spark.conf.set(BROADCAST_CONF, "0")
    yield
    spark.conf.unset(BROADCAST_CONF)


@pytest.fixture(scope="session")
def data():
    return DATA
