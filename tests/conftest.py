import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from offermart.session import get_session

    extra = {"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "8g"}
    session = get_session("tests", "local[8]", extra)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
