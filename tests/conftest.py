import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from shelfmark.session import get_spark  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = get_spark(
        "tests", "local[4]", **{
            "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.sql.shuffle.partitions": "4", "spark.driver.memory": "4g",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="shelfmark-tests-"),
        }
    )
    session.sparkContext.setLogLevel("ERROR")
    return session
