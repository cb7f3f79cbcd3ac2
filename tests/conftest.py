import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from termtide.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return build_session(
        "tests", "local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"},
    )


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"
