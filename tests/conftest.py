import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from landfall.session import session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return session(
        {
            "spark.master": "local[4]",
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "4g",
            "spark.ui.showConsoleProgress": "false",
        },
        name="tests",
    )


@pytest.fixture
def folder():
    """A new empty folder."""
    return tempfile.mkdtemp(prefix="run-")
