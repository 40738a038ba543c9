import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from landfall.llm.common import Work  # noqa: E402
from landfall.session import session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    conf = {"spark.master": "local[4]", "spark.sql.shuffle.partitions": "4", "spark.driver.memory": "4g", "spark.ui.showConsoleProgress": "false"}
    return session(conf, name="tests")


@pytest.fixture
def work(spark):
    return Work(spark, "tests")


@pytest.fixture
def docs(spark):
    """Nulls, empty texts, a very long text, repeated rows, and columns named like added ones."""
    long = " ".join(f"w{i}" for i in range(60_000))
    rows = [(1, "One two three four five six.\nx", "en", "a"), (2, None, None, None), (3, "", "en", "a"), (4, long, "en", "b"),
            (1, "One two three four five six.\nx", "en", "a"), (None, "no id here", "fr", "b")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    return frame.selectExpr("*", "'x' as score", "'y' as size", "'z' as n_lines", "'k' as predicted", "1 as copies", "'l' as lang_pred")
