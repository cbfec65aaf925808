import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from promptmill.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        app="promptmill-tests", master="local[4]",
        **{"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false",
           "spark.driver.memory": "4g",
           "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared"))})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Rows of a DataFrame as plain dictionaries, in order."""
    return lambda df: [r.asDict(recursive=True) for r in df.collect()]
