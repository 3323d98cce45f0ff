import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from starmill.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    home = tmp_path_factory.mktemp("spark")
    session = get_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.default.parallelism": "4",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": str(home / "checkpoints"),
            "spark.sql.warehouse.dir": str(home / "warehouse"),
            "spark.ui.showConsoleProgress": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def frame(spark):
    """Build a DataFrame from rows and a DDL schema."""
    return lambda rows, schema: spark.createDataFrame(rows, schema)


def as_set(df, *columns):
    rows = [tuple(r) for r in df.select(*(columns or df.columns)).collect()]
    assert len(rows) == len(set(rows)), "duplicate rows"
    return set(rows)
