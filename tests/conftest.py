import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from cityloom.session import build_session  # noqa: E402

TESTDATA = Path("/root/testdata")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "cityloom-tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.bindAddress": "127.0.0.1",
            "spark.driver.host": "127.0.0.1",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoint")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def plan_of(df):
    """Text of the physical plan as planned, before adaptive changes."""
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df, *order):
    """Rows as plain tuples, sorted with NULL last."""
    columns = order or df.columns
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=lambda t: [(v is None, str(v)) for v in t])
