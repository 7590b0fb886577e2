import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from terraloom.session import local_session, ship  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "tests", driver_memory="6g")
    ship(session)
    yield session
    session.stop()


@pytest.fixture
def plan_of(spark):
    """The formatted physical plan as text."""
    def text(df):
        return df._jdf.queryExecution().explainString(
            spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))

    return text
