import datetime as dt

import pytest

from tickloom.session import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tickloom-tests",
        master="local[*]",
        conf={"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
              "spark.ui.showConsoleProgress": "false"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def at():
    """Instants counted in seconds from one fixed hour."""
    start = dt.datetime(2024, 3, 1, 12, 0, 0)
    return lambda seconds: start + dt.timedelta(seconds=seconds)
