import datetime as dt

import pytest

from stockroom.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, "tests", **{"spark.default.parallelism": "4"})
    yield session
    session.stop()


@pytest.fixture
def frame(spark):
    """Build a frame from rows and a DDL schema."""
    return lambda rows, ddl: spark.createDataFrame(rows, ddl)


def at(day, hour=0, minute=0):
    """A moment in January 2024 (UTC)."""
    return dt.datetime(2024, 1, day, hour, minute)


def rows(df, *columns):
    """Rows as sorted tuples; NULLs sort first."""
    out = [tuple(r) for r in (df.select(*columns) if columns else df).collect()]
    return sorted(out, key=lambda t: tuple((v is not None, str(v)) for v in t))
