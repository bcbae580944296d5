import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark():
    from panelwright.session import local_session

    session = local_session(4, "panelwright-tests", driver_memory="4g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture()
def frame(spark):
    """Build a DataFrame from a DDL schema and rows."""
    return lambda schema, rows: spark.createDataFrame(rows, schema)


def rows(df, *order):
    """Collected tuples, sorted by the given columns."""
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]
