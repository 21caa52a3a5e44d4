import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from check_oracles import session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return session()


@pytest.fixture
def frame(spark):
    def make(schema, *rows):
        return spark.createDataFrame(list(rows), schema)
    return make


def rows(df, *cols):
    """Sorted tuples, for comparing without an order."""
    return sorted((tuple(r) for r in (df.select(*cols) if cols else df).collect()), key=repr)


@pytest.fixture(name="rows")
def rows_fixture():
    return rows
