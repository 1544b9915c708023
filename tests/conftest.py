import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from siltline.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session(4, shuffle_partitions=4)


@pytest.fixture(scope="session")
def frame(spark):
    """frame("a int, b string", (1, "x"), ...)"""

    def make(ddl, *rows):
        return spark.createDataFrame(list(rows), ddl)

    return make


def tuples(df, *columns):
    """Rows as sorted tuples of plain values."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()
