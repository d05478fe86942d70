import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from searchlift.session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    return local_session(8)


@pytest.fixture(scope="session")
def folder():
    return SMALL


@pytest.fixture
def one(spark):
    """Evaluates one column expression over SQL literals."""

    def run(column, **literals):
        row = spark.range(1).selectExpr(*[f"{sql} AS {name}" for name, sql in literals.items()] or ["id"])
        return row.select(column).first()[0]

    return run
