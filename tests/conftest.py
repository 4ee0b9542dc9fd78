import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from marketloom.checks.queries import warehouse as shared_warehouse  # noqa: E402
from marketloom.session import build_session  # noqa: E402

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "marketloom-tests",
        master="local[8]",
        spark__sql__shuffle__partitions="8",
        spark__ui__enabled="false",
        spark__driver__memory="4g",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def warehouse(spark):
    return shared_warehouse(spark, DATA)


@pytest.fixture
def rows(spark):
    """Frame from a DDL schema and tuples."""
    return lambda ddl, *data: spark.createDataFrame(list(data), ddl)


@pytest.fixture
def setting(spark):
    """Change session settings for one test."""
    before = {}

    def change(name, value):
        before.setdefault(name, spark.conf.get(name, None))
        spark.conf.set(name, value)

    yield change
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)
