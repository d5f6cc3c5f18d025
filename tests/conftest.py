import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from sessionloom.session import build_session  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "sessionloom-tests",
        "local[4]",
        spark__sql__shuffle__partitions="4",
        spark__ui__enabled="false",
        spark__driver__memory="4g",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    if not os.path.isdir(SF_DIR):
        pytest.skip(f"no test tables at {SF_DIR}")
    return SF_DIR


def rows(df, *columns):
    """Rows as sorted tuples; sorted by text so that NULLs compare."""
    chosen = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in chosen.collect()), key=repr)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()
