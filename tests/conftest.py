import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ferryline.session import build_session  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", 8, "6g", shuffle_partitions=4,
                            spark__sql__maxMetadataStringLength="2000")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture()
def scratch(spark):
    from ferryline.session import scratch_path

    return scratch_path(spark, "test")


def rows(df):
    """Rows as sorted tuples, columns in name order."""
    names = sorted(df.columns)
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=repr)
