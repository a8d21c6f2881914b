import os
import sys

import pytest

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path[:0] = [os.path.dirname(HERE), HERE]

from storeloom.session import build_session  # noqa: E402

SMALL = os.environ.get("TEST_SF_SMALL", "/root/testdata/sf0.001")
GOLDEN = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = tmp_path_factory.mktemp("shared")
    session = build_session("tests", "local[8]", {
        "spark.sql.shuffle.partitions": "8", "spark.default.parallelism": "8",
        "spark.driver.memory": "6g", "spark.checkpoint.dir": str(shared / "checkpoints"),
        "spark.sql.warehouse.dir": str(shared / "warehouse")})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SMALL


@pytest.fixture(scope="session")
def golden():
    return GOLDEN


@pytest.fixture
def rows():
    """Collected rows as plain tuples, sorted."""
    def collect(df, *columns):
        picked = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in picked.collect()),
                      key=lambda r: tuple((v is None, str(v)) for v in r))
    return collect
