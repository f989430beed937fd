import pathlib
import sys
from contextlib import contextmanager

import pytest

ROOT = pathlib.Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from sangam.session import local_session  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = str(tmp_path_factory.mktemp("shared"))
    session = local_session(4, shuffle_partitions=4, app="tests", spark__checkpoint__dir=shared)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def split_bytes(spark):
    """Context manager that reads files in splits of so many bytes."""
    name = "spark.sql.files.maxPartitionBytes"

    @contextmanager
    def use(n):
        before = spark.conf.get(name)
        spark.conf.set(name, str(n))
        try:
            yield
        finally:
            spark.conf.set(name, before)

    return use


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
