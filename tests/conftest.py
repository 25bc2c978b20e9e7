import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from gridmart.session import get_spark
    s = get_spark(master="local[*]", shuffle_partitions=8, extra={
        "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="gridmart-wh-"),
    })
    yield s


@pytest.fixture()
def tmpdir_path():
    return tempfile.mkdtemp(prefix="gridmart-test-")
