import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from loglens.session import build_session
    ckpt = tempfile.mkdtemp(prefix="loglens-test-")
    s = build_session("local[4]", app_name="loglens-tests", shuffle_partitions=8,
                      extra={"spark.checkpoint.dir": ckpt, "spark.driver.memory": "4g"})
    yield s
    s.stop()


@pytest.fixture()
def scratch(spark):
    from loglens.session import scratch_path
    return lambda *parts: scratch_path(spark, "test", *parts)
