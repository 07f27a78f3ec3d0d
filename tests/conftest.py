import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from payerlake.session import build_session
    ckpt = tempfile.mkdtemp(prefix="payerlake-test-")
    s = build_session("local[4]", app="payerlake-tests", shuffle_partitions=8,
                      extra={"spark.checkpoint.dir": ckpt})
    yield s
    s.stop()


@pytest.fixture()
def lake(spark):
    from payerlake.sources.lake import Lake
    return Lake.scratch(spark, "test-lake")
